"""Recommendations, the inference log and the reports read from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actionspark.config import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TRAILING_DAYS
from actionspark.functions.numeric import as_column, percent
from actionspark.functions.rules import action_name, shallow_tree_label
from actionspark.operators.counts import distinct_of_bitmaps
from actionspark.operators.features import stamp
from actionspark.operators.keys import distinct_with_null


def recommendations(
    scored: DataFrame, prediction: str | Column, run_ts, version: str | Column, keep: Sequence[str] = ()
) -> DataFrame:
    """(customer_id, recommended_action, scored_at_ts, model_version); the version that scored the row
    travels with it."""
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    version = version if isinstance(version, Column) else F.lit(version)
    return scored.select(
        "customer_id",
        *keep,
        action_name(prediction).alias("recommended_action"),
        as_column(run_ts).alias("scored_at_ts"),
        version.cast("string").alias("model_version"),
    )


def rule_scores(feats: DataFrame, run_ts, version="rule", keep: Sequence[str] = ()) -> DataFrame:
    """Recommendations of the fixed shallow tree: a scorer whose output SQL can state."""
    return recommendations(feats, shallow_tree_label(), run_ts, version, keep)


def inference_log(
    recs: DataFrame,
    feats: DataFrame,
    log_date,
    run_ts,
    keys: Sequence[str] = ("customer_id",),
    columns: Sequence[str] = NUMERIC_FEATURES + CATEGORICAL_FEATURES,
) -> DataFrame:
    """Recommendations with the features they were made from and the stamps of the run.

    A recommendation without a feature row stays, with NULL features. The keys are unique on both sides.
    """
    slim = feats.select(*keys, *columns)
    version = F.coalesce(F.col("model_version"), F.lit("unknown"))
    return stamp(recs.join(slim, list(keys), "left"), run_ts, log_date, version)


def mean_drift(log: DataFrame, cols: Sequence[str], date_col: str = "log_date", dates=None) -> DataFrame:
    """(feature, baseline_mean, current_mean, delta): means on the earliest and on the latest date.

    Without ``dates`` the two dates are scalar subqueries over the date column, so on a log partitioned by date only
    those two days are read, but every file is opened for its dates. ``dates``, first and last, come from the list of
    partitions (``ledger.extent_of_dates``) and spare that. A mean without values counts as 0; an empty log gives no rows.
    """
    day = F.col(date_col)
    if dates:
        first, last = map(F.lit, dates)
    else:
        first, last = log.agg(F.min(date_col)).scalar(), log.agg(F.max(date_col)).scalar()
    ends = log.filter((day == first) | (day == last)).select(
        (day == first).alias("_first"), (day == last).alias("_last"), *cols
    )

    def mean(c: str, side: str) -> Column:
        return F.coalesce(F.avg(F.when(F.col(side), F.col(c).cast("double"))), F.lit(0.0))

    one_row = ends.agg(
        F.count("*").alias("_n"),
        *[F.struct(mean(c, "_first").alias("b"), mean(c, "_last").alias("c")).alias(c) for c in cols],
    ).filter(F.col("_n") > 0)
    long = one_row.unpivot(["_n"], list(cols), "feature", "m")
    delta = F.col("m.c") - F.col("m.b")
    return long.select(
        "feature",
        F.col("m.b").alias("baseline_mean"),
        F.col("m.c").alias("current_mean"),
        delta.alias("delta"),
    ).orderBy(F.abs("delta").desc(), "feature")


def _recent(as_of, days: int) -> Column:
    return F.col("log_date") >= F.date_sub(as_column(as_of).cast("date"), days)


def performance_report(
    log: DataFrame, as_of, days: int = TRAILING_DAYS, customers: DataFrame | None = None
) -> DataFrame:
    """(section, key, value): totals, distinct customers, trailing count, actions and versions.

    ``customers``, the stored key bitmaps of the log's days, gives the distinct customers without a shuffle of their keys.
    Two aggregates that read disjoint columns of the log: the key for the totals, the two dimensions for
    the distributions.
    """
    totals = log.agg(
        F.count("*").alias("total_predictions"),
        *([distinct_with_null("customer_id").alias("unique_customers")] if customers is None else []),
        F.count_if(_recent(as_of, days)).alias("recent_predictions"),
    )
    if customers is not None:
        totals = totals.withColumn("unique_customers", distinct_of_bitmaps(customers).scalar())
    names = ["total_predictions", "unique_customers", "recent_predictions"]
    head = totals.unpivot([], names, "key", "value").select(
        F.lit("totals").alias("section"), "key", "value"
    )
    return head.unionByName(_distributions(log).select("section", "key", F.col("n").alias("value")))


def _distributions(log: DataFrame) -> DataFrame:
    """(section, key, n) per action and per version, both from one count per pair."""
    pairs = log.groupBy("recommended_action", "model_version").agg(F.count("*").alias("n"))
    sections = F.array(
        F.struct(F.lit("action").alias("section"), F.col("recommended_action").alias("key")),
        F.struct(F.lit("version").alias("section"), F.col("model_version").alias("key")),
    )
    rows = pairs.select("n", F.inline(sections))
    return rows.groupBy("section", "key").agg(F.sum("n").alias("n"))


def health_summary(log: DataFrame, as_of, days: int = TRAILING_DAYS) -> DataFrame:
    """(section, key, n, share_pct): totals, shares per action and version, and one status row."""
    by_date = log.groupBy("log_date").agg(F.count("*").alias("n"))
    totals = by_date.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("predictions"),
        (F.count("log_date") + F.coalesce(F.max(F.col("log_date").isNull().cast("int")), F.lit(0))).alias(
            "dates"
        ),
        F.coalesce(F.sum(F.when(_recent(as_of, days), F.col("n"))), F.lit(0)).alias("recent"),
    )
    status = (
        F.when(F.col("predictions") == 0, "no_logs")
        .when(F.col("recent") == 0, "none_recent")
        .otherwise("good")
    )

    def line(section: str, key: Column, n: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), key.alias("key"), n.alias("n"))

    head = totals.select(
        F.inline(
            F.array(
                *[line("totals", F.lit(c), F.col(c)) for c in ("predictions", "dates", "recent")],
                line("status", status, F.col("predictions")),
            )
        )
    ).withColumn("share_pct", F.lit(None).cast("double"))
    parts = _distributions(log)
    sizes = parts.groupBy("section").agg(F.sum("n").alias("_total"))
    shares = parts.join(F.broadcast(sizes), "section").select(  # two sections
        "section", "key", "n", percent(F.col("n"), F.col("_total")).alias("share_pct")
    )
    return head.unionByName(shares)
