"""Model quality and promotion, computed from (label, prediction) cell counts and version metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actionspark.functions.numeric import safe_ratio

LABEL, PREDICTION = "action_label", "predicted_label"


def accuracy(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """n_rows, n_correct and accuracy, per ``by`` if given; NULL predictions are wrong, not skipped."""
    correct = F.count_if(F.col(LABEL) == F.col(PREDICTION))
    out = scored.groupBy(*by).agg(F.count("*").alias("n_rows"), correct.alias("n_correct"))
    return out.withColumn("accuracy", safe_ratio(F.col("n_correct"), F.col("n_rows")))


def _cells(scored: DataFrame) -> DataFrame:
    return scored.groupBy(LABEL, PREDICTION).agg(F.count("*").alias("n"))


def classification_report(scored: DataFrame) -> DataFrame:
    """(row, precision, recall, f1, support): one row per class seen as label or prediction, then
    accuracy, macro and weighted averages. A ratio without a denominator is 0.

    Only the class pairs are shuffled; classes and averages come from one rollup over them.
    """
    hit = F.when(F.col(LABEL) == F.col(PREDICTION), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    as_label = F.struct(
        F.col(LABEL).alias("class"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("tp")
    )
    as_prediction = F.struct(
        F.col(PREDICTION).alias("class"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")
    )
    classes = (
        _cells(scored)
        .select(F.inline(F.array(as_label, as_prediction)))
        .filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    )

    def ratio(part, whole):
        return F.coalesce(safe_ratio(part, whole), F.lit(0.0))

    measured = classes.select(
        "class",
        "support",
        "tp",
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
    )
    scores = ("precision", "recall", "f1")
    rolled = measured.rollup("class").agg(
        F.grouping_id().alias("level"),
        F.sum("support").alias("support"),
        F.sum("tp").alias("tp"),
        *[F.avg(s).alias(f"macro_{s}") for s in scores],
        *[
            ratio(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(f"weighted_{s}")
            for s in scores
        ],
    )
    nothing = F.lit(None).cast("double")

    def line(name, p, r, f):
        return F.struct(
            name.cast("string").alias("row"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            F.col("support").alias("support"),
        )

    macro, weighted = ([F.col(f"{kind}_{s}") for s in scores] for kind in ("macro", "weighted"))
    per_class = F.array(line(F.col("class"), *macro))
    overall = F.array(
        line(F.lit("accuracy"), nothing, nothing, ratio(F.col("tp"), F.col("support"))),
        line(F.lit("macro avg"), *macro),
        line(F.lit("weighted avg"), *weighted),
    )
    has_rows = rolled.filter(F.col("support").isNotNull())
    return has_rows.select(F.inline(F.when(F.col("level") == 0, per_class).otherwise(overall)))


def confusion_matrix(scored: DataFrame, labels: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """(action_label, predicted_label, n_rows) for every pair of ``labels``, zero cells included."""
    codes = F.array(*[F.lit(c) for c in labels])
    grid = (
        scored.sparkSession.range(1)
        .select(F.explode(codes).alias(LABEL))
        .select(LABEL, F.explode(codes).alias(PREDICTION))
    )
    known = scored.filter(F.col(LABEL).isin(*labels) & F.col(PREDICTION).isin(*labels))
    counted = grid.join(_cells(known), [LABEL, PREDICTION], "left")  # at most len(labels)^2 rows
    return counted.select(LABEL, PREDICTION, F.coalesce("n", F.lit(0)).alias("n_rows"))


def confusion_pivot(scored: DataFrame, labels: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """The matrix form: one row per label, one column ``pred_<code>`` per predicted code."""
    long = confusion_matrix(scored, labels)
    return (
        long.groupBy(LABEL)
        .pivot(PREDICTION, list(labels))
        .agg(F.sum("n_rows"))
        .select(LABEL, *[F.col(str(c)).alias(f"pred_{c}") for c in labels])
    )


def promotion_replay(versions: DataFrame) -> DataFrame:
    """(model, version, accuracy) to the decision taken when each version arrived.

    The first version becomes champion; a later one does if it is at least as accurate as the champion,
    whose accuracy counts as minus infinity while it is missing or zero. The champion's accuracy is then
    the running maximum, so the whole history of every model is one window. A model's versions are
    registry rows, few whatever the size of the data.
    """
    score = F.coalesce(F.nullif(F.col("accuracy"), F.lit(0.0)), F.lit(float("-inf")))
    history = Window.partitionBy("model").orderBy("version")
    earlier = history.rowsBetween(Window.unboundedPreceding, -1)
    judged = versions.select(
        "model",
        "version",
        "accuracy",
        F.max(score).over(earlier).alias("_champion"),
        score.alias("_score"),
    ).withColumn("promoted", F.col("_champion").isNull() | (F.col("_score") >= F.col("_champion")))
    champion_before = F.max(F.when(F.col("promoted"), F.col("version"))).over(earlier)
    return (
        judged.withColumn("champion_before", champion_before)
        .withColumn(
            "decision",
            F.when(F.col("champion_before").isNull(), "initial_champion")
            .when(F.col("promoted"), "champion")
            .otherwise("challenger"),
        )
        .select("model", "version", "accuracy", "promoted", "champion_before", "decision")
    )


def promotion_aliases(versions: DataFrame) -> DataFrame:
    """Per model the versions the aliases point to after the last arrival. A challenger keeps its alias
    when a later version is promoted."""
    promoted = F.when(F.col("promoted"), F.col("version"))
    before = F.when(F.col("promoted"), F.col("champion_before"))
    return (
        promotion_replay(versions)
        .groupBy("model")
        .agg(
            F.max(promoted).alias("champion"),
            F.max(before).alias("prev_champion"),
            F.max(F.when(~F.col("promoted"), F.col("version"))).alias("challenger"),
            F.max("version").alias("staging"),
        )
    )
