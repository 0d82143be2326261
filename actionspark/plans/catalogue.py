"""Named queries over the warehouse tables: each operator run on whole tables.

A query that reads its customers more than once stores them first (``materialize``), as a scheduled job
would read the stored customer table; one that reads them once stays a single lazy plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from actionspark.config import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from actionspark.functions.numeric import rounded, to_long
from actionspark.functions.rules import action_label, action_name, shallow_tree_label
from actionspark.operators import counts, drift, encoding, evaluation, keys, profiles, readiness, summary
from actionspark.operators import logs as log_ops
from actionspark.operators import training
from actionspark.operators.features import features, labels, on_date, present, stamp, trailing
from actionspark.plans.forest import fit_forest, forest_scores, predict
from actionspark.plans.jobs import refresh_from_files
from actionspark.sources import ledger, versions
from actionspark.sources.customer360 import customer_snapshots, load_warehouse, raw_customers
from actionspark.sources.schemas import INFERENCE_LOG
from actionspark.sources.tables import (
    append_log,
    baseline_full,
    baseline_sample,
    baseline_version,
    materialize,
    overwrite_table,
    read_log,
    read_table,
    scratch_path,
    warehouse_table,
)
from actionspark.sources.upsert import read_keyed, upsert
from actionspark.streaming.logging import follow_counts, followed, log_batch, score_into_log
from actionspark.streaming.scoring import score_stream

SNAPSHOTS = 4
# The raw columns explored before features are derived.
EXPLORED = (
    "age",
    "income",
    "num_purchases_last_month",
    "purchase_amount_last_month",
    "browsing_minutes_last_week",
)
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FEATURE_COLUMNS = NUMERIC_FEATURES + CATEGORICAL_FEATURES
FOREST = {"trees": 200, "depth": 30, "seed": 42}
ACCURACY_FLOOR, RECALL_FLOOR = 0.9, 0.75

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return register


# ---- shared inputs ------------------------------------------------------------------------------


def _raw(spark, d):
    return raw_customers(load_warehouse(spark, d))


def _newest(spark, d):
    return customer_snapshots(load_warehouse(spark, d), 1)


def _features(spark, d):
    return features(_newest(spark, d), F.col("as_of"))


def _snapshot_features(spark, d, stored=False):
    snaps = customer_snapshots(load_warehouse(spark, d), SNAPSHOTS)
    if stored:
        snaps = materialize(snaps, "snapshots")
    return features(snaps, F.col("as_of"), keep=["snapshot", "best_action"])


def _version():
    return F.concat(F.lit("v"), (F.col("snapshot") % 2 + 1).cast("string"))


def _active():
    """Customers with orders or browsing in the window; the others have no feature row."""
    return (F.col("num_purchases_last_month") > 0) | (F.col("browsing_minutes_last_week") > 0)


def _recs(feats):
    return log_ops.rule_scores(feats, F.col("updated_at"), _version(), keep=["snapshot"])


def _log(spark, d):
    feats = _snapshot_features(spark, d, stored=True)
    return log_ops.inference_log(
        _recs(feats),
        feats.filter(_active()),
        F.col("scored_at_ts"),
        F.col("scored_at_ts"),
        keys=["customer_id", "snapshot"],
    ).drop("snapshot")


def _rule_evaluated(spark, d):
    """Rule predictions next to the labels, over all snapshots."""
    feats = _snapshot_features(spark, d)
    return feats.select(
        "snapshot",
        "customer_id",
        "region",
        action_label().alias("action_label"),
        shallow_tree_label().alias("predicted_label"),
    )


def _two_sides(spark, d):
    """Newest snapshot and the oldest one as its baseline."""
    snaps = materialize(customer_snapshots(load_warehouse(spark, d), [0, SNAPSHOTS - 1]), "snapshots")
    feats = features(snaps, F.col("as_of"), keep=["snapshot", "best_action"])
    return feats.filter(F.col("snapshot") == 0), feats.filter(F.col("snapshot") == SNAPSHOTS - 1)


# ---- sources, features, labels ------------------------------------------------------------------


@query("customer360")
def customer360(spark, d):
    return _raw(spark, d)


@query("customer360_snapshots")
def customer360_snapshots(spark, d):
    return customer_snapshots(load_warehouse(spark, d), SNAPSHOTS)


@query("features")
def newest_features(spark, d):
    return _features(spark, d)


@query("labels")
def newest_labels(spark, d):
    return labels(_raw(spark, d))


@query("label_encoding")
def label_encoding(spark, d):
    coded = labels(_raw(spark, d))
    return coded.select("customer_id", "action_label", action_name("action_label").alias("decoded"))


@query("stamped_features")
def stamped_features(spark, d):
    return stamp(_features(spark, d), F.col("updated_at"), F.col("updated_at"), "v1")


@query("trailing_orders")
def trailing_orders(spark, d):
    orders = warehouse_table(spark, d, "orders")
    return trailing(orders, "o_orderdate").select("o_orderkey", "o_custkey", "o_orderdate")


@query("log_on_latest_date")
def log_on_latest_date(spark, d):
    log = _log(spark, d)
    latest = log.agg(F.max("log_date")).scalar()
    return on_date(log, "log_date", latest).select("customer_id", "recommended_action", "log_date")


@query("log_rows_with_features")
def log_rows_with_features(spark, d):
    return present(_log(spark, d), "income").select("customer_id", "log_date", "income", "region")


# ---- keys and quality ---------------------------------------------------------------------------


@query("duplicate_keys")
def duplicate_keys(spark, d):
    return keys.duplicate_keys(warehouse_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("key_check")
def key_check(spark, d):
    lines = keys.key_check(warehouse_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])
    feats = keys.key_check(_features(spark, d), ["customer_id"])
    named = [df.withColumn("table_name", F.lit(n)) for n, df in (("lineitem", lines), ("features", feats))]
    return named[0].unionByName(named[1])


@query("dedupe_latest")
def dedupe_latest(spark, d):
    return keys.dedupe_latest(warehouse_table(spark, d, "events"), ["user_id"], ["ts"])


@query("dedupe_features")
def dedupe_features(spark, d):
    feats = _snapshot_features(spark, d).drop("best_action")
    return keys.dedupe_latest(feats, ["customer_id"], ["updated_at"])


@query("features_upserted")
def features_upserted(spark, d):
    """Features by key: the oldest snapshot, then a newer one for a part of the customers, then rows that come late, twice and
    without a key, and the newest snapshot for another part."""
    feats = _snapshot_features(spark, d, stored=True).drop("best_action")
    table, key, order = scratch_path(spark, "features_by_key"), ["customer_id"], ["updated_at"]

    def part(snapshot, which):
        return feats.filter((F.col("snapshot") == snapshot) & which).drop("snapshot")

    everyone, few = F.lit(True), F.col("customer_id") % 40 == 0
    upsert(part(3, everyone), table, key, order, 32)
    upsert(part(1, F.col("customer_id") % 3 == 0), table, key, order, 32)
    late = part(2, everyone)
    upsert(late.unionByName(late).unionByName(late.withColumn("customer_id", F.lit(None).cast("long"))), table, key, order, 32)
    upsert(part(0, few), table, key, order, 32)
    return read_keyed(spark, table)


@query("null_rates")
def null_rates(spark, d):
    return rounded(keys.null_rates(_log(spark, d), NUMERIC_FEATURES))


@query("duplicate_rate")
def duplicate_rate(spark, d):
    return rounded(keys.duplicate_rate(warehouse_table(spark, d, "orders"), "o_custkey"))


@query("readiness")
def table_readiness(spark, d):
    feats = _snapshot_features(spark, d, stored=True)
    log = log_ops.inference_log(
        _recs(feats), feats, F.col("scored_at_ts"), F.col("scored_at_ts"), ["customer_id", "snapshot"]
    )
    tables = {"features": feats.drop("updated_at"), "inference_log": log}
    return readiness.readiness(spark, tables)


# ---- exploration --------------------------------------------------------------------------------


@query("class_balance")
def class_balance(spark, d):
    return counts.class_balance(_raw(spark, d))


@query("category_counts")
def category_counts(spark, d):
    return counts.category_counts(_features(spark, d), CATEGORICAL_FEATURES)


@query("category_shares")
def category_shares(spark, d):
    return rounded(counts.shares(counts.category_counts(_features(spark, d), CATEGORICAL_FEATURES)))


@query("numeric_summary")
def numeric_summary(spark, d):
    stored = materialize(_raw(spark, d), "raw")
    return rounded(summary.numeric_summary(stored, EXPLORED, exact=True))


@query("lineitem_summary")
def lineitem_summary(spark, d):
    lines = warehouse_table(spark, d, "lineitem")
    return rounded(summary.numeric_summary(lines, LINE_NUMBERS, exact=True))


@query("label_correlation")
def label_correlation(spark, d):
    coded = _raw(spark, d).select(*EXPLORED, action_label().alias("action_label"))
    return rounded(summary.label_correlation(coded, EXPLORED, "action_label"))


@query("histogram")
def histogram(spark, d):
    return rounded(summary.histogram(materialize(_raw(spark, d).select("age"), "raw"), "age"))


@query("order_value_histogram")
def order_value_histogram(spark, d):
    return rounded(summary.histogram(warehouse_table(spark, d, "orders"), "o_totalprice"))


@query("boxplot_stats")
def boxplot_stats(spark, d):
    stored = materialize(_raw(spark, d).select("best_action", "browsing_minutes_last_week"), "raw")
    return rounded(summary.boxplot_stats(stored, "browsing_minutes_last_week", "best_action", exact=True))


@query("event_value_boxplot")
def event_value_boxplot(spark, d):
    events = warehouse_table(spark, d, "events")
    return rounded(summary.boxplot_stats(events, "value", "event_type", exact=True))


SKETCH_ERROR = 0.001  # ten times the resolution of the sketches


@query("lineitem_summary_sketched")
def lineitem_summary_sketched(spark, d):
    """The sketched summary, and whether its quartiles hold their ranks among all rows."""
    lines = warehouse_table(spark, d, "lineitem")
    sketched = materialize(summary.numeric_summary(lines, LINE_NUMBERS), "summary")
    values = to_long(lines, [], LINE_NUMBERS, "feature", "value", "double")
    checked = summary.quartile_check(values, ["feature"], sketched, SKETCH_ERROR).drop("n")
    return rounded(sketched.drop("q25", "q50", "q75").join(checked, "feature"))


@query("event_value_boxplot_sketched")
def event_value_boxplot_sketched(spark, d):
    """The sketched box plot, and whether its quartiles hold their ranks."""
    events = warehouse_table(spark, d, "events")
    sketched = materialize(summary.boxplot_stats(events, "value", "event_type"), "boxes")
    values = events.select("event_type", F.col("value"))
    return summary.quartile_check(values, ["event_type"], sketched, SKETCH_ERROR)


@query("event_profile_sketched")
def event_profile_sketched(spark, d):
    """The sketched weekly profile, and whether its quartiles hold their ranks in every window and slice."""
    events = warehouse_table(spark, d, "events")
    sketched = materialize(_profile(events, "ts", "week", ["value"], ["event_type"]), "profile")
    by_type = F.struct(F.lit("event_type").alias("slice_key"), F.coalesce("event_type", F.lit("unknown")).alias("slice_value"))
    whole = F.struct(F.lit("all").alias("slice_key"), F.lit("all").alias("slice_value"))
    values = events.select(
        profiles.window_start("ts", "week").alias("window_start"), "value", F.inline(F.array(whole, by_type))
    )
    keys_ = ["window_start", "slice_key", "slice_value"]
    checked = summary.quartile_check(values, keys_, sketched, 10 * SKETCH_ERROR)
    figures = sketched.select(*keys_, "n_rows", "n_null", "mean", "min", "max")
    return rounded(figures.join(checked, keys_))


# ---- encoding, training set, split --------------------------------------------------------------


@query("vocabulary")
def vocabulary(spark, d):
    return encoding.fit_vocabulary(_features(spark, d), CATEGORICAL_FEATURES)


@query("one_hot")
def one_hot(spark, d):
    feats = materialize(_features(spark, d), "features")
    encoded = encoding.load_vocabulary(encoding.fit_vocabulary(feats, CATEGORICAL_FEATURES))
    return encoding.one_hot(feats, encoded, NUMERIC_FEATURES, keep=["customer_id"])


@query("one_hot_sparse")
def one_hot_sparse(spark, d):
    feats = materialize(_features(spark, d), "features")
    vocabulary = materialize(encoding.fit_vocabulary(feats, CATEGORICAL_FEATURES), "vocabulary")
    return encoding.one_hot_sparse(feats, vocabulary, CATEGORICAL_FEATURES, "customer_id")


def _labels_and_active_features(spark, d):
    stored = materialize(_newest(spark, d), "raw")
    return labels(stored), features(stored, F.col("as_of")).filter(_active())


@query("training_set_inner")
def training_set_inner(spark, d):
    coded, feats = _labels_and_active_features(spark, d)
    return training.training_set(coded, feats, FEATURE_COLUMNS, "inner")


@query("training_set_lookup")
def training_set_lookup(spark, d):
    coded, feats = _labels_and_active_features(spark, d)
    return training.training_set(coded, feats, FEATURE_COLUMNS, "left")


def _order_days(spark, d):
    """What each customer ordered each day: number, highest price in cents."""
    orders = warehouse_table(spark, d, "orders")
    return orders.groupBy(F.col("o_custkey").alias("buyer"), F.to_date("o_orderdate").alias("order_day")).agg(
        F.count("*").alias("n_orders"), F.max(F.round(F.col("o_totalprice") * 100).cast("long")).alias("top_cents")
    )


@query("training_set_as_of")
def training_set_as_of(spark, d):
    """Labels of four snapshots, each with its customer's last order day up to the snapshot."""
    feats = _snapshot_features(spark, d, stored=True)
    rows = feats.select("customer_id", "snapshot", "updated_at", action_label().alias("action_label"))
    history = _order_days(spark, d).withColumnRenamed("buyer", "customer_id")
    found = training.features_as_of(
        rows, history, "customer_id", "updated_at", "order_day", ["order_day", "n_orders", "top_cents"]
    )
    return found.drop("updated_at")


@query("hash_split")
def hash_split(spark, d):
    return training.hash_split(labels(_raw(spark, d)), "customer_id")


@query("split_quotas")
def split_quotas(spark, d):
    return training.test_quotas(labels(_raw(spark, d)), "action_label")


@query("exact_split")
def exact_split(spark, d):
    stored = materialize(labels(_raw(spark, d)), "labels")
    return training.exact_split(stored, "customer_id", "action_label")


@query("order_exact_split")
def order_exact_split(spark, d):
    orders = warehouse_table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return training.exact_split(orders, "o_orderkey", "o_orderpriority")


# ---- scoring and evaluation ---------------------------------------------------------------------


@query("rule_scores")
def rule_scores(spark, d):
    return log_ops.rule_scores(_features(spark, d), F.col("updated_at"))


@query("request_scores")
def request_scores(spark, d):
    """Requests are the customers that raised an error event; they are scored from their feature rows."""
    errors = warehouse_table(spark, d, "events").filter(F.col("event_type") == "error")
    requests = errors.select(F.col("user_id").alias("customer_id"))
    asked = _features(spark, d).join(requests, "customer_id", "left_semi")
    return log_ops.rule_scores(asked, F.col("updated_at"))


@query("accuracy")
def accuracy(spark, d):
    return rounded(evaluation.accuracy(_rule_evaluated(spark, d)))


@query("accuracy_by_snapshot")
def accuracy_by_snapshot(spark, d):
    return rounded(evaluation.accuracy(_rule_evaluated(spark, d), ["snapshot"]))


@query("classification_report")
def classification_report(spark, d):
    return rounded(evaluation.classification_report(_rule_evaluated(spark, d)))


@query("confusion_matrix")
def confusion_matrix(spark, d):
    return evaluation.confusion_matrix(_rule_evaluated(spark, d))


@query("confusion_pivot")
def confusion_pivot(spark, d):
    return evaluation.confusion_pivot(_rule_evaluated(spark, d))


def _region_versions(spark, d):
    """One model per region, one version per snapshot (oldest first), with its accuracy."""
    measured = evaluation.accuracy(_rule_evaluated(spark, d), ["region", "snapshot"])
    return measured.select(
        F.col("region").alias("model"), (SNAPSHOTS - F.col("snapshot")).alias("version"), "accuracy"
    )


def _monthly_versions(spark, d):
    """One model per order priority, one version per month (12 * year + month): the share of finished orders as accuracy."""
    orders = warehouse_table(spark, d, "orders")
    month = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("int")
    finished = F.count_if(F.col("o_orderstatus") == "F") / F.count("*")
    return orders.groupBy(F.col("o_orderpriority").alias("model"), month.alias("version")).agg(
        finished.alias("accuracy")
    )


@query("promotion_replay")
def promotion_replay(spark, d):
    return rounded(evaluation.promotion_replay(_monthly_versions(spark, d)))


@query("promotion_aliases")
def promotion_aliases(spark, d):
    return evaluation.promotion_aliases(_monthly_versions(spark, d))


@query("region_model_aliases")
def region_model_aliases(spark, d):
    return evaluation.promotion_aliases(_region_versions(spark, d))


def _labelled_split(stored):
    joined = training.training_set(labels(stored), features(stored, F.col("as_of")), FEATURE_COLUMNS)
    return training.hash_split(joined, "customer_id")


def _forest(spark, d):
    """A forest fitted on the train part, the features of all customers, the vocabulary, the split rows."""
    stored = materialize(_newest(spark, d), "raw")
    feats = features(stored, F.col("as_of"))
    known = materialize(encoding.fit_vocabulary(feats, CATEGORICAL_FEATURES), "vocabulary")
    split = _labelled_split(stored)
    model = fit_forest(split.filter(F.col("split") == "train"), known, CATEGORICAL_FEATURES, NUMERIC_FEATURES, **FOREST)
    return model, feats, known, split


def _rule_forest(spark, d):
    """A forest without chance, fitted on all rows to give back the fixed shallow tree's label."""
    feats = materialize(_features(spark, d), "features")
    known = materialize(encoding.fit_vocabulary(feats, CATEGORICAL_FEATURES), "vocabulary")
    train = feats.withColumn("action_label", shallow_tree_label())
    whole = {**FOREST, "trees": 3, "bootstrap": False, "features_per_split": "all", "fit_rows": None}
    return fit_forest(train, known, CATEGORICAL_FEATURES, NUMERIC_FEATURES, **whole), feats, known


def _forest_scores(model, rows, known):
    return forest_scores(
        model, rows, known, CATEGORICAL_FEATURES, NUMERIC_FEATURES, "1", F.col("updated_at"), carry=["updated_at"]
    )


def _differences(left, right):
    """One row: rows of ``left``, and rows that are on one side only."""
    tagged = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(-1)))
    per_row = tagged.groupBy(*left.columns).agg(
        F.sum("side").alias("excess"), F.count_if(F.col("side") > 0).alias("n")
    )
    return per_row.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.abs("excess")), F.lit(0)).alias("n_differences"),
    )


@query("rf_held_out")
def rf_held_out(spark, d):
    """Per class, on rows the forest has not seen: their number, and whether accuracy and the class's recall reach
    their floors."""
    model, _, known, split = _forest(spark, d)
    test = split.filter(F.col("split") == "test")
    kept = ["customer_id", "action_label"]
    scored = predict(model, test, known, CATEGORICAL_FEATURES, NUMERIC_FEATURES, kept)
    hit = F.count_if(F.col("action_label") == F.col("predicted_label"))
    per_class = scored.groupBy("action_label").agg(F.count("*").alias("n_test"), hit.alias("hits"))
    everything = Window.partitionBy(F.lit(1))  # a row per class
    accuracy = F.sum("hits").over(everything) / F.sum("n_test").over(everything)
    return per_class.select(
        "action_label",
        "n_test",
        (accuracy >= ACCURACY_FLOOR).alias("accurate"),
        (F.col("hits") / F.col("n_test") >= RECALL_FLOOR).alias("recalled"),
    )


@query("rf_requests")
def rf_requests(spark, d):
    """Requests scored by themselves against the same rows scored within the batch."""
    model, feats, known, _ = _forest(spark, d)
    errors = warehouse_table(spark, d, "events").filter(F.col("event_type") == "error")
    asked = errors.select(F.col("user_id").alias("customer_id"))
    alone = _forest_scores(model, feats.join(asked, "customer_id", "left_semi"), known)
    batch = _forest_scores(model, feats, known).join(asked, "customer_id", "left_semi")
    return _differences(alone, batch)


@query("stream_against_batch")
def stream_against_batch(spark, d):
    """Streamed scores against the batch scores of the same rows."""
    model, feats, known, _ = _forest(spark, d)
    streamed = _streamed(spark, feats, lambda rows: _forest_scores(model, rows, known))
    return _differences(streamed, _forest_scores(model, feats, known))


@query("rf_scores")
def rf_scores(spark, d):
    """Scores of a forest that must have learnt the shallow tree's rule, row by row."""
    return _forest_scores(*_rule_forest(spark, d))


def _streamed(spark, feats, scorer):
    source, sink, state = (scratch_path(spark, n) for n in ("arriving", "scored", "state"))
    overwrite_table(feats, source)
    score_stream(spark, source, sink, state, scorer).awaitTermination()
    return spark.read.parquet(sink)


@query("stream_rule_scores")
def stream_rule_scores(spark, d):
    return _streamed(
        spark, _features(spark, d), lambda feats: log_ops.rule_scores(feats, F.col("updated_at"))
    )


@query("stream_scores")
def stream_scores(spark, d):
    model, feats, known = _rule_forest(spark, d)
    return _streamed(spark, feats, lambda rows: _forest_scores(model, rows, known))


@query("stream_into_log")
def stream_into_log(spark, d):
    """Four writes of requests, one a micro-batch, the newest snapshot last; the third repeats half of the second. The champion
    changes after the second micro-batch; then that one is run again. The features are stored once and each write has as
    many tasks as they have parts, so no micro-batch is computed or written by one task."""
    feats = materialize(_snapshot_features(spark, d, stored=True).drop("best_action"), "features")
    source, log, state = (scratch_path(spark, n) for n in ("requests", "log", "state"))
    parts = [feats.filter(F.col("snapshot") == k).drop("snapshot") for k in reversed(range(SNAPSHOTS))]
    again = parts[2].unionByName(parts[1].filter("customer_id % 2 = 0"))
    files = [parts[0], parts[1], again, parts[3]]
    asked = []

    def champion():
        asked.append(1)
        return "v1" if len(asked) <= 2 else "v2"

    def scorer_of(version):
        return lambda rows: log_ops.rule_scores(rows, F.col("updated_at"), version)

    for part in files:
        part.write.mode("append").parquet(source)
        score_into_log(spark, source, log, state, champion, scorer_of, delay="400 days").awaitTermination()
    log_batch(parts[1], _batch_numbers(spark, log)[1], log, f"{state}/decisions", champion, scorer_of)
    return read_log(spark, log, INFERENCE_LOG).drop("inference_timestamp", "batch_id")


def _batch_numbers(spark, log):
    """The numbers of the micro-batches in a log, oldest first."""
    names = spark.read.parquet(log).select("batch_id").distinct().collect()
    return sorted(int(r[0].removeprefix("stream-")) for r in names)


@query("stream_profile")
def stream_profile(spark, d):
    """Events that arrive in files out of order, days mixed, followed day by day."""
    events = warehouse_table(spark, d, "events")
    source, table, state = (scratch_path(spark, n) for n in ("events", "day_profile", "state"))
    for k in range(3):
        events.filter(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(source)
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    follow_counts(arriving, "ts", "value", table, state, "400 days").awaitTermination()
    return rounded(followed(spark, table))


# ---- log, profiles, drift, reports --------------------------------------------------------------


@query("inference_log")
def inference_log(spark, d):
    return _log(spark, d)


@query("appended_log")
def appended_log(spark, d):
    """The log written one snapshot at a time, each in two batches for the same day and version; the newest day's
    second batch is written again, with one more column."""
    feats = _snapshot_features(spark, d, stored=True)
    path = scratch_path(spark, "log")
    for k in reversed(range(SNAPSHOTS)):
        for batch in ("0", "1"):
            part = feats.filter((F.col("snapshot") == k) & (F.col("customer_id") % 2 == int(batch)))
            rows = log_ops.inference_log(
                _recs(part).drop("snapshot"), part.filter(_active()), F.col("scored_at_ts"), F.col("scored_at_ts")
            )
            append_log(rows, path, batch_id=batch)
    append_log(rows.withColumn("channel", F.lower("recommended_action")), path, batch_id=batch)
    known = StructType([*INFERENCE_LOG.fields, StructField("channel", StringType())])
    return read_log(spark, path, known).select(
        "customer_id", "recommended_action", "income", "log_date", "model_version", "batch_id", "channel"
    )


@query("overwritten_table")
def overwritten_table(spark, d):
    """The feature table replaced by the labelled features: other rows, another schema, read back."""
    path = scratch_path(spark, "features")
    feats = _snapshot_features(spark, d, stored=True)
    overwrite_table(feats.filter(F.col("snapshot") == 1).drop("snapshot", "best_action"), path)
    newest = feats.filter(F.col("snapshot") == 0)
    overwrite_table(newest.select("customer_id", "age_bucket", "best_action", action_label().alias("action_label")), path)
    return read_table(spark, path)


@query("baseline_snapshot")
def baseline_snapshot(spark, d):
    return baseline_full(_features(spark, d), scratch_path(spark, "baseline"))


@query("baseline_sample")
def feature_sample(spark, d):
    return baseline_sample(_features(spark, d), "customer_id", 1000)


@query("failed_overwrite")
def failed_overwrite(spark, d):
    """A table of last snapshot's features, read after two overwrites that failed when most of their rows were written."""
    path = scratch_path(spark, "features")
    feats = _snapshot_features(spark, d, stored=True).drop("best_action")
    overwrite_table(feats.filter(F.col("snapshot") == 1).drop("snapshot"), path, keep=2)
    last = feats.agg(F.max("customer_id")).first()[0]
    broken = F.when(F.col("customer_id") == last, F.raise_error(F.lit("write lost"))).otherwise(F.col("customer_id"))
    for _ in range(2):
        try:
            overwrite_table(feats.filter(F.col("snapshot") == 0).withColumn("customer_id", broken).drop("snapshot"), path)
        except Exception as e:
            if "write lost" not in str(e):
                raise
    return read_table(spark, path)


@query("pinned_baseline")
def pinned_baseline(spark, d):
    """Drift of the newest features against the version pinned two overwrites ago, of a table that keeps one version."""
    path = scratch_path(spark, "features")
    feats = _snapshot_features(spark, d, stored=True).drop("best_action")
    for k in (SNAPSHOTS - 1, 1, 0):
        overwrite_table(feats.filter(F.col("snapshot") == k).drop("snapshot"), path, keep=1)
        if k == SNAPSHOTS - 1:
            baseline_version(spark, path)
    baseline = versions.read_pinned(spark, path, "baseline")
    return rounded(drift.categorical_drift(read_table(spark, path), baseline, CATEGORICAL_FEATURES))


@query("action_distribution")
def action_distribution(spark, d):
    return counts.action_distribution(_log(spark, d))


@query("log_extent")
def log_extent(spark, d):
    return counts.extent(_log(spark, d), "customer_id", "log_date")


@query("mean_drift")
def mean_drift(spark, d):
    return rounded(log_ops.mean_drift(_log(spark, d), NUMERIC_FEATURES))


def _profile(*args, **named):
    return profiles.profile(*args, **named).drop("content")


@query("profile_daily")
def profile_daily(spark, d):
    feats = _snapshot_features(spark, d, stored=True)
    return rounded(_profile(feats, "updated_at", "day", NUMERIC_FEATURES, exact=True))


@query("profile_weekly")
def profile_weekly(spark, d):
    feats = _snapshot_features(spark, d, stored=True)
    return rounded(_profile(feats, "updated_at", "week", NUMERIC_FEATURES, exact=True))


@query("event_profile_weekly")
def event_profile_weekly(spark, d):
    events = warehouse_table(spark, d, "events")
    return rounded(_profile(events, "ts", "week", ["value"], ["event_type"], exact=True))


@query("event_profile_refreshed")
def event_profile_refreshed(spark, d):
    """Profiled without the two newest weeks and without every seventh older event, which arrive late; then refreshed."""
    events = warehouse_table(spark, d, "events")
    cut = events.agg(F.max("ts") - F.make_dt_interval(F.lit(14))).scalar()
    before = events.filter((F.col("ts") < cut) & ((F.col("event_id") % 7 != 0) | (F.col("ts") < cut - F.make_dt_interval(F.lit(7)))))
    stored = materialize(
        profiles.profile(before, "ts", "week", ["value"], ["event_type"], exact=True), "profile"
    )
    fresh = profiles.refresh_profile(stored, events, "ts", "week", ["value"], ["event_type"], exact=True)
    return rounded(fresh.drop("content"))


def _dated_events(spark, d):
    return warehouse_table(spark, d, "events").withColumn("event_date", F.to_date("ts"))


@query("event_profile_from_files")
def event_profile_from_files(spark, d):
    """Profiled from a log by date without its newest fortnight; then the oldest day is dropped, rows come late for some
    days, the fortnight arrives, and the profile is brought up to date from the files that changed."""
    events = materialize(_dated_events(spark, d), "events")
    log, path = scratch_path(spark, "event_log"), scratch_path(spark, "event_profile")
    first, last = events.agg(F.min("event_date"), F.max("event_date")).first()
    new = F.col("event_date") > F.date_sub(F.lit(last), 14)
    late = (F.col("event_id") % 7 == 0) & (F.col("event_date") > F.date_sub(F.lit(last), 17))
    parts = ["event_date", "batch_id"]
    refresh = (spark, log, path, "week", ["value"], ["event_type"], events.schema, "event_date", True)
    append_log(events.filter(~new & ~late), log, parts, batch_id="0")
    refresh_from_files(*refresh)
    append_log(events.filter(new | late), log, parts, batch_id="1")
    ledger.drop_partitions(spark, log, [first], "event_date")
    return rounded(refresh_from_files(*refresh).drop("content"))


@query("event_profile_from_sketches")
def event_profile_from_sketches(spark, d):
    """Weeks merged from the stored sketches of their days, and whether their quartiles hold their ranks among all rows."""
    events = warehouse_table(spark, d, "events")
    days = materialize(profiles.day_sketches(events, "ts", ["value"], ["event_type"]), "day_sketches")
    weeks = materialize(profiles.sketch_profile(profiles.merged_sketches(days, "week"), "week"), "weeks")
    by_type = F.struct(F.lit("event_type").alias("slice_key"), F.coalesce("event_type", F.lit("unknown")).alias("slice_value"))
    whole = F.struct(F.lit("all").alias("slice_key"), F.lit("all").alias("slice_value"))
    values = events.select(
        profiles.window_start("ts", "week").alias("window_start"), "value", F.inline(F.array(whole, by_type))
    )
    keys_ = ["window_start", "slice_key", "slice_value"]
    checked = summary.quartile_check(values, keys_, weeks, 10 * SKETCH_ERROR)
    figures = weeks.select(*keys_, "n_rows", "n_null", "mean", "stddev", "min", "max")
    return rounded(figures.join(checked, keys_))


@query("ks_from_sketches")
def ks_from_sketches(spark, d):
    """Newest week of events against all before it, per type, from stored sketches: the rows of both sides, and whether the
    distance is within two hundredths of the exact one."""
    events = warehouse_table(spark, d, "events")
    days = materialize(profiles.day_sketches(events, "ts", ["value"], ["event_type"]), "day_sketches")
    cut = F.date_sub(days.agg(F.max("window_start")).scalar(), 6)
    sides = [profiles.merged_sketches(days.filter(c)) for c in (F.col("window_start") >= cut, F.col("window_start") < cut)]
    found = profiles.ks_of_sketches(*sides).filter("slice_key = 'all'")
    day, newest = F.to_date("ts"), F.date_sub(events.agg(F.to_date(F.max("ts"))).scalar(), 6)
    exact = drift.ks_exact(events.filter(day >= newest), events.filter(day < newest), ["value"])
    near = F.abs(F.col("ks") - F.col("exact")) <= 2 * 10 * SKETCH_ERROR
    exact = exact.select(F.col("feature").alias("column_name"), F.col("ks").alias("exact"))
    return found.join(exact, "column_name").select("column_name", "n_baseline", "n_current", near.alias("near_exact"))


@query("inference_profile")
def inference_profile(spark, d):
    return rounded(profiles.prediction_profile(_log(spark, d)))


@query("inference_profile_numeric")
def inference_profile_numeric(spark, d):
    log = _log(spark, d)
    return rounded(
        _profile(
            log, "inference_timestamp", "day", NUMERIC_FEATURES, ["model_version"], exact=True
        )
    )


@query("drift_categorical")
def drift_categorical(spark, d):
    return rounded(drift.categorical_drift(*_two_sides(spark, d), CATEGORICAL_FEATURES))


@query("drift_prediction")
def drift_prediction(spark, d):
    current, baseline = _two_sides(spark, d)
    predicted = [_recs(side) for side in (current, baseline)]
    return rounded(drift.categorical_drift(*predicted, ["recommended_action"]))


@query("drift_numeric")
def drift_numeric(spark, d):
    return rounded(drift.numeric_drift(*_two_sides(spark, d), NUMERIC_FEATURES))


@query("drift_ks_exact")
def drift_ks_exact(spark, d):
    return rounded(drift.ks_exact(*_two_sides(spark, d), NUMERIC_FEATURES))


@query("drift_consecutive")
def drift_consecutive(spark, d):
    events = warehouse_table(spark, d, "events")
    weekly = profiles.profile(events, "ts", "week", ["value"], ["event_type"])
    return rounded(profiles.drift_consecutive(weekly))


@query("performance_report")
def performance_report(spark, d):
    log = _log(spark, d)
    return log_ops.performance_report(log, log.agg(F.max("log_date")).scalar())


def _stored_log(spark, d):
    """The log as a table by date, and the path of it."""
    path, log = scratch_path(spark, "log"), _log(spark, d)
    append_log(log, path, batch_id="0")
    return read_log(spark, path, INFERENCE_LOG), path


@query("performance_report_from_bitmaps")
def performance_report_from_bitmaps(spark, d):
    """The report with distinct customers from bitmaps stored by day; one day's are written again."""
    log, path = _stored_log(spark, d)
    dates, stored = ledger.extent_of_dates(spark, path), scratch_path(spark, "customer_bitmaps")
    append_log(counts.key_bitmaps(log, "customer_id", ["log_date"]), stored, ["log_date"])
    again = log.filter(F.col("log_date") == F.lit(dates[1]))
    append_log(counts.key_bitmaps(again, "customer_id", ["log_date"]), stored, ["log_date"])
    return log_ops.performance_report(log, dates[1], customers=spark.read.parquet(stored))


@query("mean_drift_from_partitions")
def mean_drift_from_partitions(spark, d):
    """Drift between the first and the last date of the stored log, which are taken from its list of partitions."""
    log, path = _stored_log(spark, d)
    return rounded(log_ops.mean_drift(log, NUMERIC_FEATURES, dates=ledger.extent_of_dates(spark, path)))


@query("health_summary_from_partitions")
def health_summary_from_partitions(spark, d):
    log, path = _stored_log(spark, d)
    return rounded(log_ops.health_summary(log, ledger.extent_of_dates(spark, path)[1]))


@query("health_summary")
def health_summary(spark, d):
    log = _log(spark, d)
    return rounded(log_ops.health_summary(log, log.agg(F.max("log_date")).scalar()))


@query("monitor_status")
def monitor_status(spark, d):
    log = _log(spark, d)
    feats = _features(spark, d)
    stored = {
        "features": profiles.profile(feats, "updated_at", "day", NUMERIC_FEATURES),
        "inference_log": profiles.prediction_profile(log),
    }
    return readiness.monitor_status(spark, stored)
