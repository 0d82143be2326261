"""Sketches and bitmaps that merge, lookups as of a time, streams into the log."""

import math
import random
import statistics

import pytest
from helpers import as_dict, optimized, rows
from pyspark.sql import functions as F

from actionspark.operators import counts, drift, logs, profiles, training
from actionspark.sources.tables import read_log
from actionspark.streaming.logging import decided_once, follow_counts, followed, log_batch


def values(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    rows_ = [(f"2024-01-{1 + i % 14:02d} 10:00:00", rnd.choice([None, rnd.gauss(5, 2), 7.0]), "ab"[i % 2]) for i in range(n)]
    return spark.createDataFrame(rows_, "ts STRING, x DOUBLE, kind STRING").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_weeks_merge_from_days(spark):
    df = values(spark)
    days = profiles.day_sketches(df, "ts", ["x"], ["kind"])
    merged = profiles.sketch_profile(profiles.merged_sketches(days, "week"), "week")
    exact = profiles.profile(df, "ts", "week", ["x"], ["kind"], exact=True)
    key = lambda r: (r.window_start, r.slice_key, r.slice_value)
    got, want = ({key(r): r for r in f.collect()} for f in (merged, exact))
    assert got.keys() == want.keys() and set(merged.columns) == set(exact.columns) - {"content"}
    for k, r in got.items():
        w = want[k]
        assert (r.n_rows, r.n_null, r.min, r.max) == (w.n_rows, w.n_null, w.min, w.max)
        assert r.mean == pytest.approx(w.mean) and r.stddev == pytest.approx(w.stddev)
        assert abs(r.n_distinct - w.n_distinct) <= 0.1 * w.n_distinct
        known = sorted(x.x for x in df.collect() if x.x is not None and (k[1] == "all" or x.kind == k[2]) and x.ts.isocalendar().week == k[0].isocalendar().week)
        for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            low, high = sum(v < r[q] for v in known), sum(v <= r[q] for v in known)
            assert low / len(known) - 0.01 <= p <= high / len(known) + 0.01


def test_sketches_of_no_value_and_of_one(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", None, 1.0), ("2024-01-02 00:00:00", None, math.nan)], "ts STRING, x DOUBLE, y DOUBLE")
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    days = profiles.day_sketches(df, "ts", ["x", "y"])
    got = as_dict(profiles.sketch_profile(profiles.merged_sketches(days, "week"), "week"), "column_name")
    assert got["x"]["n_null"] == 2 and got["x"]["q50"] is None and got["x"]["mean"] is None and got["x"]["stddev"] is None
    assert got["y"]["n_null"] == 0 and got["y"]["q50"] == 1.0 and got["y"]["n_rows"] == 2


def test_ks_of_sketches(spark):
    one, two = values(spark, 4000, 1), values(spark, 2500, 2).withColumn("x", F.col("x") * 1.2)
    sides = [profiles.merged_sketches(profiles.day_sketches(f, "ts", ["x"])) for f in (two, one)]
    got = profiles.ks_of_sketches(*sides).first()
    want = drift.ks_exact(two, one, ["x"]).first()
    assert (got.n_baseline, got.n_current) == (want.n_baseline, want.n_current)
    assert got.ks == pytest.approx(want.ks, abs=0.02) and want.ks > 0.1


def test_bitmaps_count_what_distinct_counts(spark):
    rnd = random.Random(3)
    rows_ = [(rnd.randrange(3), rnd.choice([None, -5, 0, 1, 32767, 32768, 32769, 10**12, rnd.randrange(100000)])) for _ in range(500)]
    df = spark.createDataFrame(rows_, "day INT, k BIGINT")
    bitmaps = counts.key_bitmaps(df, "k", ["day"])
    for some in (F.lit(True), F.col("day") == 1, F.col("day") == 7):
        exact = df.filter(some).select("k").distinct().count()
        assert counts.distinct_of_bitmaps(bitmaps.filter(some)).first()[0] == exact
    no_null = df.filter("k IS NOT NULL")
    assert counts.distinct_of_bitmaps(counts.key_bitmaps(no_null, "k", [])).first()[0] == no_null.select("k").distinct().count()


def brute_as_of(asked, history):
    out = []
    for k, t, n in asked:
        held = [(s, v, w) for key, s, v, w in history if key == k and s is not None and t is not None and s <= t and k is not None]
        best = max(held, default=None, key=lambda h: (h[0], tuple((x is not None, x) for x in h[1:])))
        out.append((k, t, n, *(best[1:] if best else (None, None))))
    return out


@pytest.mark.parametrize("ranges", [1, 2, 5, 64])
def test_features_as_of(spark, ranges):
    rnd = random.Random(ranges)
    hot = lambda: rnd.choice([1, 1, 1, 2, 3, None])
    asked = [(hot(), rnd.choice([None, *range(60)]), i) for i in range(300)] + [(1, 30, 0)] * 3
    history = [(hot(), rnd.choice([None, *range(5, 55)]), rnd.choice([None, rnd.randrange(9)]), rnd.choice(["a", None])) for i in range(200)]
    at = lambda c: F.when(F.col(c).isNotNull(), F.timestamp_seconds(F.col(c) * 3600)).cast("timestamp_ntz")
    left = spark.createDataFrame(asked, "k INT, h INT, n INT").withColumn("at", at("h"))
    right = spark.createDataFrame(history, "k INT, s INT, v INT, w STRING").withColumn("since", at("s"))
    got = training.features_as_of(left, right, "k", "at", "since", ["v", "w"], ranges)
    assert got.columns == ["k", "h", "n", "at", "v", "w"]
    assert sorted(map(repr, rows(got.drop("at"), None))) == sorted(map(repr, brute_as_of(asked, history)))
    none = training.features_as_of(left, right.limit(0), "k", "at", "since", ["v", "w"], ranges)
    assert none.count() == len(asked) and none.filter("v IS NOT NULL").count() == 0


def test_numeric_drift_of_many_columns_has_a_small_plan(spark):
    names = [f"c{i}" for i in range(40)]
    one = spark.range(100).select(*[(F.col("id") * (i + 1) % 17).cast("double").alias(c) for i, c in enumerate(names)])
    sizes = [len(optimized(drift.numeric_drift(one, one, names[:n]))) for n in (10, 40)]
    assert sizes[1] < 5 * sizes[0]
    got = drift.numeric_drift(one, one.filter("false"), names[:2]).collect()
    assert [r.total_baseline for r in got] == [0, 0]


def scored(version):
    return lambda df: logs.rule_scores(df, F.col("updated_at"), version)


def request_rows(spark, n, start=0):
    from helpers import raw_frame

    from actionspark.operators.features import features

    return features(raw_frame(spark, [{"age": 20 + i} for i in range(n)]), "2024-01-01 00:00:00").withColumn(
        "customer_id", F.col("customer_id") + start
    )


def test_a_batch_run_again_replaces_itself_whatever_the_champion(spark, tmp_path):
    log, decisions = str(tmp_path / "log"), str(tmp_path / "decisions")
    log_batch(request_rows(spark, 5), 0, log, decisions, lambda: "1", scored)
    log_batch(request_rows(spark, 4, 100), 1, log, decisions, lambda: "1", scored)
    log_batch(request_rows(spark, 4, 100), 1, log, decisions, lambda: "2", scored)  # promoted meanwhile
    log_batch(request_rows(spark, 3, 200), 2, log, decisions, lambda: "2", scored)
    got = read_log(spark, log)
    assert got.count() == 12
    assert {(r.batch_id, r.model_version) for r in got.collect()} == {("stream-0", "1"), ("stream-1", "1"), ("stream-2", "2")}
    assert got.filter("income IS NULL").count() == 0
    assert decided_once(spark, decisions, "000000000000", lambda: "9") == "1"


def test_streamed_profile_counts_late_rows_and_forgets_closed_days(spark, tmp_path):
    source, table, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "ts TIMESTAMP_NTZ, v DOUBLE"

    def arrive(*rows_):
        frame = spark.createDataFrame([(t, v) for t, v in rows_], "ts STRING, v DOUBLE")
        frame.select(F.col("ts").cast("timestamp_ntz").alias("ts"), "v").coalesce(1).write.mode("append").parquet(source)
        follow_counts(spark.readStream.schema(schema).parquet(source), "ts", "v", table, state, "2 days").awaitTermination()

    arrive(("2024-01-01 10:00:00", 1.0), ("2024-01-02 10:00:00", 2.0))
    arrive(("2024-01-01 12:00:00", 3.0))  # late, within two days
    arrive(("2024-01-09 12:00:00", 5.0))
    arrive(("2024-01-01 13:00:00", 100.0), ("2024-01-09 13:00:00", None))  # the first is behind the watermark
    got = {str(r.window_start): (r.n_rows, r.n, r.cents, r.min, r.max) for r in followed(spark, table).collect()}
    assert got == {
        "2024-01-01": (2, 2, 400, 1.0, 3.0), "2024-01-02": (1, 1, 200, 2.0, 2.0), "2024-01-09": (2, 1, 500, 5.0, 5.0),
    }
    assert statistics.fmean([1.0, 3.0]) == got["2024-01-01"][2] / got["2024-01-01"][1] / 100
