import datetime as dt

import numpy as np
import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from actionspark.operators import profiles


def events(spark, n=2000):
    return spark.sql(
        f"""SELECT timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(id % 20 AS INT)) AS ts,
            IF(id % 5 = 0, NULL, concat('v', id % 2)) AS model_version,
            IF(id % 11 = 0, NULL, CAST((id * id) % 97 AS DOUBLE)) AS x, CAST(id AS DOUBLE) AS y,
            IF(id % 3 = 0, 'Email', 'SMS') AS recommended_action FROM range({n})"""
    )


def test_weeks_start_on_monday(spark):
    sunday = spark.sql("SELECT timestamp_ntz'2024-01-07 23:59:59' AS ts, 1.0D AS x")
    monday = spark.sql("SELECT timestamp_ntz'2024-01-08 00:00:00' AS ts, 1.0D AS x")
    out = profiles.profile(sunday.unionByName(monday), "ts", "week", ["x"]).orderBy("window_start").collect()
    assert [r["window_start"] for r in out] == [dt.date(2024, 1, 1), dt.date(2024, 1, 8)]
    with pytest.raises(ValueError):
        profiles.profile(sunday, "ts", "month", ["x"])


def test_exact_profile_against_numpy(spark):
    df = events(spark)
    got = {
        (r["window_start"], r["slice_value"], r["column_name"]): r
        for r in profiles.profile(df, "ts", "week", ["x", "y"], ["model_version"], exact=True).collect()
    }
    local = df.toPandas()
    local["w"] = local.ts.dt.to_period("W").dt.start_time.dt.date
    assert len(got) == 3 * (1 + 3) * 2
    for (w, s, c), r in got.items():
        part = local[(local.w == w)]
        if s != "all":
            part = part[part.model_version.isna()] if s == "unknown" else part[part.model_version == s]
        known = part[c].dropna().to_numpy()
        assert (r["n_rows"], r["n_null"], r["n_distinct"]) == (len(part), part[c].isna().sum(), len(set(known)))
        want = [known.mean(), known.std(ddof=1), known.min(), *np.quantile(known, [0.25, 0.5, 0.75]), known.max()]
        assert [r[k] for k in ("mean", "stddev", "min", "q25", "q50", "q75", "max")] == pytest.approx(want)


def test_sketched_profile_is_close_and_keeps_all_rows(spark):
    df = events(spark)
    exact = profiles.profile(df, "ts", "day", ["x"], exact=True)
    sketch = profiles.profile(df, "ts", "day", ["x"])
    both = exact.alias("e").join(sketch.alias("s"), "window_start").select(
        "e.n_rows", F.col("s.n_rows").alias("m"), "e.n_distinct", F.col("s.n_distinct").alias("d"), "e.mean", F.col("s.mean").alias("sm")
    )
    for r in both.collect():
        assert r["n_rows"] == r["m"] and abs(r["n_distinct"] - r["d"]) <= 0.1 * r["n_distinct"] + 1
        assert r["mean"] == pytest.approx(r["sm"])
    missing_ts = df.withColumn("ts", F.when(F.col("y") > 5, F.col("ts")))
    out = profiles.profile(missing_ts, "ts", "day", ["y"], exact=True)
    assert out.agg(F.sum("n_rows")).first()[0] == 2000
    assert out.filter("window_start IS NULL").first()["max"] == 5.0


def test_prediction_profile_shares(spark):
    out = profiles.prediction_profile(events(spark), ts="ts")
    sums = out.groupBy("window_start", "slice_key", "slice_value").agg(F.round(F.sum("share_pct"), 9).alias("s"))
    assert {r["s"] for r in sums.collect()} == {100.0}
    whole = out.filter("slice_key = 'all'").agg(F.sum("n_rows")).first()[0]
    parts = out.filter("slice_key = 'model_version'").agg(F.sum("n_rows")).first()[0]
    assert whole == parts == 2000


def test_consecutive_drift(spark):
    stored = profiles.profile(events(spark), "ts", "week", ["x", "y"], exact=True).orderBy("window_start")
    p = {(r["window_start"], r["column_name"]): r for r in stored.collect()}
    out = profiles.drift_consecutive(stored).collect()
    assert len(out) == 4
    for r in out:
        a, b = p[(r["previous_window"], r["column_name"])], p[(r["window_start"], r["column_name"])]
        assert r["delta_mean"] == pytest.approx(b["mean"] - a["mean"])
        assert r["shift_in_stddev"] == pytest.approx((b["mean"] - a["mean"]) / a["stddev"])
    later = profiles.drift_consecutive(stored, since=F.lit(dt.date(2024, 1, 15))).collect()
    assert {r["window_start"] for r in later} == {dt.date(2024, 1, 15)}
    once = profiles.drift_consecutive(profiles.profile(events(spark, 1), "ts", "week", ["x"]))
    assert once.count() == 0


@pytest.mark.parametrize("known_days", [0, 9, 20])
def test_refresh_equals_profiling_everything(spark, tmp_path, known_days):
    df = events(spark)
    path = str(tmp_path / "profile")
    seen = df.filter(F.col("ts") < F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(known_days)))
    profiles.profile(seen, "ts", "week", ["x"], exact=True).write.parquet(path)
    refreshed = profiles.refresh_profile(spark.read.parquet(path), df, "ts", "week", ["x"], exact=True)
    assert rows(refreshed) == rows(profiles.profile(df, "ts", "week", ["x"], exact=True))


def test_refresh_sees_late_replaced_missing_and_undated_rows(spark, tmp_path):
    df = events(spark).withColumn("ts", F.when(F.col("y") % 50 != 49, F.col("ts")))
    path = str(tmp_path / "profile")
    day = F.to_date("ts")
    seen = (
        df.filter(~((day == "2024-01-03") & (F.col("y") % 2 == 0)))  # comes late
        .withColumn("x", F.when(day == "2024-01-05", F.col("x") + 1).otherwise(F.col("x")))  # is replaced, same count
        .filter(F.col("ts").isNotNull() | (F.col("y") < 500))
        .unionByName(df.filter(day == "2024-01-06").withColumn("ts", F.col("ts") - F.make_dt_interval(F.lit(90))))  # goes
    )
    profiles.profile(seen, "ts", "day", ["x"], exact=True).write.parquet(path)
    stored = spark.read.parquet(path)
    stale = profiles.stale_windows(stored, df, "ts", "day", ["x"])
    assert stale == [None, dt.date(2023, 10, 8), dt.date(2024, 1, 3), dt.date(2024, 1, 5)]
    refreshed = profiles.refresh_profile(stored, df, "ts", "day", ["x"], exact=True)
    assert rows(refreshed) == rows(profiles.profile(df, "ts", "day", ["x"], exact=True))


def test_refresh_reads_only_stale_windows(spark, tmp_path):
    df, path = events(spark).filter("ts IS NOT NULL"), str(tmp_path / "events")
    df.write.parquet(path)
    source = spark.read.parquet(path)
    part = source.filter(profiles.in_windows("ts", "day", [dt.date(2024, 1, 3), dt.date(2024, 1, 4), dt.date(2024, 1, 9)]))
    text = plan(part)
    assert "GreaterThanOrEqual(ts,2024-01-03" in text and "LessThan(ts,2024-01-05" in text
    assert part.count() == 300
