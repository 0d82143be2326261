import datetime as dt

import pytest
from helpers import as_dict, partitions_read, raw_frame, rows
from pyspark.sql import functions as F

from actionspark.operators import logs
from actionspark.operators.features import features, on_date, trailing
from actionspark.sources.tables import append_log, read_log


def small_log(spark):
    return spark.createDataFrame(
        [
            (1, "Email", dt.date(2024, 1, 1), "1", 10.0, None),
            (2, "SMS", dt.date(2024, 1, 1), "1", 20.0, None),
            (1, "Email", dt.date(2024, 1, 20), "2", 30.0, 5.0),
            (None, "Push", dt.date(2024, 1, 27), "2", None, 7.0),
            (3, "Email", dt.date(2024, 1, 28), "2", 60.0, 8.0),
        ],
        "customer_id BIGINT, recommended_action STRING, log_date DATE, model_version STRING, x DOUBLE, y DOUBLE",
    )


def test_inference_log_keeps_recommendations_without_features(spark):
    feats = features(raw_frame(spark, [dict(age=20), dict(age=60)]), "2024-01-01 00:00:00")
    recs = logs.rule_scores(feats, "2024-01-01 00:00:00", F.lit(None).cast("string"))
    recs = recs.unionByName(recs.filter("customer_id = 1").withColumn("customer_id", F.lit(99).cast("long")))
    out = logs.inference_log(recs, feats, "2024-01-01", "2024-01-01 09:00:00")
    assert out.count() == 3 and len(out.columns) == 17
    got = as_dict(out, "customer_id")
    assert got[1]["recommended_action"] == "Push" and got[2]["recommended_action"] == "Email"
    assert got[99]["age"] is None and got[99]["recommended_action"] == "Push"
    assert got[1]["model_version"] == "unknown" and got[1]["log_date"] == dt.date(2024, 1, 1)


def test_mean_drift(spark):
    got = logs.mean_drift(small_log(spark), ["x", "y"]).collect()
    assert [tuple(r) for r in got] == [("x", 15.0, 60.0, 45.0), ("y", 0.0, 8.0, 8.0)]
    one_day = small_log(spark).filter("log_date = '2024-01-01'")
    assert all(r["delta"] == 0 for r in logs.mean_drift(one_day, ["x", "y"]).collect())
    assert logs.mean_drift(small_log(spark).filter(F.lit(False)), ["x"]).count() == 0


def test_mean_drift_reads_two_days_of_a_partitioned_log(spark, tmp_path):
    path = str(tmp_path / "log")
    days = spark.sql(
        "SELECT id AS customer_id, date_add(date'2024-01-01', CAST(id % 10 AS INT)) AS log_date, "
        "'1' AS model_version, CAST(id AS DOUBLE) AS x FROM range(100)"
    )
    append_log(days, path, batch_id="a")
    log = read_log(spark, path)
    out = logs.mean_drift(log, ["x"])
    assert out.first()["delta"] == 9.0
    assert partitions_read(out) == [2]
    newest = log.agg(F.max("log_date")).scalar()
    assert partitions_read(on_date(log, "log_date", newest)) == [1]
    assert partitions_read(trailing(log, "log_date", newest, 2)) == [3]


def test_performance_report(spark):
    got = {(r["section"], r["key"]): r["value"] for r in logs.performance_report(small_log(spark), "2024-01-28").collect()}
    assert got[("totals", "total_predictions")] == 5
    assert got[("totals", "unique_customers")] == 4  # NULL is one of them
    assert got[("totals", "recent_predictions")] == 2  # 21 January on: eight days, both ends
    assert got[("action", "Email")] == 3 and got[("version", "2")] == 3
    empty = rows(logs.performance_report(small_log(spark).filter(F.lit(False)), "2024-01-28"))
    assert empty == [("totals", k, 0) for k in ("recent_predictions", "total_predictions", "unique_customers")]


@pytest.mark.parametrize(
    "as_of,keep,status",
    [
        ("2024-01-28", True, "good"),
        ("2024-03-01", True, "none_recent"),
        ("2024-01-28", False, "no_logs"),
    ],
)
def test_health_summary(spark, as_of, keep, status):
    got = logs.health_summary(small_log(spark).filter(F.lit(keep)), as_of).collect()
    assert [r["key"] for r in got if r["section"] == "status"] == [status]
    if keep:
        assert {r["key"]: r["share_pct"] for r in got if r["section"] == "action"}["Email"] == 60.0
        assert {r["key"]: r["n"] for r in got if r["section"] == "totals"}["dates"] == 4
