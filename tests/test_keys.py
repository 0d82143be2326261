from helpers import as_dict, plan, rows
from pyspark.sql import functions as F

from actionspark.operators import keys


def frame(spark, data):
    return spark.createDataFrame(data, "k BIGINT, t INT, v STRING")


DATA = [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 5, None), (None, 1, "x"), (None, 2, "y"), (3, None, "n"), (3, None, "m")]


def test_duplicate_keys_counts_null_as_a_key(spark):
    assert rows(keys.duplicate_keys(frame(spark, DATA), ["k"])) == [(1, 3), (3, 2), (None, 2)]


def test_key_check(spark):
    r = keys.key_check(frame(spark, DATA), ["k"]).first().asDict()
    assert r == {"n_rows": 8, "duplicate_groups": 3, "null_key_rows": 2, "key_ok": False}
    one_null = frame(spark, [(1, 1, "a"), (None, 1, "x")])
    r = keys.key_check(one_null, ["k"]).first()
    assert (r["duplicate_groups"], r["null_key_rows"], r["key_ok"]) == (0, 1, False)
    r = keys.key_check(frame(spark, [(1, 1, "a"), (2, 1, "x")]), ["k"]).first()
    assert r["key_ok"]
    r = keys.key_check(frame(spark, []), ["k"]).first()
    assert (r["n_rows"], r["duplicate_groups"], r["null_key_rows"], r["key_ok"]) == (0, 0, 0, True)


def test_dedupe_is_deterministic(spark):
    want = [(1, 2, "c"), (2, 5, None), (3, None, "n")]
    for parts in (1, 5):
        df = frame(spark, DATA).repartition(parts)
        assert rows(keys.dedupe_latest(df, ["k"], ["t"])) == want
    assert keys.dedupe_latest(frame(spark, DATA), ["k"], ["t"]).columns == ["k", "t", "v"]


def test_dedupe_of_a_hot_key_ships_one_candidate_per_task(spark):
    hot = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    out = keys.dedupe_latest(hot, ["k"], ["t"])
    assert "Window" not in plan(out) and "partial_max" in plan(out)
    assert out.filter("k = 0").first()["t"] == 39_999


def test_null_rates(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, None), (4, 1.0)], "a INT, b DOUBLE")
    got = as_dict(keys.null_rates(df, ["a", "b"]), "feature")
    assert (got["a"]["n_null"], got["a"]["null_rate_pct"], got["a"]["flagged"]) == (1, 25.0, True)
    assert (got["b"]["n_null"], got["b"]["null_rate_pct"]) == (3, 75.0)
    empty = as_dict(keys.null_rates(df.limit(0), ["a"]), "feature")["a"]
    assert (empty["n_rows"], empty["null_rate_pct"], empty["flagged"]) == (0, 0.0, False)
    twenty = spark.range(20).select(F.when(F.col("id") > 0, F.col("id")).alias("a"))
    assert as_dict(keys.null_rates(twenty, ["a"]), "feature")["a"]["flagged"] is False  # exactly 5 %


def test_null_rates_is_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id AS a", "id AS b", "id AS c").write.parquet(path)
    assert plan(keys.null_rates(spark.read.parquet(path), ["a", "b"])).count("FileScan") == 1


def test_duplicate_rate_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k INT")
    r = keys.duplicate_rate(df, "k").first()
    assert (r["n_distinct"], r["duplicate_rate_pct"], r["flagged"]) == (3, 40.0, True)
    r = keys.duplicate_rate(df.limit(0), "k").first()
    assert (r["n_rows"], r["duplicate_rate_pct"], r["flagged"]) == (0, 0.0, False)
