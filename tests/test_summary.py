import math
import random

import numpy as np
import pytest
from helpers import as_dict, plan
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from actionspark.functions.ranks import FULL_BIN, cumulative_counts, exact_quantiles, sliced, value_counts
from actionspark.operators import summary

PROBS = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}


def check_quantiles(spark, data):
    df = spark.createDataFrame(data, "g STRING, v DOUBLE").repartition(5)
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", PROBS).collect()}
    groups = {g for g, v in data if v is not None}
    assert set(got) == groups
    for g in groups:
        values = [v for k, v in data if k == g and v is not None]
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12), (g, name)


def test_quantiles_over_scales_signs_repeats_and_null_groups(spark):
    rnd = random.Random(7)
    data = [("wide", rnd.choice([-1, 1]) * 10 ** rnd.uniform(-6, 9)) for _ in range(400)]
    data += [("narrow", 1.7e9 + rnd.random()) for _ in range(300)]
    data += [("hot", 5.0)] * 900 + [("hot", float(i)) for i in range(20)]
    data += [(None, float(i)) for i in range(7)] + [("one", -3.5), ("gap", None)]
    data += [("zeros", 0.0), ("zeros", -0.0), ("zeros", 1.0)]
    check_quantiles(spark, data)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.floats(-1e6, 1e6, width=32))),
        min_size=1,
        max_size=40,
    )
)
def test_quantiles_match_numpy(spark, data):
    check_quantiles(spark, data)


def test_hot_value_is_one_row_after_counting(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 1.5).otherwise(F.col("id").cast("double")).alias("v"))
    counted = value_counts(df, [], "v")
    assert counted.filter("v = 1.5").first()["n"] == 3000 and counted.count() == 6001
    ranked = cumulative_counts(counted, [], "v")
    assert ranked.agg(F.max("cum_n"), F.min("total_n"), F.max("total_n")).first()[:] == (9000, 9000, 9000)


def test_numeric_summary_exact_and_sketched(spark):
    rnd = np.random.default_rng(3)
    values = rnd.gamma(2.2, 25.0, 4000).round(2)
    df = spark.createDataFrame([(float(v), None if i % 4 else int(i)) for i, v in enumerate(values)], "x DOUBLE, y INT")
    exact = as_dict(summary.numeric_summary(df, ["x", "y"], exact=True), "feature")
    assert exact["x"]["mean"] == pytest.approx(values.mean())
    assert exact["x"]["stddev"] == pytest.approx(values.std(ddof=1))
    assert exact["x"]["q25"] == pytest.approx(np.quantile(values, 0.25))
    assert exact["y"]["n"] == 1000 and exact["y"]["max"] == 3996.0
    sketched = as_dict(summary.numeric_summary(df, ["x", "y"]), "feature")
    for q in ("q25", "q50", "q75"):
        rank = np.searchsorted(np.sort(values), sketched["x"][q]) / len(values)
        assert abs(rank - float(q[1:]) / 100) < 0.002
    empty = as_dict(summary.numeric_summary(df.withColumn("x", F.lit(None).cast("double")), ["x"], exact=True), "feature")
    assert empty["x"]["n"] == 0 and empty["x"]["q50"] is None and empty["x"]["mean"] is None


def test_correlation_pairs_nulls_and_guards_constants(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, None, 0), (2.0, 5.0, 1.0, 1), (4.0, 5.0, 2.0, 2), (None, 5.0, 9.0, 2), (3.0, 5.0, 7.0, None)],
        "a DOUBLE, c DOUBLE, b DOUBLE, y INT",
    )
    out = summary.label_correlation(df, ["a", "b", "c"], "y").collect()
    got = {r["feature"]: r["corr_with_label"] for r in out}
    assert got["a"] == pytest.approx(np.corrcoef([1, 2, 4], [0, 1, 2])[0, 1])
    assert got["b"] == pytest.approx(np.corrcoef([1, 2, 9], [1, 2, 2])[0, 1])
    assert got["c"] is None and out[-1]["feature"] == "c"
    assert plan(summary.label_correlation(df, ["a", "b"], "y")).count("partial_covar_pop") <= 4


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 1, 24, 25)] + [(None,)], "v DOUBLE")
    got = {r["bin"]: r["n_rows"] for r in summary.histogram(df, "v", 25).collect()}
    assert len(got) == 25 and got[0] == 1 and got[1] == 2 and got[24] == 2 and sum(got.values()) == 5
    const = [r for r in summary.histogram(df.select(F.lit(7).alias("v")), "v", 25).collect() if r["n_rows"]]
    assert len(const) == 1 and const[0]["n_rows"] == 6 and const[0]["lower"] <= 7 < const[0]["upper"]
    assert summary.histogram(df.limit(0), "v").count() == 0


@pytest.mark.parametrize("exact", [True, False])
def test_boxplot_matches_definition(spark, exact):
    rnd = random.Random(5)
    data = [(rnd.choice(["a", "b", None]), rnd.gauss(0, 1) ** 3 * 10) for _ in range(500)] + [("c", 4.0)]
    df = spark.createDataFrame(data, "g STRING, v DOUBLE")
    got = {r["g"]: r for r in summary.boxplot_stats(df, "v", "g", exact=exact).collect()}
    for g in ("a", "b", "c", None):
        values = np.array([v for k, v in data if k == g])
        if exact:
            q1, q3 = np.quantile(values, 0.25), np.quantile(values, 0.75)
            assert got[g]["q25"] == pytest.approx(q1) and got[g]["q75"] == pytest.approx(q3)
        else:
            q1, q3 = got[g]["q25"], got[g]["q75"]
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = values[(values >= lo) & (values <= hi)]
        assert got[g]["whisker_low"] == inside.min() and got[g]["whisker_high"] == inside.max()
        assert got[g]["n_outliers"] == len(values) - len(inside) and got[g]["n"] == len(values)
        assert not math.isnan(got[g]["q50"])


def test_nan_is_last_and_infinities_have_ranks(spark):
    nan, inf = math.nan, math.inf
    df = spark.createDataFrame([("n", v) for v in (1.0, 2.0, 3.0, 4.0, nan)] + [("i", v) for v in (-inf, 0.0, 1.0, inf, inf)], "g STRING, v DOUBLE")
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"a": 0.25, "b": 0.5, "c": 0.75, "d": 1.0}).collect()}
    assert [got["n"][c] for c in "abc"] == [2.0, 3.0, 4.0] and math.isnan(got["n"]["d"])
    assert [got["i"][c] for c in "abcd"] == [0.0, 1.0, inf, inf]


@pytest.mark.parametrize(
    "value",
    ["id + 1.7e15D", "id * 60000000 + 1.7e15D", "id * 1e-12D", "id * 1e-300D", "pow(10.0D, -id % 300) * (id + 1)", "-id * 1e-9D", "1e308D + id * 1e300D"],
)
def test_no_task_sorts_more_than_a_small_share(spark, value):
    df = spark.sql(f"SELECT DISTINCT CAST({value} AS DOUBLE) AS v FROM range(60000)")
    counted = value_counts(df, [], "v")
    n = counted.count()
    placed = sliced(counted, [], "v")
    largest = placed.groupBy("_bin", "_slice").count().agg(F.max("count")).first()[0]
    assert largest <= max(FULL_BIN, n // 50) and placed.count() == n
    values = sorted(r["v"] for r in df.collect())
    got = exact_quantiles(df, [], "v", {"a": 0.25, "b": 0.9}).first()
    assert got[0] == pytest.approx(np.quantile(values, 0.25)) and got[1] == pytest.approx(np.quantile(values, 0.9))


def test_histogram_leaves_nan_out(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, math.nan, None, math.inf, -math.inf)], "v DOUBLE")
    got = summary.histogram(df, "v", 3).collect()
    assert [r["n_rows"] for r in got] == [2, 0, 2] and {r["n_nan"] for r in got} == {1}
    assert (got[0]["lower"], got[-1]["upper"]) == (1.0, 2.0)
    assert summary.histogram(df.filter("isnan(v)"), "v", 3).count() == 0


def test_quartile_check_sees_a_wrong_quartile(spark):
    values = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("value"))
    given_ = spark.createDataFrame([("a", 249.0, 510.0, 750.0)], "g STRING, q25 DOUBLE, q50 DOUBLE, q75 DOUBLE")
    r = summary.quartile_check(values, ["g"], given_, 0.002).first()
    assert (r["n"], r["q25_ok"], r["q50_ok"], r["q75_ok"]) == (1000, True, False, True)
