import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import as_dict, plan
from pyspark.sql import functions as F

from actionspark.operators import drift


def brute_categorical(cur, base):
    c, b = Counter(cur), Counter(base)
    cats, n, m = set(c) | set(b), len(cur), len(base)
    k = len(cats)
    tv = psi = js = chi = 0.0
    for x in cats:
        p, q = c[x] / n, b[x] / m
        tv += abs(p - q) / 2
        sp, sq = (c[x] + 0.5) / (n + 0.5 * k), (b[x] + 0.5) / (m + 0.5 * k)
        psi += (sp - sq) * math.log(sp / sq)
        mid = (p + q) / 2
        js += 0.5 * sum(s * math.log2(s / mid) for s in (p, q) if s)
        for obs, tot in ((c[x], n), (b[x], m)):
            e = (c[x] + b[x]) * tot / (n + m)
            chi += (obs - e) ** 2 / e
    return k, tv, psi, math.sqrt(js), chi


def test_categorical_drift(spark):
    rnd = random.Random(2)
    base = [rnd.choice(["a", "a", "b", None]) for _ in range(300)]
    cur = [rnd.choice(["a", "b", "b", "c", None]) for _ in range(200)]
    frames = [spark.createDataFrame([(v,) for v in x], "f STRING") for x in (cur, base)]
    r = drift.categorical_drift(*frames, ["f"]).first()
    got = (r["n_categories"], r["total_variation"], r["psi"], r["js_distance"], r["chi2"])
    assert got == pytest.approx(brute_categorical(cur, base))
    same = drift.categorical_drift(frames[0], frames[0], ["f"]).first()
    assert [same[c] for c in ("total_variation", "psi", "js_distance", "chi2")] == pytest.approx([0, 0, 0, 0])


def brute_ks(cur, base):
    grid = sorted(set(cur) | set(base))
    f = lambda xs: np.searchsorted(np.sort(xs), grid, side="right") / len(xs)
    return float(np.abs(f(cur) - f(base)).max())


def test_numeric_drift_and_exact_ks(spark):
    rnd = np.random.default_rng(4)
    base, cur = rnd.normal(0, 1, 700), rnd.normal(0.4, 1.3, 500)
    data = [spark.createDataFrame([(float(v), 3.0, None) for v in x], "v DOUBLE, c DOUBLE, z DOUBLE") for x in (cur, base)]
    got = as_dict(drift.numeric_drift(*data, ["v", "c"]), "feature")
    v = got["v"]
    assert v["delta_mean"] == pytest.approx(cur.mean() - base.mean())
    lo, hi = base.min(), base.max()
    w = (hi - lo) / 10
    bins = lambda xs: np.where(xs < lo, 0, np.where(xs > hi, 11, 1 + np.minimum(np.floor((xs - lo) / w), 9)))
    hc, hb = (np.bincount(bins(x).astype(int), minlength=12) for x in (cur, base))
    assert v["ks"] == pytest.approx(np.abs(hc.cumsum() / 500 - hb.cumsum() / 700).max())
    p, q = (hc + 0.5) / (500 + 6), (hb + 0.5) / (700 + 6)
    assert v["psi"] == pytest.approx(((p - q) * np.log(p / q)).sum())
    assert (got["c"]["ks"], got["c"]["delta_mean"]) == (0.0, 0.0)

    exact = as_dict(drift.ks_exact(*data, ["v", "c"]), "feature")
    assert exact["v"]["ks"] == pytest.approx(brute_ks(cur, base)) and exact["c"]["ks"] == 0.0
    assert (exact["v"]["n_baseline"], exact["v"]["n_current"]) == (700, 500)
    assert drift.ks_exact(data[0], data[0], ["v"]).first()["ks"] == 0.0
    shifted = drift.ks_exact(data[0].withColumn("v", F.col("v") + 1000), data[1], ["v"]).first()
    assert shifted["ks"] == 1.0


def test_drift_with_values_outside_the_baseline_and_nulls(spark):
    base = spark.createDataFrame([(float(i),) for i in range(10)], "v DOUBLE")
    cur = spark.createDataFrame([(-5.0,), (100.0,), (None,), (5.0,)], "v DOUBLE")
    r = drift.numeric_drift(cur, base, ["v"]).first()
    assert (r["total_baseline"], r["total_current"]) == (10, 3)
    assert r["ks"] == pytest.approx(1 / 3)
    nulls = base.withColumn("v", F.lit(None).cast("double"))
    assert drift.numeric_drift(nulls, base, ["v"]).first()["ks"] is None


def test_drift_does_not_depend_on_partitioning(spark):
    a, b = spark.range(500).select((F.col("id") % 17).cast("double").alias("v")), spark.range(300).select((F.col("id") % 13).cast("double").alias("v"))
    one = drift.ks_exact(a.repartition(1), b.repartition(1), ["v"]).first()
    many = drift.ks_exact(a.repartition(8), b.repartition(7), ["v"]).first()
    assert one == many


def test_numeric_drift_is_wide_and_leaves_nan_out(spark):
    base = spark.createDataFrame([(float(i), float(i % 3)) for i in range(10)], "v DOUBLE, w DOUBLE")
    cur = spark.createDataFrame([(1.0, math.nan), (math.nan, 1.0), (math.inf, None), (5.0, 2.0)], "v DOUBLE, w DOUBLE")
    out = drift.numeric_drift(cur, base, ["v", "w"])
    got = as_dict(out, "feature")
    assert (got["v"]["total_current"], got["w"]["total_current"], got["v"]["total_baseline"]) == (3, 2, 10)
    assert "Expand" not in plan(out) and "EvalPython" not in plan(out)
