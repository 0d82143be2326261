import hashlib
import math
from collections import Counter

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from actionspark.operators import training


def test_training_set_joins(spark):
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "customer_id BIGINT, action_label INT")
    feats = spark.createDataFrame([(1, 9.0), (3, None), (7, 1.0)], "customer_id BIGINT, x DOUBLE")
    assert rows(training.training_set(labels, feats, ["x"])) == [(1, 0, 9.0), (3, 2, None)]
    left = training.training_set(labels, feats, ["x"], "left")
    assert rows(left) == [(1, 0, 9.0), (2, 1, None), (3, 2, None)]
    with pytest.raises(ValueError):
        training.training_set(labels, feats, ["x"], "outer")


def u32(key, seed):
    return int(hashlib.md5(f"{key}:{seed}".encode()).hexdigest()[:8], 16)


def brute_quotas(counts, test):
    total = sum(counts.values())
    n_train = total - math.ceil(total * test)
    want = {c: n_train * n / total for c, n in counts.items()}
    train = {c: math.floor(w) for c, w in want.items()}
    order = sorted(counts, key=lambda c: (-(want[c] - math.floor(want[c])), c))
    for c in order[: n_train - sum(train.values())]:
        train[c] += 1
    return {c: counts[c] - train[c] for c in counts}


@pytest.mark.parametrize("n,test,seed", [(1000, 0.25, 42), (37, 0.25, 1), (8, 0.5, 3), (500, 0.1, 42)])
def test_exact_split_equals_ranking_whole_classes(spark, n, test, seed):
    df = spark.range(n).select("id", F.when(F.col("id") % 7 < 4, 0).when(F.col("id") % 7 < 6, 1).otherwise(2).alias("y"))
    label = {r["id"]: r["y"] for r in df.collect()}
    quota = brute_quotas(Counter(label.values()), test)
    want = set()
    for c, q in quota.items():
        ranked = sorted((i for i in label if label[i] == c), key=lambda i: (u32(i, seed), i))
        want |= set(ranked[:q])
    for parts in (1, 6):
        out = training.exact_split(df.repartition(parts), "id", "y", test, seed)
        assert out.columns == ["id", "y", "split"] and out.count() == n
        assert {r["id"] for r in out.filter("split = 'test'").collect()} == want


def test_exact_split_edges(spark):
    tiny = spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, None)], "id BIGINT, y INT")
    out = training.exact_split(tiny, "id", "y", 0.25)
    assert out.count() == 4 and out.filter("split = 'test'").count() == 1
    assert training.exact_split(tiny.limit(0), "id", "y").count() == 0


def test_hash_split_is_shuffle_free_and_stable(spark):
    df = spark.range(4000)
    out = training.hash_split(df, "id", 0.25, 42)
    assert "Exchange" not in plan(out)
    got = {r["id"] for r in out.filter("split = 'test'").collect()}
    assert got == {i for i in range(4000) if u32(i, 42) < 0.25 * 2**32}
    assert abs(len(got) / 4000 - 0.25) < 0.03


def test_quotas_of_very_many_classes(spark):
    df = spark.range(45_000).select("id", F.when(F.col("id") < 40_000, F.col("id") % 20_000).otherwise(F.lit(3)).alias("y"))
    counts = Counter(r["y"] for r in df.collect())
    assert {r["y"]: r["test_quota"] for r in training.test_quotas(df, "y").collect()} == brute_quotas(counts, 0.25)
    assert training.exact_split(df, "id", "y").filter("split = 'test'").count() == 11_250
