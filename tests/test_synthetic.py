import math

import pytest
from helpers import rows
from pyspark.sql import functions as F

from actionspark.functions.rules import best_action
from actionspark.sources.schemas import RAW_CUSTOMERS
from actionspark.sources.synthetic import GENDER_SHARES, REGION_SHARES, TOP_CATEGORIES, generate_customers, synthesize

N = 60_000


@pytest.fixture(scope="module")
def customers(spark):
    return generate_customers(spark, N, 42).cache()


def test_schema_keys_and_domains(customers):
    assert [(f.name, f.dataType) for f in customers.schema] == [(f.name, f.dataType) for f in RAW_CUSTOMERS]
    r = customers.agg(
        F.min("customer_id"), F.max("customer_id"), F.count_distinct("customer_id"), F.min("age"), F.max("age"),
        F.min("income"), F.max("income"), F.min("browsing_minutes_last_week"), F.min("purchase_amount_last_month"),
    ).first()
    assert r[:3] == (1, N, N) and r[3:5] == (18, 70)
    assert 20_000 <= r[5] and r[6] <= 250_000 and r[7] > 0 and r[8] >= 0
    nulls = customers.agg(*[F.sum(F.col(c).isNull().cast("int")) for c in customers.columns]).first()
    assert set(nulls) == {0}


def near(value, mean, sd, n=N):
    assert abs(value - mean) < 4.5 * sd / math.sqrt(n), (value, mean)


def test_moments(customers):
    r = customers.agg(
        F.avg("age").alias("age"),
        F.avg("num_purchases_last_month").alias("n"),
        F.var_samp("num_purchases_last_month").alias("nv"),
        F.avg("browsing_minutes_last_week").alias("b"),
        F.var_samp("browsing_minutes_last_week").alias("bv"),
        F.avg(F.col("purchase_amount_last_month") / (1 + F.col("income") / 250_000)).alias("g"),
        F.avg("income").alias("i"),
    ).first()
    near(r["age"], 44, 15.3)
    near(r["n"], 2.2, math.sqrt(2.2))
    near(r["nv"], 2.2, 2.2 * math.sqrt(2 + 1 / 2.2))
    near(r["b"], 55, math.sqrt(1375))
    near(r["bv"], 1375, 1375 * math.sqrt(2 + 6 / 2.2))
    near(r["g"], 240, 120 * math.sqrt(2))
    near(r["i"], 80_000 + 25_000 * 0.0029, 25_000)  # the lower clip moves the mean by less than 0.3 % of sd


def test_shares(customers):
    def shares(c):
        return {r[c]: r["count"] / N for r in customers.groupBy(c).count().collect()}

    for name, expected in (("gender", GENDER_SHARES), ("region", REGION_SHARES)):
        got = shares(name)
        assert set(got) == {v for v, _ in expected}
        for v, p in expected:
            near(got[v], p, math.sqrt(p * (1 - p)))
    got = shares("top_category")
    assert set(got) == set(TOP_CATEGORIES)
    for v in TOP_CATEGORIES:
        near(got[v], 1 / 7, math.sqrt(6) / 7)


def test_poisson_distribution(customers):
    counts = {r[0]: r[1] for r in customers.groupBy("num_purchases_last_month").count().collect()}
    for k in range(7):
        p = math.exp(-2.2) * 2.2**k / math.factorial(k)
        near(counts[k] / N, p, math.sqrt(p * (1 - p)))


def test_labels_follow_the_stored_columns(customers):
    assert customers.filter(F.col("best_action") != best_action()).count() == 0


def test_rows_do_not_depend_on_partitioning_but_on_the_seed(spark):
    keys = spark.range(1, 301).toDF("customer_id")
    one = rows(synthesize(keys.repartition(1)))
    assert one == rows(synthesize(keys.repartition(8))) == rows(generate_customers(spark, 300))
    assert one != rows(synthesize(keys, seed=7))
