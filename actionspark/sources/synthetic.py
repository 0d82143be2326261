"""Seeded synthetic customers as expressions over a key column; any number of rows, no driver-side loop."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actionspark.functions.rules import best_action
from actionspark.sources.schemas import RAW_CUSTOMERS

# The distributions of the synthetic customers.
GENDER_SHARES = (("M", 0.48), ("F", 0.52))
REGION_SHARES = (("Northeast", 0.20), ("Midwest", 0.23), ("South", 0.35), ("West", 0.22))
TOP_CATEGORIES = ("Beauty", "Electronics", "Fashion", "Home", "Grocery", "Sports", "Toys")
AGE_RANGE = (18, 70)
INCOME_MEAN, INCOME_SD, INCOME_RANGE = 80_000, 25_000, (20_000, 250_000)
PURCHASES_MEAN = 2.2
SPEND_SHAPE, SPEND_SCALE, SPEND_INCOME_UNIT = 2.0, 120.0, 250_000
BROWSE_SHAPE, BROWSE_SCALE = 2.2, 25.0

GAMMA_TRIES = 12


class _Draws:
    """Independent uniforms in (0, 1) per row, numbered; they depend on key and seed only, so neither
    partitioning nor a task retry changes a row."""

    def __init__(self, key: str, seed: int):
        self.key, self.seed, self.used = F.col(key), seed, 0

    def uniform(self) -> Column:
        self.used += 1
        bits = F.shiftrightunsigned(F.xxhash64(self.key, F.lit(self.seed), F.lit(self.used)), 11)
        return (bits + F.lit(0.5)) / F.lit(float(2**53))

    def normal(self) -> Column:
        radius = F.sqrt(-2.0 * F.ln(self.uniform()))
        return radius * F.cos(F.lit(2.0 * math.pi) * self.uniform())

    def choice(self, weighted) -> Column:
        u, acc, out = self.uniform(), 0.0, None
        *head, (last, _) = weighted
        for value, weight in head:
            acc += weight
            out = F.when(u < acc, value) if out is None else out.when(u < acc, value)
        return out.otherwise(last)

    def poisson(self, mean: float) -> Column:
        """Inverse of the distribution function: how many of its steps lie below the uniform."""
        u, term, total, steps = self.uniform(), math.exp(-mean), 0.0, []
        for k in range(40):
            total += term
            if total >= 1.0 - 2.0**-53:
                break
            steps.append((u > total).cast("long"))
            term *= mean / (k + 1)
        return sum(steps[1:], steps[0])

    def gamma(self, shape: float, scale: float) -> Column:
        """Marsaglia and Tsang's method for shape >= 1: the first accepted try of a fixed number.

        A try fails with a probability below 5 %; should all fail, the mean of the method's core is used.
        """
        d = shape - 1.0 / 3.0
        c = 1.0 / math.sqrt(9.0 * d)
        tries = []
        for _ in range(GAMMA_TRIES):
            x, u = self.normal(), self.uniform()
            cube = F.pow(1.0 + c * x, F.lit(3.0))
            accepted = (cube > 0) & (F.ln(u) < 0.5 * x * x + d - d * cube + d * F.ln(cube))
            tries.append(F.when(accepted, d * scale * cube))
        return F.coalesce(*tries, F.lit(d * scale))


def synthesize(keys: DataFrame, key: str = "customer_id", seed: int = 42) -> DataFrame:
    """Raw customers for the given keys. The label is derived from the stored (rounded) columns."""
    draw = _Draws(key, seed)
    low, high = AGE_RANGE
    age = F.floor(low + (high - low + 1) * draw.uniform()).cast("long")
    gender = draw.choice(GENDER_SHARES)
    region = draw.choice(REGION_SHARES)
    income = F.least(
        F.greatest(INCOME_MEAN + INCOME_SD * draw.normal(), F.lit(float(INCOME_RANGE[0]))),
        F.lit(float(INCOME_RANGE[1])),
    )
    purchases = draw.poisson(PURCHASES_MEAN)
    erlang = -SPEND_SCALE * F.ln(draw.uniform() * draw.uniform())  # a gamma of shape 2 is exact this way
    browsing = draw.gamma(BROWSE_SHAPE, BROWSE_SCALE)
    category = F.element_at(
        F.array(*[F.lit(c) for c in TOP_CATEGORIES]),
        (1 + F.floor(len(TOP_CATEGORIES) * draw.uniform())).cast("int"),
    )
    drawn = keys.select(
        F.col(key).alias("customer_id"),
        age.alias("age"),
        gender.alias("gender"),
        region.alias("region"),
        income.alias("_income"),
        purchases.alias("num_purchases_last_month"),
        erlang.alias("_erlang"),
        F.round(browsing, 2).alias("browsing_minutes_last_week"),
        category.alias("top_category"),
    )
    spend = F.col("_erlang") * (1 + F.col("_income") / SPEND_INCOME_UNIT)
    rounded = drawn.withColumns(
        {"income": F.round("_income", 2), "purchase_amount_last_month": F.round(spend, 2)}
    )
    return rounded.withColumn("best_action", best_action()).select(*RAW_CUSTOMERS.fieldNames())


def generate_customers(spark: SparkSession, n_customers: int = 10_000, seed: int = 42) -> DataFrame:
    """Customers 1..n; the range is split over the cluster and every row is made where it lands."""
    return synthesize(spark.range(1, n_customers + 1).toDF("customer_id"), seed=seed)
