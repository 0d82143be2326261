"""Warehouse tables to the raw customer schema, for one or several snapshot dates in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actionspark.functions.numeric import as_column, cents_sum
from actionspark.functions.rules import best_action
from actionspark.sources.schemas import RAW_CUSTOMERS, WAREHOUSE
from actionspark.sources.tables import warehouse_table

ORDER_WINDOW_DAYS = 540
BROWSE_WINDOW_DAYS = 7
ORDER_STEP_DAYS = 180
BROWSE_STEP_DAYS = 7


def load_warehouse(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    return {name: warehouse_table(spark, directory, name) for name in WAREHOUSE}


def _days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


def _snapshots_of(age: Column, window: int, step: int, snapshots: int) -> Column:
    """Array of the snapshot numbers k with k*step <= age < k*step + window (age in days as an interval).

    The windows reach at least to the next one (window >= step), so the numbers are a range: as many
    as have already opened minus those that have already closed.
    """
    if snapshots == 1:
        return F.array(F.lit(0))

    def how_many(offset: int, first: int) -> Column:
        passed = [(age >= _days(k * step + offset)).cast("int") for k in range(first, snapshots)]
        return sum(passed[1:], passed[0])

    return F.sequence(how_many(window, 0), how_many(0, 1))


def _windowed(
    facts: DataFrame, ts: str, as_of: Column | str | None, window: int, step: int, snapshots: int
) -> tuple[DataFrame, Column]:
    """Facts inside any snapshot window, with ``in_snapshots``, and the end of the newest window.

    Without ``as_of`` the windows end at the newest fact. Their common start is then a scalar subquery and
    the end is derived from it: a bare subquery is pushed down to the Parquet scan, an expression is not.
    """
    span = _days(window + step * (snapshots - 1))
    when = F.col(ts)
    if as_of is None:
        start = facts.agg(F.max(ts) - span).scalar()
        end = start + span
        kept = facts.filter(when > start)
    else:
        end = as_column(as_of)
        kept = facts.filter((when > end - span) & (when <= end))
    aged = kept.withColumn("_age", end - when)
    # never empty, so explode_outer gives the same rows; a plain explode would add a filter that
    # computes the array a second time
    numbers = _snapshots_of(F.col("_age"), window, step, snapshots)
    return aged.withColumn("in_snapshots", numbers), end


def customer_snapshots(
    tables: Mapping[str, DataFrame],
    snapshots: int | Sequence[int] = 1,
    as_of: Column | str | None = None,
    browse_as_of: Column | str | None = None,
) -> DataFrame:
    """(snapshot, as_of, raw customer columns), one row per customer and snapshot.

    Snapshot k looks back from ``as_of`` minus 180*k days (orders) and ``browse_as_of`` minus 7*k days
    (events). Both default to the newest date of their table, found by a scalar subquery that also
    prunes the scan. ``snapshots`` is how many, from 0 on, or the numbers wanted. Facts are aggregated before they meet the customers, all three on
    (customer, snapshot), so each fact table is shuffled once and a hot customer arrives as a few
    partial sums per task instead of as its rows.
    """
    numbers = range(snapshots) if isinstance(snapshots, int) else sorted(set(snapshots))
    reach = max(numbers) + 1
    orders, end = _windowed(
        tables["orders"], "o_orderdate", as_of, ORDER_WINDOW_DAYS, ORDER_STEP_DAYS, reach
    )
    events, _ = _windowed(tables["events"], "ts", browse_as_of, BROWSE_WINDOW_DAYS, BROWSE_STEP_DAYS, reach)
    if len(numbers) < reach:  # facts of no wanted snapshot are counted for none
        wanted = F.array_intersect("in_snapshots", F.array(*map(F.lit, numbers)))
        orders, events = (facts.withColumn("in_snapshots", wanted) for facts in (orders, events))
    orders = orders.withColumnRenamed("o_custkey", "customer_id")

    purchases = (
        orders.select("customer_id", "o_totalprice", F.explode_outer("in_snapshots").alias("snapshot"))
        .groupBy("customer_id", "snapshot")
        .agg(F.count("*").alias("n_orders"), cents_sum("o_totalprice").alias("spend_cents"))
    )

    category_spend = (
        tables["lineitem"]
        .select("l_orderkey", "l_partkey", "l_extendedprice")
        .join(
            orders.select("o_orderkey", "customer_id", "in_snapshots"),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
        .join(tables["part"].select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .select("customer_id", "p_type", "l_extendedprice", F.explode_outer("in_snapshots").alias("snapshot"))
        .groupBy("customer_id", "snapshot", "p_type")
        .agg(cents_sum("l_extendedprice").alias("spend_cents"))
    )
    top_category = category_spend.groupBy("customer_id", "snapshot").agg(
        F.min(F.struct((-F.col("spend_cents")).alias("neg_spend"), F.col("p_type"))).alias("top")
    )

    browsing = (
        events.filter(F.col("event_type").isin("view", "click"))
        .select(F.col("user_id").alias("customer_id"), "value", F.explode_outer("in_snapshots").alias("snapshot"))
        .groupBy("customer_id", "snapshot")
        .agg(cents_sum("value").alias("minute_cents"))
    )

    geography = tables["nation"].join(
        tables["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    customers = (
        tables["customer"]
        .select("c_custkey", "c_nationkey", "c_acctbal")
        .join(geography, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            "c_acctbal",
            "r_name",
            F.explode(F.array(*map(F.lit, numbers))).alias("snapshot"),
        )
    )

    keys = ["customer_id", "snapshot"]
    joined = (
        customers.join(purchases, keys, "left").join(top_category, keys, "left").join(browsing, keys, "left")
    )

    def scaled(total: str, divisor: int) -> Column:
        """floor to cents of a total (in cents) / divisor, 0 without facts."""
        per_unit = F.coalesce(F.col(total).cast("double") / 100, F.lit(0.0)) / divisor
        return F.floor(per_unit * 100).cast("double") / 100

    key = F.col("customer_id")
    raw = joined.select(
        "snapshot",
        F.expr("make_dt_interval(snapshot * %d)" % ORDER_STEP_DAYS).alias("back"),
        "customer_id",
        (18 + (key * 37) % 53).alias("age"),
        F.when((key * 7) % 25 < 13, "F").otherwise("M").alias("gender"),
        F.col("r_name").alias("region"),
        (20000 + (F.col("c_acctbal") + 1000) * 10).alias("income"),
        F.coalesce("n_orders", F.lit(0).cast("long")).alias("num_purchases_last_month"),
        scaled("spend_cents", 1800).alias("purchase_amount_last_month"),
        scaled("minute_cents", 5).alias("browsing_minutes_last_week"),
        F.coalesce("top.p_type", F.lit("NONE")).alias("top_category"),
    )
    return raw.select(
        "snapshot",
        (end - F.col("back")).alias("as_of"),
        *[c for c in RAW_CUSTOMERS.fieldNames() if c != "best_action"],
        best_action().alias("best_action"),
    )


def raw_customers(tables: Mapping[str, DataFrame], **kwargs) -> DataFrame:
    """The raw customer table of the newest snapshot."""
    return customer_snapshots(tables, 1, **kwargs).select(*RAW_CUSTOMERS.fieldNames())
