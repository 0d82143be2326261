"""Key checks, repair and quality rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actionspark.config import NULL_RATE_ALERT_PCT
from actionspark.functions.numeric import percent


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once with their number of rows; NULL keys form a group as well."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, duplicated key groups, rows with a NULL in the key, and whether the key is clean.

    Counts per key first, then one aggregate over the groups: a single job.
    """
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    zero = F.lit(0).cast("long")
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    totals = groups.agg(
        F.coalesce(F.sum("n"), zero).alias("n_rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(null_key, F.col("n"))), zero).alias("null_key_rows"),
    )
    return totals.withColumn(
        "key_ok", (F.col("duplicate_groups") == 0) & (F.col("null_key_rows") == 0)
    )


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per non-NULL key: the greatest by ``order``, then by the remaining columns (NULLs lowest).

    An aggregate instead of a ranked window: each task sends on one candidate per key, so a key that
    holds a third of the rows never meets in one place.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return best.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def null_rates(df: DataFrame, cols: Sequence[str], flag_pct: float = NULL_RATE_ALERT_PCT) -> DataFrame:
    """(feature, n_rows, n_null, null_rate_pct, flagged); all columns in one scan and one aggregate."""
    counted = df.agg(F.count("*").alias("n_rows"), *[F.count(c).alias(c) for c in cols])
    per_column = counted.unpivot(["n_rows"], list(cols), "feature", "n_present")
    missing = F.col("n_rows") - F.col("n_present")
    rate = percent(missing, F.col("n_rows"))
    return per_column.select(
        "feature",
        "n_rows",
        missing.alias("n_null"),
        rate.alias("null_rate_pct"),
        (rate > flag_pct).alias("flagged"),
    )


def distinct_with_null(column: str | Column) -> Column:
    """Number of distinct values where NULL counts as one of them."""
    column = F.col(column) if isinstance(column, str) else column
    any_null = F.coalesce(F.max(column.isNull().cast("int")), F.lit(0))
    return F.count_distinct(column) + any_null


def duplicate_rate(df: DataFrame, key: str) -> DataFrame:
    """Share of rows beyond the first of their key, in percent; flagged if there is any."""
    counted = df.agg(F.count("*").alias("n_rows"), distinct_with_null(key).alias("n_distinct"))
    rate = percent(F.col("n_rows") - F.col("n_distinct"), F.col("n_rows"))
    return counted.select(
        "n_rows", "n_distinct", rate.alias("duplicate_rate_pct"), (rate > 0).alias("flagged")
    )
