"""Counts, shares and extents of categorical columns and dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionspark.functions.numeric import percent, to_long
from actionspark.operators.keys import distinct_with_null


def class_balance(df: DataFrame, column: str = "best_action") -> DataFrame:
    """Rows per class, most frequent first, ties by name."""
    return df.groupBy(column).agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), column)


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, category, n_rows) of several columns in one scan and one shuffle of partial counts."""
    rows = to_long(df, [], cols, "feature", "category", "string")
    counts = rows.groupBy("feature", "category").agg(F.count("*").alias("n_rows"))
    return counts.orderBy("feature", F.desc("n_rows"), "category")


def shares(counts: DataFrame) -> DataFrame:
    """Adds share_pct, the percentage of the feature's total, to category counts; 0 for an empty total.

    The totals have one row per counted column and may be broadcast however many categories there are.
    """
    totals = counts.groupBy("feature").agg(F.sum("n_rows").alias("_total"))
    joined = counts.join(F.broadcast(totals), "feature")
    return joined.withColumn("share_pct", percent(F.col("n_rows"), F.col("_total"))).drop("_total")


def action_distribution(log: DataFrame) -> DataFrame:
    counts = log.groupBy("log_date", "recommended_action").agg(F.count("*").alias("n_rows"))
    return counts.orderBy("log_date", "recommended_action")


def extent(df: DataFrame, key: str, date_col: str) -> DataFrame:
    """One row: rows, distinct keys (NULL is one), distinct dates, first (baseline) and last date.

    The date figures are scalar subqueries over the date column alone, which a log partitioned by date
    answers without reading its rows.
    """
    dates = df.groupBy(date_col).agg(F.count("*").alias("n"))
    span = dates.agg(
        F.count(date_col).alias("n_dates"),
        F.min(date_col).alias("baseline_date"),
        F.max(date_col).alias("current_date"),
    )
    return df.agg(F.count("*").alias("n_rows"), distinct_with_null(key).alias("n_keys")).select(
        "*", *[span.select(c).scalar().alias(c) for c in span.columns]
    )


def key_bitmaps(df: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Which keys there are, as bitmaps: per group and bucket of 32,768 neighbouring keys one binary column of 4 KB.

    Distinct counts do not add up, bitmaps do: those of a day are stored once, and the count over any days is taken from
    them without meeting a key again. For whole numbers that lie close together, as customer numbers do; a NULL key
    has a row of its own, with a NULL bucket.
    """
    bucket, place = F.bitmap_bucket_number(F.col(key)), F.bitmap_bit_position(F.col(key))
    return df.groupBy(*by, bucket.alias("bucket")).agg(F.bitmap_construct_agg(place).alias("bits"))


def distinct_of_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """One row: n_keys, the distinct keys of all groups; NULL counts as one."""
    merged = bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    some = F.when(F.col("bucket").isNull(), F.lit(1).cast("long")).otherwise(F.bitmap_count("bits"))
    return merged.agg(F.coalesce(F.sum(some), F.lit(0)).alias("n_keys"))
