"""Whether the monitored tables can be monitored, and what their stored profiles cover."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actionspark.sources.schemas import MONITOR_REQUIRED, missing_columns


def readiness(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    required: Mapping[str, Sequence[str]] = MONITOR_REQUIRED,
) -> DataFrame:
    """One row per required table: exists, missing columns, rows, non_empty, ready, what to do.

    ``ready`` is about columns only, ``non_empty`` about rows; the two are independent. Columns are
    checked on the schema, so the only work is one count per table.
    """
    parts = []
    for name, columns in required.items():
        df = tables.get(name)
        exists = df is not None
        missing = missing_columns(df, columns) if exists else list(columns)
        counted = (df if exists else spark.range(0)).agg(F.count("*").alias("n_rows"))
        ready = exists and not missing
        advice = (
            "ready to be profiled"
            if ready
            else ("rewrite the table with the missing columns" if exists else "build the table first")
        )
        parts.append(
            counted.select(
                F.lit(name).alias("table_name"),
                F.lit(exists).alias("table_exists"),
                F.lit(",".join(missing)).alias("missing_columns"),
                "n_rows",
                (F.col("n_rows") > 0).alias("non_empty"),
                F.lit(ready).alias("ready"),
                F.lit(advice).alias("recommendation"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def monitor_status(
    spark: SparkSession,
    profiles: Mapping[str, DataFrame | None],
    tables: Sequence[str] = tuple(MONITOR_REQUIRED),
) -> DataFrame:
    """One row per table: is it profiled, how many windows, the newest one, profile rows."""
    parts = []
    for name in tables:
        stored = profiles.get(name)
        if stored is None:
            stored = spark.createDataFrame([], "window_start DATE")
        parts.append(
            stored.agg(
                F.count("*").alias("profile_rows"),
                F.count_distinct("window_start").alias("n_windows"),
                F.max("window_start").alias("newest_window"),
            ).select(
                F.lit(name).alias("table_name"),
                (F.col("profile_rows") > 0).alias("monitored"),
                "n_windows",
                "newest_window",
                "profile_rows",
            )
        )
    return reduce(DataFrame.unionByName, parts)
