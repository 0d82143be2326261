"""Tables in buckets of a key, of which new rows rewrite only the buckets they fall into."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actionspark.operators.keys import dedupe_latest
from actionspark.sources.tables import table_exists

BUCKET = "key_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def read_keyed(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a bucketed table, without the bucket."""
    return spark.read.parquet(table).drop(BUCKET)


def upsert(rows: DataFrame, table: str, keys: Sequence[str], order: Sequence[str], buckets: int = 256) -> list[int]:
    """Bring ``rows`` into a table that holds one row per key, the newest by ``order``; returns the buckets rewritten.

    Only partitions of buckets that a new row falls into are read, merged and replaced; the others keep their files. A
    row that is older than the stored one changes nothing, so late rows and rows that come twice do no harm and a run that
    failed is repeated. New rows are reduced to one per key before they meet the table. ``buckets`` is fixed with the
    first write: so many that one of them fits a few tasks.

    Edge cases: rows with a NULL in ``keys`` are left out; of equally new rows the largest in the remaining columns stays;
    no rows change nothing; the columns must be those of the table.
    """
    spark, keys, order = rows.sparkSession, list(keys), list(order)
    new = dedupe_latest(rows, keys, order).withColumn(BUCKET, bucket_of(keys, buckets))
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
    if not touched:
        return []
    if table_exists(spark, table):
        stored = spark.read.parquet(table)
        if set(stored.columns) != set(new.columns):
            raise ValueError(f"columns {sorted(rows.columns)} are not those of the table, {sorted(stored.columns)}")
        there = stored.filter(F.col(BUCKET).isin(touched)).select(*new.columns)
        new = dedupe_latest(there.unionByName(new).drop(BUCKET), keys, order).withColumn(BUCKET, bucket_of(keys, buckets))
    (
        new.hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(table)
    )
    return touched
