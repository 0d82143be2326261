"""Shuffled shards in two passes (operator 9), in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actionspark.llm.common import if_small, own_names, stored, table, without
from actionspark.sources.tables import scratch_path

SHARDS = 40
SEED = 20
BUCKET_ROWS = 4_000
BUCKET_BYTES = 8 << 20
BROADCAST_BUCKETS = 1_000_000
OUTPUTS = ("shard", "slot")


@own_names(OUTPUTS, "key", "fallback")
def shard(
    docs: DataFrame,
    key: str = "doc_id",
    shards: int = SHARDS,
    seed: int = SEED,
    row_bytes: int = 0,
    fallback: str = "text",
) -> DataFrame:
    """``docs`` in a seeded random order, cut into ``shards`` parts: with ``shard`` and ``slot`` (from 0, gapless).

    First pass: a seeded hash of key and all other columns scatters the rows into buckets of a few thousand rows, fewer
    if the texts are long (their bytes are summed; ``row_bytes`` is the least to assume a row). Rows that are equal in
    all columns and would fill an eighth of a bucket are counted first and scattered copy by copy, so no key and
    no group of copies decides the size of a bucket. Second pass: a task collects a bucket, puts it in the order of its
    hash and shuffles it by Fisher and Yates. Buckets one after the other make the order of all rows; their row counts
    summed up give each row its place, and place p of n goes to shard p * shards / n, so the shards' row counts differ by
    one at most. Partition after partition the result is in this order. The order depends on rows, seed and number of
    partitions only: buckets are sorted within a fixed partition, which is what the shuffle's random numbers start
    from, so a task that runs again gives the same.

    Edge cases: rows with a NULL key are scattered by their other columns; NULL and empty texts are rows like others;
    repeated rows take a slot each; maps are hashed and ordered by their sorted entries; with fewer rows than shards some shards are empty; an empty table gives an empty
    one. Input columns named shard or slot are replaced.
    """
    spark = docs.sparkSession
    rows, maps = without(docs, *OUTPUTS), [c for c, kind in docs.dtypes if kind.startswith("map<")]
    for c in maps:  # a map can be neither hashed nor ordered
        rows = rows.withColumn(c, F.array_sort(F.map_entries(c)))
    name = F.coalesce(F.col(key).cast("string"), F.col(fallback)) if fallback in rows.columns else F.col(key).cast("string")
    columns = rows.columns
    hashed = F.xxhash64(F.lit(seed), name, *columns)
    rows = rows.withColumn("_hash", hashed)
    texts = [c for c, kind in rows.select(*columns).dtypes if kind in ("string", "binary")]
    weight = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in texts), F.lit(1).cast("long"))
    copies = stored(rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"), F.sum(weight).alias("_bytes")), "copies")
    n, total = copies.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum("_bytes"), F.lit(0))).first()
    buckets = max(1, math.ceil(n / BUCKET_ROWS), math.ceil(max(total, n * row_bytes) / BUCKET_BYTES))
    rows = _copies_apart(rows, copies, columns, math.ceil(n / buckets))
    parts = min(buckets, max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(buckets / 64)))
    rows = rows.withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))

    counts = stored(rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")), "bucket_counts")
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    offsets = stored(counts.select(F.col("_bucket").alias("_b"), offset), "bucket_offsets")
    small = offsets.count() <= BROADCAST_BUCKETS
    offsets = F.broadcast(offsets) if small else offsets

    record = F.struct("_hash", *columns)
    part = F.expr(f"cast((_bucket * {parts}) div {buckets} as int)")
    gathered = (
        rows.withColumn("_part", part)
        .repartitionById(parts, F.col("_part"))
        .groupBy("_part", "_bucket")
        .agg(F.sort_array(F.collect_list(record)).alias("_rows"))
        .sortWithinPartitions("_bucket")
        .select("_bucket", F.shuffle("_rows", F.lit(seed)).alias("_rows"))
    )
    placed = gathered.join(offsets, F.col("_bucket") == F.col("_b")).select(
        "_offset", F.posexplode("_rows").alias("_at", "_row")
    )
    place = (F.col("_offset") + F.col("_at")).alias("_place")
    out = placed.select("_row.*", place).drop("_hash")
    if not small:  # the join has dealt the buckets anew
        out = out.repartitionByRange(parts, "_place").sortWithinPartitions("_place")
    exact = F.expr(f"(_place * {shards}) div {max(1, n)}")
    first = F.expr(f"(_shard * {n} + {shards - 1}) div {shards}")
    for c in maps:
        out = out.withColumn(c, F.map_from_entries(c))
    return (
        out.withColumn("_shard", exact)
        .withColumn("slot", F.col("_place") - first)
        .withColumn("shard", F.col("_shard").cast("int"))
        .drop("_shard", "_place")
    )


def _copies_apart(rows: DataFrame, copies: DataFrame, columns: list[str], per_bucket: int) -> DataFrame:
    """``rows`` where equal rows, if they would fill an eighth of a bucket, have hashes of their own.

    Equal rows cannot be told apart, so they become one row and a count, and as many rows again: the same on every run.
    """
    hot = copies.filter((F.col("_n") > 1) & ((F.col("_n") * 8 > per_bucket) | (F.col("_bytes") * 8 > BUCKET_BYTES)))
    hot = stored(hot.select(F.col("_hash").alias("_h")), "hot_copies")
    if hot.isEmpty():
        return rows
    hot = if_small(hot)
    same = F.col("_hash") == F.col("_h")
    counted = rows.join(hot, same, "left_semi").groupBy("_hash", *columns).agg(F.count(F.lit(1)).alias("_n"))
    single = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n")))
    single = single.withColumn("_hash", F.xxhash64("_hash", "_copy")).select(*columns, "_hash")
    return rows.join(hot, same, "left_anti").select(*columns, "_hash").unionByName(single)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its rows in the order of their slots, file after file. ``sharded`` is as ``shard`` gives it:
    in order from partition to partition, so the texts are not shuffled again."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digests(sharded: DataFrame, text: str = "text") -> DataFrame:
    """``sharded`` with size and text_crc32 of its own texts, so that a text lost or changed on the way shows."""
    body = F.coalesce(F.col(text), F.lit(""))
    return sharded.withColumn("size", (F.octet_length(body) + 16).cast("long")).withColumn(
        "text_crc32", F.crc32(F.encode(body, "UTF-8"))
    )


def op9_shard(spark, sf_dir: str) -> DataFrame:
    """Whole documents are scattered, shuffled and written as shards; what is returned is computed from those files."""
    docs = table(spark, sf_dir, "documents")
    sharded = shard(docs)
    path = scratch_path(spark, "shards")
    write_shards(sharded, path)
    back = digests(spark.read.schema(sharded.schema).parquet(path))
    none = F.lit(None).cast("int")
    return back.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", none.alias("grown_shard")
    )


QUERIES = {"op9_shard": op9_shard}
SQL: dict[str, str] = {}
