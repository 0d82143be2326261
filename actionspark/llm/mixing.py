"""Mixing sources to target weights (operator 1), in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actionspark.llm.common import WORD, free, if_small, own_names, stored, table, without, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "7"
BUCKET_ROWS = 20_000
OUTPUTS = ("size", "source_size", "target", "epochs", "rest", "taken")


def source_targets(
    sizes: DataFrame, source: str = "source", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """One row per source: its size, rows and target.

    ``sizes`` holds ``source``, ``source_size`` and ``n_rows``. Sources in code point order, NULL last, get
    the weights in turn. All sizes together are shared by weight; a target stops at ``max_epochs`` times
    its source's size and what it would exceed goes to the others by weight. With the sources in the order
    of cap / weight, those up to some place are full and the rest gets one common level per weight, so two
    running sums over the (one row per source) table find the level that repeated resharing ends at.
    """
    turn = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    capped = sizes.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * max_epochs)
    by_fill = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col(source).asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(0, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    ) / F.sum("_weight").over(onward)
    placed = capped.withColumn("_place", F.row_number().over(by_fill)).withColumn("_level", level)
    open_ = F.when(
        F.col("_level") <= F.col("_cap") / F.col("_weight"), F.struct("_place", "_level")
    )
    common = F.min(open_).over(everything).getField("_level")
    return placed.select(
        source,
        "source_size",
        "n_rows",
        F.least(F.col("_cap").cast("double"), common * F.col("_weight")).alias("target"),
    )


@own_names(OUTPUTS, "key", "source", "text")
def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """All rows of ``docs`` with size, source_size, target, epochs, rest and taken.

    Within a source the rows are ordered by a seeded hash of the key. The running sum of sizes in that order
    is taken in two levels: sums of ranges of the hash (a range holds about ``BUCKET_ROWS`` rows, so a hot
    source only has more of them), and the sum within the range. The source's budget, the whole part of
    its target, is so many whole epochs of all its rows and a remainder: in the last epoch rows are taken up to the
    remainder. Rows are taken whole: the one that crosses the remainder is taken if at least half of it lies below, so
    what is taken is within half a row of the budget. ``rest`` is what a row adds in the last epoch, its size or 0.

    Edge cases: a NULL or empty text has size 0 and takes nothing; a NULL source is one more source, the last; a
    NULL key is hashed as the word null; equal keys and repeated rows are separate rows, next to
    each other in the order (identical rows are interchangeable); an empty table gives an empty one. Input columns
    named like an output are replaced, all others are kept.
    """
    rows = docs.withColumn("size", word_count(F.col(text)))
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    rows = rows.withColumn("_key", F.md5(F.concat(F.lit(f"{seed}:"), name)))
    sizes = rows.groupBy(source).agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")
    )
    targets = stored(source_targets(sizes, source, weights, max_epochs), "targets")
    plan = if_small(targets.withColumnRenamed(source, "_source"))
    rows = rows.join(plan, F.col(source).eqNullSafe(F.col("_source")))
    share = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    rows = rows.withColumn("_range", F.floor(share * F.ceil(F.col("n_rows") / BUCKET_ROWS)))

    sums = stored(rows.groupBy("_source", "_range").agg(F.sum("size").alias("_sum")), "ranges")
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("_source").alias("_s"),
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
    )
    offsets = if_small(stored(offsets, "offsets"))
    same = F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r"))
    inside = (
        Window.partitionBy("_source", "_range")
        .orderBy("_key", F.col(key).asc_nulls_first(), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum("size").over(inside), F.lit(0))
    rows = rows.withColumn("_inside", start).join(offsets, same)

    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0))
    left = budget - epochs * F.col("source_size") - F.col("_offset") - F.col("_inside")
    rest = F.when((left > 0) & (2 * left >= F.col("size")), F.col("size")).otherwise(F.lit(0).cast("long"))
    return (
        rows.withColumn("epochs", epochs.cast("long"))
        .withColumn("rest", rest)
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("rest"))
        .drop("_key", "_source", "_range", "_s", "_r", "_offset", "_inside", "n_rows")
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix as rows: each row as often as it is taken. Rows that the mix doesn't take do not appear."""
    copies = F.col("epochs") + F.when(F.col("rest") > 0, 1).otherwise(0)
    kept = without(mixed, *OUTPUTS).columns
    taken = mixed.filter((copies > 0) & (F.col("size") > 0))
    (copy,) = free(mixed, "copy")
    return taken.select(*kept, F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias(copy)).drop(copy)


def op1_mix(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op1_mix_sources": op1_mix}

SQL = {
    "op1_mix_sources": f"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w
  FROM d GROUP BY source),
p AS (
  SELECT *, row_number() OVER f AS place,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(w) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lev
  FROM s WINDOW f AS (ORDER BY (3 * source_size)::DOUBLE / w::DOUBLE, source ASC NULLS LAST)),
l AS (
  SELECT arg_min(lev, place) AS lev FROM p WHERE lev <= (3 * source_size)::DOUBLE / w::DOUBLE),
t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, l.lev * w::DOUBLE) AS target FROM p, l),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + CASE WHEN below > 0 AND 2 * below >= size THEN size ELSE 0 END AS BIGINT) AS taken
FROM (
  SELECT doc_id, size, source_size, target, epochs,
         CAST(floor(target) AS BIGINT) - epochs * source_size
         - coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)"""
}
