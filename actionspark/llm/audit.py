"""How five filters act together, from a sparse matrix of documents and words (operator 12)."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actionspark.llm.common import WORD, if_small, on_workers, stored, table
from actionspark.sources.tables import scratch_path

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 2
SYMBOLS = "#$%&*|"
UPPER_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

BLOCK_NONZEROS = 4_000_000
BLOCK_ROWS = 50_000
PART_WORDS = 200_000  # words, those of each block counted apart, that a task sorts

FACTS = [
    T.StructField("chars", T.LongType()),
    T.StructField("upper", T.LongType()),
    T.StructField("symbols", T.BooleanType()),
    T.StructField("digest", T.BinaryType()),
]


class Numbers(dict):
    """Numbers of words in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class Block:
    """Rows of a sparse matrix over the words of the block itself."""

    def __init__(self):
        self.words = Numbers()
        self.indices: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.facts: list[tuple] = []
        self.kept: list[pa.StructArray] = []
        self.nonzeros = 0

    def add(self, text: bytes) -> None:
        words = text.split()
        at = np.fromiter(map(self.words.__getitem__, words), dtype="<u4", count=len(words))
        indices, counts = np.unique(at, return_counts=True)
        self.indices.append(indices)
        self.counts.append(counts.astype("<u4"))
        self.sizes.append(len(indices))
        self.nonzeros += len(indices)
        upper = len(text) - len(text.translate(None, UPPER_BYTES))
        symbols = len(text.translate(None, SYMBOLS.encode())) < len(text)
        chars = len(text.decode())
        self.facts.append((chars, upper, symbols, hashlib.sha256(text).digest()))

    def batch(self, number: int) -> pa.RecordBatch:
        kept = pa.concat_arrays(self.kept)
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        facts = [pa.array(c, t) for c, t in zip(zip(*self.facts, strict=True), kinds, strict=True)]
        names = [f.name for f in kept.type] + [f.name for f in FACTS]
        rows = pa.StructArray.from_arrays([*kept.flatten(), *facts], names=names)
        indptr = np.concatenate([[0], np.cumsum(self.sizes)]).astype("<i8")
        words = pa.array(list(self.words), pa.binary()).cast(pa.string())
        columns = [
            pa.array([number], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
            pa.array([indptr.tobytes()], pa.binary()),
            pa.array([np.concatenate(self.indices).tobytes()], pa.binary()),
            pa.array([np.concatenate(self.counts).tobytes()], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "rows", "indptr", "indices", "counts", "words"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    block = Block()
    for batch in batches:
        kept = pa.StructArray.from_arrays(batch.columns[1:], names=batch.schema.names[1:])
        first = 0
        for i, text in enumerate(batch.column(0).cast(pa.binary())):
            block.add(text.as_py())
            if block.nonzeros >= BLOCK_NONZEROS or len(block.sizes) >= BLOCK_ROWS:
                block.kept.append(kept[first : i + 1])
                yield block.batch(number)
                number, first, block = number + 1, i + 1, Block()
        if first < len(kept):
            block.kept.append(kept[first:])
    if block.sizes:
        yield block.batch(number)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted words get numbers within the partition; each is spelt out once, where it is first met."""
    part, last, number = TaskContext.get().partitionId(), None, -1
    for batch in batches:
        words, n = batch.column("word"), batch.num_rows
        if not n:
            continue
        new = np.ones(n, dtype=bool)
        new[0] = number < 0 or words[0].as_py() != last
        new[1:] = pc.not_equal(words.slice(1), words.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        ranks = number + np.cumsum(new)
        number, last = int(ranks[-1]), words[-1].as_py()
        spelt = pc.if_else(pa.array(new), words, pa.scalar(None, words.type))
        columns = [batch.column("block"), batch.column("local"), pa.array(np.full(n, part, "int32")), pa.array(ranks), spelt]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "local", "part", "rank", "word"])


def _globally(block: pa.Table, coded: pa.Table) -> pa.Table:
    """One shard: local word numbers become global ones; row sums and numbers of nonzeros are taken from the rows."""

    def array(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(block.column(name)[0].as_buffer(), kind)

    indptr, local, counts = array("indptr", "<i8"), array("indices", "<u4"), array("counts", "<u4")
    ids = np.empty(coded.num_rows, "<u8")
    ids[coded.column("local").to_numpy()] = coded.column("id").to_numpy()
    totals = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    sums, nonzeros = totals[indptr[1:]] - totals[indptr[:-1]], np.diff(indptr)
    span = pa.array([0, len(sums)], pa.int32())
    made = {
        "block": block.column("block"),
        "rows": block.column("rows"),
        "indptr": block.column("indptr"),
        "indices": pa.array([ids[local].tobytes()], pa.binary()),
        "counts": block.column("counts"),
        "sums": pa.ListArray.from_arrays(span, pa.array(sums, pa.int64())),
        "nonzeros": pa.ListArray.from_arrays(span, pa.array(nonzeros, pa.int64())),
    }
    return pa.table(made)


def term_matrix(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The document-term matrix in CSR shards, and its dictionary.

    A shard (row) holds ``rows`` (the columns of ``docs`` but the text, and what else was seen of each text: code
    points, capitals A-Z, whether it holds one of SYMBOLS, sha256), ``indptr``, ``indices`` (global word numbers,
    unsigned 64-bit) and ``counts`` (unsigned 32-bit) as little-endian bytes, ``sums`` and ``nonzeros`` by row. The
    dictionary has ``word`` and ``id``, from 0 without gaps.

    A task numbers the words of its own shard as it meets them. Then the shards' word lists, not the documents, are
    shuffled and sorted by hash: a word's number within its part plus the part's base, from prefix sums, is its id, and
    every shard meets the ids of its words. A word comes once a shard, however frequent it is.

    Edge cases: a NULL or empty text is a row without entries; a very long one is in a shard of its own; repeated rows
    are rows of their own; an empty table gives no shard and an empty dictionary.
    """
    spark = docs.sparkSession
    on_workers(spark)
    keep = [c for c in docs.columns if c != text]
    body = F.coalesce(F.col(text), F.lit("")).alias("text")
    given = docs.select(body, *keep)
    rows = T.ArrayType(T.StructType([*(given.schema[c] for c in keep), *FACTS]))
    kinds = {"block": T.LongType(), "rows": rows, **dict.fromkeys(("indptr", "indices", "counts"), T.BinaryType())}
    schema = T.StructType([T.StructField(c, t) for c, t in (kinds | {"words": T.ArrayType(T.StringType())}).items()])
    path = scratch_path(spark, "blocks")
    given.mapInArrow(_blocks, schema).write.option("compression", "zstd").parquet(path)
    blocks = spark.read.schema(schema).parquet(path)

    entries = blocks.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(entries / PART_WORDS))
    listed = blocks.select("block", F.posexplode("words").alias("local", "word")).withColumn("hash", F.xxhash64("word"))
    sorted_words = listed.repartition(parts, "hash").sortWithinPartitions("hash", "word").drop("hash")
    coded = stored(sorted_words.mapInArrow(_numbered, "block long, local int, part int, rank long, word string"), "coded")
    sizes = coded.groupBy("part").agg((F.max("rank") + 1).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    bases = stored(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    coded = coded.join(if_small(bases), "part").withColumn("id", F.col("base") + F.col("rank"))

    arrays = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("sums", "nonzeros")]
    shards, ids = blocks.drop("words").groupBy("block"), coded.select("block", "local", "id").groupBy("block")
    matrix = shards.cogroup(ids).applyInArrow(_globally, T.StructType([*blocks.drop("words").schema, *arrays]))
    return matrix, coded.filter(F.col("word").isNotNull()).select("word", "id")


def filter_flags(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row a document: ``key``, ``part`` and which filters it fails, ``a`` to ``e``.

    a: under 200 words; b: less than half of the words are distinct; c: more than 2 % of the code points are capitals
    A-Z; d: holds one of SYMBOLS; e: the text equals that of a smaller key. Words are counted by the rows of the matrix:
    the row's sum, and the number of its nonzeros for distinct ones.

    Edge cases: a NULL text is an empty one; a NULL part is the empty string; a NULL key is never larger than another;
    rows with equal keys and texts do not fail e for each other; an empty table gives an empty one. Other
    columns, whatever they are called, are not read.
    """
    narrow = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text")
    )
    matrix, _ = term_matrix(narrow)
    each = matrix.select(F.inline(F.arrays_zip("rows", "sums", "nonzeros"))).select("rows.*", "sums", "nonzeros")
    seen = stored(
        each.select(
            "key",
            "part",
            "digest",
            (F.col("sums") < MIN_WORDS).alias("a"),
            (100 * F.col("nonzeros") < MIN_DISTINCT_PERCENT * F.col("sums")).alias("b"),
            (100 * F.col("upper") > MAX_UPPER_PERCENT * F.col("chars")).alias("c"),
            F.col("symbols").alias("d"),
        ),
        "seen",
    )
    copies = seen.groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    copies = stored(copies.filter(F.col("first") < F.col("last")).select("digest", "first"), "copies")
    later = F.coalesce(F.col("first") < F.col("key"), F.lit(False))
    return seen.join(if_small(copies), "digest", "left").select("key", "part", "a", "b", "c", "d", later.alias("e"))


def _bits(letters: str) -> int:
    return sum(1 << FILTERS.index(x) for x in letters)


def interactions(flags: DataFrame, good: str = "good", toxic: str = "toxic") -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``flags`` has part, a to e, and whether a document is ``good`` and ``toxic``. Documents are counted by the set of
    filters they fail, at most 32 rows a part. What a step does depends on its filter and the set of filters before it
    only, which gives 80 cases a part, and the orders are looked up from those.

    Edge cases: a NULL label counts as false; an empty table gives an empty one.
    """
    spark = flags.sparkSession
    mask = sum((F.col(x.lower()).cast("int") * (1 << i) for i, x in enumerate(FILTERS)), F.lit(0))
    yes = {c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)).cast("long") for c in (good, toxic)}
    sets = flags.groupBy("part", mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(yes[good]).alias("n_good"), F.sum(yes[toxic]).alias("n_toxic")
    )
    cases = [
        F.struct(
            F.lit(_bits(before)).alias("before"),
            F.lit(_bits(own)).alias("own"),
            F.lit(math.factorial(len(before)) * math.factorial(len(FILTERS) - 1 - len(before))).alias("orders"),
        )
        for own in FILTERS
        for size in range(len(FILTERS))
        for before in combinations(FILTERS.replace(own, ""), size)
    ]
    each = sets.select("*", F.inline(F.array(*cases)))
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(what: str, condition) -> F.Column:
        return F.sum(F.when(condition, F.col(what)).otherwise(F.lit(0)))

    counted = each.groupBy("part", "before", "own", "orders").agg(
        total("n", ~fails & ~gone).alias("kept"),
        total("n", fails & ~gone).alias("removed"),
        total("n", fails & gone).alias("redundant"),
        total("n", F.col("mask") == F.col("own")).alias("unique_fails"),
        total("n_good", fails & ~gone).alias("good_lost"),
        total("n_toxic", fails & ~gone).alias("toxic_lost"),
    )
    over_orders = F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "own"))
    counted = counted.withColumn("shapley", over_orders).drop("orders")
    steps = [
        ("".join(order), i + 1, _bits("".join(order[:i])), _bits(order[i]))
        for order in permutations(FILTERS)
        for i in range(len(FILTERS))
    ]
    steps = spark.createDataFrame(steps, "filter_order string, step int, before int, own int")  # 600 rows, always
    out = counted.join(F.broadcast(steps), ["before", "own"])
    figures = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return out.select("part", "filter_order", "step", *figures)


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``interactions`` of the filters on ``docs``. ``labels`` has ``key``, quality and toxic.

    Edge cases: a document without a label is neither good nor toxic; one with several is what any of them says; a NULL
    key has none. All else as in ``filter_flags`` and ``interactions``.
    """
    said = labels.groupBy(F.col(key).alias("labelled")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    flags = filter_flags(docs, key, text, part)
    return interactions(flags.join(said, F.col("key") == F.col("labelled"), "left"))


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op12_filter_audit": op12_filter_audit}
SQL = {
    "op12_filter_audit": rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
c AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
s AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic,
    (len(w) < {MIN_WORDS})::INT
    + 2 * (100 * len(list_distinct(w)) < {MIN_DISTINCT_PERCENT} * len(w))::INT
    + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > {MAX_UPPER_PERCENT} * length(t))::INT
    + 8 * regexp_matches(t, '[{SYMBOLS}]')::INT
    + 16 * coalesce(c.first < d.doc_id, false)::INT AS mask
  FROM d JOIN c USING (t) LEFT JOIN s USING (doc_id)),
g AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM l a, l b, l c, l d, l e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
p AS (
  SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM (SELECT filter_order, bits, unnest(range(1, 6))::INT AS step FROM o)),
r AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (mask & (own | before) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM g, p GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r"""
}
