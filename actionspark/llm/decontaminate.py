"""Benchmark decontamination with an FM-index per shard of the training text (operator 10)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionspark.llm.common import LOWER, UPPER, ascii_lower, on_workers, own_names, stored, table
from actionspark.sources.tables import scratch_path

WINDOW = 13
SHARD_WORDS = 400_000
BLOCK_WINDOWS = 200_000
GROUP = 4  # blocks searched before what they found is stored
SAMPLE = 16
OUTPUTS = ("n_words", "n_hit", "spans", "items", "contaminated")

# After lower-casing A-Z, words are runs of 0-9, a-z and anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_FOLD).split()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in their order, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        found = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(found[1:] != found[:-1])))
        step *= 2
        if rank[order[-1]] == n - 1 or step >= n:
            return order


class FMIndex:
    """Count and locate phrases in a sequence of small numbers.

    The Burrows-Wheeler transform is held as a wavelet tree, level by level: at each level the bits of all
    symbols with running counts, zeros before ones below. Of the suffix positions every ``SAMPLE``-th of the text is kept.
    """

    def __init__(self, text: np.ndarray):
        text = np.append(text, 0)  # the end, smaller than every symbol
        order = suffix_array(text)
        self.n = len(text)
        self.last = text[order - 1]
        self.levels = []
        self.bits = max(1, int(text.max()).bit_length())
        row = self.last
        for b in range(self.bits - 1, -1, -1):
            ones = (row >> b) & 1
            counts = np.concatenate(([0], np.cumsum(ones)))
            self.levels.append((counts, self.n - int(counts[-1])))
            row = np.concatenate((row[ones == 0], row[ones == 1]))
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=1 << self.bits))))
        self.kept = order % SAMPLE == 0
        self.place = np.concatenate(([0], np.cumsum(self.kept)))
        self.samples = order[self.kept]

    def rank(self, symbols: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs among the first ``upto`` of the transform."""
        low = np.zeros(len(symbols), dtype=np.int64)
        high = upto
        for b, (ones, zeros) in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            bit = ((symbols >> b) & 1).astype(bool)
            low = np.where(bit, zeros + ones[low], low - ones[low])
            high = np.where(bit, zeros + ones[high], high - ones[high])
        return high - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of all rows at once: the rows found and their ranges of suffixes."""
        rows = np.arange(len(phrases))
        low = np.zeros(len(rows), dtype=np.int64)
        high = np.full(len(rows), self.n, dtype=np.int64)
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[rows, j]
            known = c < (1 << self.bits)
            rows, low, high, c = rows[known], low[known], high[known], c[known]
            low = self.before[c] + self.rank(c, low)
            high = self.before[c] + self.rank(c, high)
            some = low < high
            rows, low, high = rows[some], low[some], high[some]
            if not len(rows):
                break
        return rows, low, high

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: walk towards the start of the text up to the next kept position."""
        found = np.zeros(len(at), dtype=np.int64)
        open_, steps = np.arange(len(at)), 0
        while len(open_):
            here = self.kept[at]
            found[open_[here]] = self.samples[self.place[at[here]]] + steps
            open_, at = open_[~here], at[~here]
            c = self.last[at]
            at = self.before[c] + self.rank(c, at)
            steps += 1
        return found


class Phrases:
    """The windows of a block of benchmark items, as rows of word numbers by length; 1 is left for breaks."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.words: dict[bytes, int] = {}
        rows: dict[tuple[int, ...], set[str]] = {}
        for name, words in items:
            numbers = [self.words.setdefault(w, len(self.words) + 2) for w in words]
            k = min(window, len(numbers))
            for i in range(len(numbers) - k + 1 if k else 0):
                rows.setdefault(tuple(numbers[i : i + k]), set()).add(name)
        self.lengths = sorted({len(r) for r in rows})
        self.phrases = {k: np.array([r for r in rows if len(r) == k], dtype=np.int64) for k in self.lengths}
        self.items = {k: [sorted(v) for r, v in rows.items() if len(r) == k] for k in self.lengths}

    def hits(self, docs: list[np.ndarray]) -> tuple[dict[int, np.ndarray], dict[int, set[str]]]:
        """Of documents as word numbers (0: in no phrase): the hit words and the items, of those that have any.

        Only runs of phrase words as long as the shortest phrase can hold one; they are the shard's text.
        """
        shortest = self.lengths[0]
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        start = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
        flat = np.concatenate(docs) if docs else np.empty(0, dtype=np.int64)
        edge = np.ones(len(flat) + 1, dtype=bool)
        edge[1:-1] = ((flat[1:] > 0) != (flat[:-1] > 0)) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(edge[:-1])
        size = np.diff(np.append(first, len(flat)))
        runs = (flat[first] > 0) & (size >= shortest) if len(first) else np.empty(0, dtype=bool)
        first, size = first[runs], size[runs]
        if not len(first):
            return {}, {}
        where = np.repeat(first - np.concatenate(([0], np.cumsum(size + 1)[:-1])), size + 1) + np.arange(int(size.sum()) + len(size))
        breaks = np.cumsum(size + 1) - 1
        where[breaks] = -1
        text = flat[where]
        text[breaks] = 1
        index = FMIndex(text)
        change = np.zeros(len(flat) + 1, dtype=np.int64)
        names: dict[int, set[str]] = {}
        for k in self.lengths:
            rows, low, high = index.search(self.phrases[k])
            if not len(rows):
                continue
            many = high - low
            at = np.repeat(low - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(int(many.sum()))
            place = where[index.locate(at)]
            np.add.at(change, place, 1)
            np.add.at(change, place + k, -1)
            pairs = np.unique(np.stack((owner[place], np.repeat(rows, many))), axis=1)
            for doc, row in pairs.T:
                names.setdefault(int(doc), set()).update(self.items[k][row])
        covered = np.cumsum(change[:-1]) > 0
        return {d: covered[start[d] : start[d + 1]] for d in names}, names


def spans_of(covered: np.ndarray) -> list[int]:
    """First word and the word after the last of each run of hit words, one after the other."""
    return np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))).tolist()


def _shards(texts, known, most: int):
    """Word numbers of consecutive documents, up to ``most`` words together or one document."""
    batch, size = [], 0
    for text in texts:
        words = words_of(text)
        if batch and size + len(words) > most:
            yield batch
            batch, size = [], 0
        batch.append(np.fromiter((known(w, 0) for w in words), dtype=np.int64, count=len(words)))
        size += len(words)
    if batch:
        yield batch


def _search(sent: Broadcast, most: int):
    @F.pandas_udf("n_words long, spans array<long>, items array<string>")
    def search(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        block = sent.value
        for texts, spans, items in batches:
            out, at = [], 0
            for shard in _shards(texts, block.words.get, most):
                covered, names = block.hits(shard) if block.lengths else ({}, {})
                for i, doc in enumerate(shard):
                    old, had = spans.iloc[at], items.iloc[at]
                    at += 1
                    hit = covered.get(i)
                    if hit is None:
                        out.append((len(doc), list(old), list(had)))
                        continue
                    hit = hit.copy()
                    for a, b in zip(old[::2], old[1::2], strict=True):
                        hit[a:b] = True
                    out.append((len(doc), spans_of(hit), sorted(set(had) | names[i])))
            yield pd.DataFrame(out, columns=["n_words", "spans", "items"])

    return search


def _blocks(benchmark: DataFrame, item: str, text: str, window: int, most: int) -> Iterator[Phrases]:
    """The items in blocks of about ``most`` windows, one after another; one empty block if there is nothing to search.

    Spark counts the windows, deals the items to blocks by hash and writes a partition per block; one block at a time is
    read back. An item is in one block, so one of more windows makes its block larger.
    """
    words = F.regexp_count(ascii_lower(F.col(text)), F.lit(WORD))
    items = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"),
        F.col(text).alias("text"),
        F.when(words > 0, F.greatest(words - (window - 1), F.lit(1))).otherwise(F.lit(0)).alias("n"),
    ).filter("n > 0")
    windows = items.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = math.ceil(windows / most)
    if not blocks:
        yield Phrases([], window)
        return
    path = scratch_path(benchmark.sparkSession, "benchmark_blocks")
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks)).cast("int")
    items.withColumn("block", block).repartition("block").write.partitionBy("block").parquet(path)
    dealt = benchmark.sparkSession.read.schema("item string, text string, n int, block int").parquet(path)
    for number in range(blocks):
        rows = dealt.filter(F.col("block") == number).collect()
        if rows:
            yield Phrases([(r["item"], words_of(r["text"])) for r in rows], window)


@own_names(OUTPUTS, "text")
def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``docs`` with n_words, n_hit, spans, items and contaminated; rows are neither moved nor dropped.

    A task takes consecutive documents as a shard, up to ``shard_words`` words, builds an FM-index over its words,
    searches all windows of the benchmark in it and merges the hit words into ``spans`` (first word, word after the
    last, flat). The benchmark is sent to the tasks in blocks of about ``block_windows`` windows, each block being one more
    pass over rows in place; after every GROUP blocks what was found is stored and the blocks sent are given up, so
    driver and tasks never hold more than GROUP of them, however large the benchmark. ``items`` are the sorted ids (as text) of items with a window in the document; contaminated: a twentieth of the words is hit.

    Edge cases: a NULL or empty document has no words and no hits; items without words are in no document; a NULL
    item_id is named null; equal ids are one item; repeated rows get equal results; an empty benchmark hits
    nothing; an empty table gives an empty one. Input columns named like an output are replaced.
    """
    rows = docs
    none = F.struct(
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<long>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    rows = rows.withColumn("_found", none)
    spark, held = docs.sparkSession, []
    on_workers(spark)
    for phrases in _blocks(benchmark, item, item_text, window, block_windows):
        if len(held) == GROUP:
            rows = stored(rows, "found")
            for sent in held:
                sent.destroy()
            held = []
        held.append(spark.sparkContext.broadcast(phrases))
        search = _search(held[-1], shard_words)
        rows = rows.withColumn("_found", search(F.col(text), F.col("_found.spans"), F.col("_found.items")))
    gaps = F.transform("spans", lambda p, i: F.when(i % 2 == 1, p).otherwise(-p))
    rows = rows.withColumns({c: F.col(f"_found.{c}") for c in ("n_words", "spans", "items")}).drop("_found")
    rows = rows.withColumn("n_hit", F.aggregate(gaps, F.lit(0).cast("long"), lambda a, p: a + p))
    hit = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return rows.withColumn("contaminated", hit)


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


QUERIES = {"op10_decontaminate": op10_decontaminate}

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"
SQL = {
    "op10_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
b AS (
  SELECT item, least({WINDOW}, len(ws)) AS k, ws
  FROM (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
f AS (
  SELECT DISTINCT item, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i+k-1], ' '))) AS s FROM b),
w AS (
  SELECT r, k, unnest(ss) AS s, unnest(range(len(ss))) + 1 AS i
  FROM (SELECT r, k, list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i+k-1], ' ')) AS ss
        FROM d, (SELECT DISTINCT k FROM b) WHERE len(ws) >= k)),
h AS (SELECT r, i, k, item FROM w JOIN f USING (k, s)),
n AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)"""
}
