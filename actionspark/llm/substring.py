"""Removal of repeated passages with sharded automata of recurring phrases (operator 3)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actionspark.llm.common import WORD, WordHashes, gram_hashes, mixed, on_workers, own_names, row_number_of, stored, table

WINDOW = 35
ANCHOR = 8
HOT = 2_000
SALTS = 64
SHARD_SEGMENTS = 4_000
OUTPUTS = ("n_words", "n_removed", "spans", "clean_text")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").split()


def packed(text: Column) -> Column:
    """Texts compressed, as they are moved more than once."""

    @F.pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        compress = zstandard.ZstdCompressor(level=3).compress
        return texts.map(lambda t: None if t is None else compress(t.encode("utf-8")))

    return pack(text)


def unpacked(text: bytes | None) -> bytes:
    return b"" if text is None else zstandard.ZstdDecompressor().decompress(text)


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first minimum of each run of ``width`` consecutive values, by doubling."""
    place = np.arange(len(values))
    done = 1
    while done < width:
        step = min(done, width - done)
        left, right = place[:-step], place[step:]
        place = np.where(values[right] < values[left], right, left)
        done += step
    return place


def anchor_runs(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows by anchor: (anchor, first window, number of windows) of runs of windows with one anchor.

    A window's anchor is the first phrase in it, of ``anchor`` words, with the smallest hash, so equal windows have equal
    anchors at equal places in them, and no two windows of a run are equal.
    """
    phrases = gram_hashes(hashes, anchor)
    place = smallest(phrases, window - anchor + 1)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return phrases[place[first]].view(np.int64), first, np.diff(np.append(first, len(place)))


def _anchors(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            parts = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(text.as_py())
                if len(words) >= window:
                    runs = anchor_runs(known.of(words), window, anchor)
                    parts.append((*runs, np.full(len(runs[0]), row)))
            if parts:
                columns = [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "first", "count", "row"])

    return rows.mapInArrow(find, "anchor long, first long, count long, row long")


def _segments(rows: DataFrame, window: int) -> DataFrame:
    """The text of each run of windows: ``runs`` of a row are structs of anchor, first and count."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, text, runs in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = unpacked(text).split()
                for r in runs:
                    first = r["first"]
                    out.append((r["anchor"], row, first, b" ".join(words[first : first + r["count"] + window - 1])))
                if len(out) >= 20_000:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)

    def batch_of(out):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = [pa.array(c, type=t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "row", "first", "words"])

    return rows.mapInArrow(cut, "anchor long, row long, first long, words binary")


def _window_hashes(rows: DataFrame, window: int) -> DataFrame:
    """Each window of the runs as a row of its own, by its hash."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            parts = []
            for row, text, runs in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                hashes = known.of(unpacked(text).split())
                for r in runs:
                    first, count = r["first"], r["count"]
                    found = gram_hashes(hashes[first : first + count + window - 1], window)
                    parts.append((found.view(np.int64), np.full(count, row), np.arange(first, first + count)))
            if parts:
                columns = [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["hash", "row", "first"])

    return rows.mapInArrow(spell, "hash long, row long, first long")


def recurring_spans(segments: list[bytes], times: list[int], window: int) -> list[list[tuple[int, int]]]:
    """Of distinct segments, met ``times`` often, the spans of words in windows that occur twice or more.

    Windows are counted by hash over all segments. Each longest run of recurring windows is a passage; the
    passages make an automaton over word numbers, and each segment is streamed through it to find
    every occurrence of every passage.
    """
    known: dict[bytes, int] = {}
    numbers = [np.fromiter((known.setdefault(w, len(known) + 1) for w in s.split(b" ")), dtype=np.uint64) for s in segments]
    sizes = np.array([len(x) for x in numbers])
    start = np.concatenate(([0], np.cumsum(sizes)))
    hashes = gram_hashes(mixed(np.concatenate(numbers)), window)
    offsets = np.arange(len(hashes))
    owner = np.searchsorted(start, offsets, side="right") - 1
    inside = offsets + window <= start[owner + 1]
    offsets, owner, hashes = offsets[inside], owner[inside], hashes[inside]
    _, group = np.unique(hashes, return_inverse=True)
    often = np.bincount(group, weights=np.asarray(times)[owner])[group] >= 2
    offsets, owner = offsets[often], owner[often]
    if not len(offsets):
        return [[] for _ in segments]
    breaks = np.flatnonzero((np.diff(offsets) != 1) | (np.diff(owner) != 0)) + 1
    first = offsets[np.concatenate(([0], breaks))]
    last = offsets[np.concatenate((breaks - 1, [len(offsets) - 1]))] + window
    flat = np.concatenate(numbers).astype(np.int64).tolist()
    phrases = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        phrases.add_word(tuple(flat[a:b]))
    phrases.make_automaton()
    out = []
    for i in range(len(segments)):
        spans: list[tuple[int, int]] = []
        for end, length in phrases.iter(tuple(flat[start[i] : start[i + 1]])):
            begin = end + 1 - length
            while spans and spans[-1][1] >= begin:
                begin = min(begin, spans.pop()[0])
            spans.append((begin, end + 1))
        out.append(spans)
    return out


def _located(segments: DataFrame, window: int, most: int) -> DataFrame:
    """Spans (row, first, last) of the segments' recurring windows.

    Segments are dealt by anchor and sorted, so all equal windows meet in one task; it reads them as a stream and
    handles about ``most`` at a time, whole anchors each, as one shard with an automaton of its own.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: dict[bytes, list[tuple[int, int]]] = {}
        held, last = 0, None
        for batch in batches:
            done = []
            for anchor, row, first, words in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if anchor != last and held >= most:
                    done += spans_of(shard)
                    shard, held = {}, 0
                shard.setdefault(words, []).append((row, first))
                held, last = held + 1, anchor
            if done:
                yield batch_of(done)
        if shard and (done := spans_of(shard)):
            yield batch_of(done)

    def spans_of(shard):
        segments = list(shard)
        found = recurring_spans(segments, [len(shard[s]) for s in segments], window)
        return [(row, at + a, at + b) for s, spans in zip(segments, found, strict=True) for row, at in shard[s] for a, b in spans]

    def batch_of(rows):
        columns = [pa.array(c, type=pa.int64()) for c in zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["row", "first", "last"])

    dealt = segments.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(locate, "row long, first long, last long")


def _hot_spans(windows: DataFrame, window: int) -> DataFrame:
    """The same for anchors with very many windows, by window: two steps, so that no window's rows meet in one task.

    Windows are counted per (hash, salt): two or more there recur. One row of each (hash, salt) then tells whether a
    window that is alone in its salt has company in another.
    """
    salted = windows.withColumn("salt", F.pmod(F.xxhash64("row", "first"), F.lit(SALTS)))
    near = Window.partitionBy("hash", "salt")
    counted = salted.withColumn("n", F.count(F.lit(1)).over(near))
    counted = counted.withColumn("at", F.row_number().over(near.orderBy("row", "first")))
    many = counted.filter("n >= 2")
    single = counted.filter("at = 1").withColumn("salts", F.count(F.lit(1)).over(Window.partitionBy("hash")))
    single = single.filter("n = 1 AND salts >= 2")
    last = (F.col("first") + window).alias("last")
    return many.select("row", "first", last).unionAll(single.select("row", "first", last))


@own_names(OUTPUTS, "key", "text")
def drop_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT
) -> DataFrame:
    """``docs`` with n_words, n_removed, spans (flat: first word, word after the last) and clean_text.

    A word goes if a window of ``window`` words that covers it occurs anywhere else, in the same row too. Candidates:
    every window has an anchor, the phrase in it with the smallest hash; about one word in fourteen is an anchor, and only
    those that occur twice or more can belong to a recurring window. The segments around them are dealt by anchor
    into shards; there recurring windows are counted by 64-bit hashes, their runs compiled into an automaton, and the same
    segments streamed through it, which gives the spans counted before. Anchors with over ``hot`` occurrences take another, equally exact way: their
    windows are counted one by one, in two salted steps.

    Edge cases: a NULL or empty text and one of fewer words than a window loses nothing; repeated rows are
    occurrences of their own and so lose all their windows, whatever the key, NULL included; an empty table gives an empty
    one. Where nothing is removed clean_text is the text itself, else the kept words joined by one space. Input columns
    named like an output are replaced.
    """
    on_workers(docs.sparkSession)
    rows = docs.withColumn("_row", row_number_of(key, text))
    anchors = stored(_anchors(rows.select("_row", text), window, anchor), "anchors")
    times = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).filter("times >= 2")
    run = F.struct("anchor", "first", "count")
    runs = anchors.join(times, "anchor").groupBy("row").agg(
        F.collect_set(F.when(F.col("times") <= hot, run)).alias("cold"),
        F.collect_set(F.when(F.col("times") > hot, run)).alias("hot"),
    )
    runs = stored(runs, "runs")
    moved = rows.withColumn("_text", packed(F.col(text))).drop(text)
    found = moved.select("_row", "_text").join(runs, F.col("_row") == F.col("row"))
    cold = _located(_segments(found.select("_row", "_text", "cold"), window), window, SHARD_SEGMENTS)
    over = _hot_spans(_window_hashes(found.filter(F.size("hot") > 0).select("_row", "_text", "hot"), window), window)
    spans = cold.unionAll(over).groupBy("row").agg(
        F.collect_set(F.struct("first", "last")).alias("_spans")
    )
    spans = stored(spans, "spans")
    out = _removed(moved.join(spans, F.col("_row") == F.col("row"), "left"), text)
    return out.select(*[c for c in rows.columns if c != "_row"], *OUTPUTS)


def _removed(rows: DataFrame, text: str) -> DataFrame:
    """The packed texts with their spans, as what is left of them."""

    @F.pandas_udf("n_words long, n_removed long, spans array<long>, clean_text string")
    def remove(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, spans in batches:
            out = []
            for body, found in zip(texts, spans, strict=True):
                whole = unpacked(body)
                words = whole.split()
                if found is None or not len(found):
                    out.append((len(words), 0, [], None if body is None else whole.decode("utf-8")))
                    continue
                covered = np.zeros(len(words), dtype=bool)
                for s in found:
                    covered[s["first"] : s["last"]] = True
                kept = b" ".join(w for w, c in zip(words, covered.tolist(), strict=True) if not c)
                edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
                out.append((len(words), int(covered.sum()), edges.tolist(), kept.decode("utf-8")))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "spans", "clean_text"])

    @F.pandas_udf("string")
    def unpack(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unpacked(t).decode("utf-8"))

    rows = rows.withColumn("_out", remove(F.col("_text"), F.col("_spans"))).withColumn(text, unpack(F.col("_text")))
    return rows.withColumns({c: F.col(f"_out.{c}") for c in OUTPUTS})


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.array_join(F.regexp_extract_all(F.coalesce("clean_text", F.lit("")), F.lit(WORD), F.lit(0)), " ")
    return drop_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


QUERIES = {"op3_substring_dedup": op3_substring_dedup}

SQL = {
    "op3_substring_dedup": f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
w AS (
  SELECT r, unnest(hs) AS h, unnest(range(len(hs))) + 1 AS i
  FROM (SELECT r, list_transform(range(1, len(ws) - {WINDOW - 2}), lambda i: md5(array_to_string(ws[i:i+{WINDOW - 1}], ' '))) AS hs
        FROM d WHERE len(ws) >= {WINDOW})),
rep AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS p FROM w JOIN rep USING (h)),
word AS (SELECT r, unnest(ws) AS word, unnest(range(len(ws))) + 1 AS p FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""
}
