"""Scores of a unigram language model over the pieces of an existing vocabulary (operator 6)."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from actionspark.llm.common import LOWER, UPPER, WordHashes, on_workers, stored, table

VOCABULARY = "piece_bpe_32k.model"
FOLDS, HELD_OUT = 7, 2
SMOOTHING = 0.5
COUNTED = 200_000
FREQUENT = 1 << 18
START = "▁"
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_FOLD).split()


class Lattice:
    """log10 probability of a word, summed over all ways to cut it into pieces.

    A word is its marked start and its characters. Every piece of the vocabulary that stands in it is an arc; the bytes
    of a character are one more, so nothing has probability 0.
    """

    def __init__(self, pieces: dict[str, float], octets: list[float], longest: int):
        self.pieces, self.octets, self.longest = pieces, octets, longest

    def __call__(self, word: str) -> float:
        text = START + word
        n, longest, get = len(text), self.longest, self.pieces.get
        reach: list[list[float] | None] = [None] * (n + 1)
        reach[0] = [0.0]
        total = 0.0
        for i in range(n + 1):
            ways = reach[i]
            reach[i] = None
            if len(ways) == 1:
                total = ways[0]
            else:
                most = max(ways)
                total = most + math.log(sum([math.exp(w - most) for w in ways]))
            for j in range(i + 1, min(n, i + longest) + 1):
                p = get(text[i:j])
                if j == i + 1:
                    spelt = total + sum(self.octets[b] for b in text[i].encode("utf-8"))
                    reach[j] = (reach[j] or []) + [spelt]
                if p is not None:
                    if reach[j] is None:
                        reach[j] = []
                    reach[j].append(total + p)
        return total / math.log(10)


def _held_out(key: str):
    """Whether a row is held out, by the crc32 of its key as text; a NULL key is the empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % FOLDS == HELD_OUT


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n): each word's count in the training rows, 0 for words of held-out rows only.

    ``rows`` holds text and held_out. A task adds up what it meets, in parts of ``COUNTED`` words, before the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text, held in zip(batch.column(0), batch.column(1), strict=True):
                words = tokens_of(text.as_py())
                if held.as_py():
                    for w in words:
                        if w not in found:
                            found[w] = 0
                else:
                    found.update(words)
                if len(found) >= COUNTED:
                    yield batch_of(found)
                    found.clear()
        if found:
            yield batch_of(found)

    def batch_of(found):
        words = pa.array(list(found.keys()), type=pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), type=pa.int64())], names=["word", "n"])

    parts = rows.select("text", "held_out").mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def piece_scores(words: DataFrame, docs: int, path: str, smoothing: float = SMOOTHING) -> tuple[dict[str, float], list[float], float]:
    """Natural logarithms of the pieces' probabilities, of the 256 bytes, and of the end of a text.

    The vocabulary's own segmentation of each training word, times the word's count, counts the pieces; ``smoothing`` is
    added to each. The counts reach the driver as one row per piece, bounded by the vocabulary.
    """
    with open(path, "rb") as f:
        model = f.read()
    sent = words.sparkSession.sparkContext.broadcast(model)

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = sentencepiece.SentencePieceProcessor(model_proto=sent.value)
        total = np.zeros(pieces.vocab_size(), dtype=np.int64)
        for batch in batches:
            texts, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            ids = pieces.encode(texts, num_threads=1)
            sizes = [len(x) for x in ids]
            flat = np.fromiter((i for x in ids for i in x), dtype=np.int64, count=sum(sizes))
            np.add.at(total, flat, np.repeat(counts, sizes))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    counts = words.filter("n > 0").select("word", "n").mapInArrow(segment, "id long, n long")
    seen = dict(map(tuple, counts.groupBy("id").agg(F.sum("n").alias("n")).collect()))
    own = sentencepiece.SentencePieceProcessor(model_proto=model)
    usable = [i for i in range(own.vocab_size()) if not (own.is_control(i) or own.is_unknown(i))]
    total = sum(seen.get(i, 0) for i in usable) + docs + smoothing * (len(usable) + 1)
    score = {i: math.log((seen.get(i, 0) + smoothing) / total) for i in usable}
    octets = [0.0] * 256
    for i in usable:
        if own.is_byte(i):
            octets[int(own.id_to_piece(i)[3:5], 16)] = score[i]
    pieces = {own.id_to_piece(i): s for i, s in score.items() if not own.is_byte(i)}
    return pieces, octets, math.log((docs + smoothing) / total)


def with_scores(words: DataFrame, lattice: Lattice) -> DataFrame:
    """``words`` with hash (of the word) and lp (its log10 probability)."""
    sent = words.sparkSession.sparkContext.broadcast(lattice)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = batch.column(0).to_pylist()
            keys = np.fromiter((xxhash.xxh3_64_intdigest(t.encode("utf-8")) for t in texts), dtype=np.uint64, count=len(texts))
            scores = np.fromiter(map(model, texts), dtype=np.float64, count=len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys.view(np.int64)), pa.array(scores)], names=["word", "n", "hash", "lp"])

    return words.select("word", "n").mapInArrow(score, "word string, n long, hash long, lp double")


def frequent_words(words: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The most frequent words, by steps of a quarter of a power of two, as many steps as give at most ``most`` words."""
    step = F.floor(F.log2("n") * 4).cast("int")
    steps = words.filter("n > 0").groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()
    total, least = 0, None
    for row in sorted(steps, reverse=True):
        total += row.words
        if total > most:
            break
        least = row.step
    return words.filter("n > 0").filter(step >= least) if least is not None else words.limit(0)


def score_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", smoothing: float = SMOOTHING) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    Training rows give the word counts; the words' pieces the model; each distinct word is scored once, over its
    lattice. A text's probability is the product over its words and its end. Documents add up the words that are
    frequent (a table of at most ``FREQUENT`` words, sent to the tasks) where they are; each other distinct word of a
    document is a row that is joined with the words' table and summed up per document. A frequent word can hold any share of the
    tokens and is never shuffled; what is shuffled has no hot key.

    Edge cases: a NULL or empty text has the one token that ends it; a NULL key counts as the empty text when rows are
    held out; repeated rows are scored each; with no training rows all counts are 0, so every base score is log10(1) = 0
    and the pieces are equally likely; an empty table gives an empty one. Further columns are not carried along.
    """
    spark = docs.sparkSession
    on_workers(spark)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), _held_out(key).alias("held_out"))
    counted = stored(word_counts(rows), "words")
    sums = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    ends = rows.filter(~F.col("held_out")).count()
    n_train, distinct = sums[0] + ends, sums[1] + (ends > 0)
    pieces, octets, end = piece_scores(counted, ends, path, smoothing)
    lattice = Lattice(pieces, octets, max(map(len, pieces)))
    words = stored(with_scores(counted, lattice), "scored_words").drop("word")

    top = frequent_words(words).select("hash", "n", "lp").toPandas().sort_values("hash")
    known = (top["hash"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["lp"].to_numpy(np.float64))
    sent = spark.sparkContext.broadcast(known)
    below = n_train + distinct + 1
    base_of = lambda n: np.log10((n + 1.0) / below)
    end_base, end_score = (float(base_of(ends)), end / math.log(10))

    kind = docs.schema[key].dataType
    names = ["row", "key", "held_out", "n_tokens", "n_known", "base", "score", "hash", "times"]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        keys, counts, scores = sent.value
        bases = base_of(counts)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = {n: [] for n in names}
            rare: list[np.ndarray] = []
            times: list[np.ndarray] = []
            owners: list[np.ndarray] = []
            for k, text, held in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                row += 1
                found, many = np.unique(hashes.of(tokens_of(text)).view(np.int64), return_counts=True)
                at = np.searchsorted(keys, found)
                hit = keys[np.minimum(at, len(keys) - 1)] == found if len(keys) else np.zeros(len(found), dtype=bool)
                m, at = many[hit], at[hit]
                values = (row, k, held, int(many.sum()) + 1, int(m.sum()) + (ends > 0), float(m @ bases[at]) + end_base, float(m @ scores[at]) + end_score, None, None)
                for n, v in zip(names, values, strict=True):
                    out[n].append(v)
                rare.append(found[~hit])
                times.append(many[~hit])
                owners.append(np.full(len(rare[-1]), row))
            head = pa.RecordBatch.from_arrays([pa.array(out[n], type=t) for n, t in zip(names, kinds, strict=True)], names=names)
            yield head
            many = sum(map(len, rare))
            if many:
                columns = [pa.array(np.concatenate(owners)), *(pa.nulls(many, t) for t in kinds[1:7]), pa.array(np.concatenate(rare)), pa.array(np.concatenate(times))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = [pa.int64(), to_arrow_type(kind), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    shape = f"row long, key {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, base double, score double, hash long, times long"
    found = stored(rows.select("key", "text", "held_out").mapInArrow(add_up, shape), "found")
    heads = found.filter("hash IS NULL").drop("hash", "times")
    rest = found.filter("hash IS NOT NULL").select("row", "hash", "times").join(words, "hash")
    base = F.log10((F.col("n") + 1) / F.lit(float(below)))
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * base).alias("more_base"),
        F.sum(F.col("times") * F.col("lp")).alias("more_score"),
    )
    zero = F.lit(0.0)
    return heads.join(rest, "row", "left").select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", zero)).alias("score"),
    )


def op6_lm_scores(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, public_tokenizers.path(VOCABULARY))


QUERIES = {"op6_lm_scores": op6_lm_scores}
SQL: dict[str, str] = {}
