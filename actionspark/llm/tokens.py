"""Token counts by byte-pair merging with a heap over a linked list (operator 5)."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionspark.llm.common import on_workers, table, without

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
OUTPUTS = ("n_bytes", "n_tokens", "over_limit")
CACHED = 300_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in such vocabularies: printable bytes for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> tuple[list[tuple[bytes, bytes]], list[str]]:
    """Merges in the order of their ranks, as bytes, and the special strings."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    letters = byte_letters()
    raw = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
    merges = [tuple(bytes(letters[c] for c in part) for part in pair) for pair in raw]
    return merges, [t["content"] for t in data["added_tokens"] if t["special"]]


def merged_length(symbols: list[bytes], ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Symbols left when the adjacent pair of lowest rank, the leftmost of equals, is merged until none is known.

    The heap holds (rank, place) of pairs; the list of live symbols is linked by places. An entry whose pair has changed
    meanwhile no longer has its rank and is passed over.
    """
    n = left = len(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if j >= n or symbols[i] is None or ranks.get((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = None
        left -= 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return left


class PieceLengths(dict):
    """Token count of each piece of text met, kept up to a fixed number of pieces."""

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        super().__init__()
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        self.single = [bytes([b]) for b in range(256)]

    def __missing__(self, piece: str) -> int:
        n = merged_length([self.single[b] for b in piece.encode("utf-8")], self.ranks)
        if len(self) >= CACHED:
            self.clear()
        if len(piece) <= 64:
            self[piece] = n
        return n


_LENGTHS: dict[str, PieceLengths] = {}  # of a worker, kept from task to task


def token_counter(spark, path: str):
    """A column function: the number of tokens of a text. The vocabulary, of fixed size, is sent to the executors."""
    on_workers(spark)
    merges, special = read_vocabulary(path)
    sent = spark.sparkContext.broadcast((merges, special, public_tokenizers.PATTERN))
    name = hashlib.sha256(repr(merges).encode()).hexdigest()

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        merges, special, pattern = sent.value
        lengths = _LENGTHS.get(name) or _LENGTHS.setdefault(name, PieceLengths(merges))
        pieces = regex.compile(pattern).findall
        marks = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        get = lengths.__getitem__
        for texts in batches:
            out = []
            for text in texts:
                parts = marks.split(text) if marks else [text]
                out.append(len(parts) - 1 + sum(sum(map(get, pieces(part))) for part in parts))
            yield pd.Series(out, dtype="int64")

    return count


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (more than ``limit`` tokens), row by row: no shuffle.

    A special string in a text is one token, as the library takes it by default; the text between is cut by the
    vocabulary's pattern, and each piece counts its bytes minus the merges made.

    Edge cases: a NULL or empty text has no bytes and no tokens; a very long piece costs n log n; repeated rows are
    counted each; an empty table gives an empty one. Input columns named like an output are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = without(docs, *(c for c in OUTPUTS if c != text))
    rows = rows.withColumn("n_bytes", F.octet_length(body).cast("long"))
    rows = rows.withColumn("n_tokens", token_counter(docs.sparkSession, path)(body))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path(VOCABULARY)).select("doc_id", *OUTPUTS)


QUERIES = {"op5_token_counts": op5_token_counts}
SQL: dict[str, str] = {}
