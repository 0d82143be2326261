"""Helpers shared by the operators: words, tables cut from their lineage, broadcasts of a checked size."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from inspect import signature
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actionspark.sources.tables import materialize

# Words are runs of anything but ASCII white space; ASCII letters are lower-cased.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for a NULL text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose machines do not have it there, it is shipped with ``--py-files`` as usual.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def if_small(stored: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``stored`` (a written table) with a broadcast hint if it has at most ``rows`` rows.

    Otherwise unhinted: the planner then shuffles both sides and splits partitions of hot keys.
    """
    return F.broadcast(stored) if stored.limit(rows + 1).count() <= rows else stored


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add, so that a clashing name cannot be ambiguous."""
    return df.drop(*names)


def own_names(outputs: tuple[str, ...], *params: str) -> Callable:
    """For operators that add columns to those of their first argument: whatever the caller's columns are called, none can
    meet one that the operator makes for itself.

    Inside, the caller's columns are called in_0, in_1 and so on, and ``params``, which name columns, are translated.
    Outside they have their names again, in their order, with ``outputs`` behind them; those named like an output are
    replaced.
    """

    def decorate(operator: Callable) -> Callable:
        known = signature(operator)

        @wraps(operator)
        def renamed(docs: DataFrame, *args, **named) -> DataFrame:
            names = docs.columns
            inner = {c.lower(): f"in_{i}" for i, c in enumerate(names)}
            bound = known.bind(docs.toDF(*(f"in_{i}" for i in range(len(names)))), *args, **named)
            bound.apply_defaults()
            for p in params:
                bound.arguments[p] = inner.get(bound.arguments[p].lower(), bound.arguments[p])
            replaced = {c.lower() for c in outputs}
            kept = [F.col(f"in_{i}").alias(c) for i, c in enumerate(names) if c.lower() not in replaced]
            return operator(*bound.args, **bound.kwargs).select(*kept, *outputs)

        return renamed

    return decorate


def free(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` bears: for columns an operator needs for itself."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def row_number_of(key: str, text: str) -> Column:
    """A number for a row, by key and text, which are told apart by 64 bits: equal rows have one number. NULL is marked,
    since the hash passes over it and would take (NULL, x) for (x, NULL)."""
    return F.xxhash64(F.col(key).isNull(), F.col(key), F.col(text).isNull(), F.col(text))


class WordHashes(dict):
    """64-bit hash of each word met, kept up to a fixed number of words."""

    MOST = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_BASE = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_BASE, j, 1 << 64) for j in range(64)], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words (given as hashes); empty if there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = words[:n] * _POWERS[0]
    for j in range(1, k):
        total += words[j : j + n] * _POWERS[j]
    return mixed(total)


def stored(df: DataFrame, name: str) -> DataFrame:
    return materialize(df, name)
