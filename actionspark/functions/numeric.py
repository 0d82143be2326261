"""Small numeric helpers: guarded ratios (ANSI mode raises on x/0), exact money, rounding, hashing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, NULL where whole is 0."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, 0 for an empty whole."""
    return F.coalesce(safe_ratio(part * F.lit(100.0), whole), F.lit(0.0))


def cents_sum(c: str | Column) -> Column:
    """Sum of a two-decimal amount in whole cents, as BIGINT.

    Exact, so it does not depend on the order of the rows, and an order of magnitude faster than a sum of
    decimals. It holds 9 * 10^16 units per group; beyond that ANSI mode fails the job, it does not wrap.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(F.floor(c * 100 + 0.5))


def hash_u32(key: str | Column, seed: int) -> Column:
    """First 32 bits of md5("key:seed") as a number in [0, 2^32); the same in every engine."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def as_column(value: Column | str | dt.date | dt.datetime) -> Column:
    """A Column passes through; an ISO string or a Python date becomes a literal."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.lit(value).cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def rounded(df: DataFrame, digits: int = 6, keep: Iterable[str] = ()) -> DataFrame:
    """Round every double column; sums of doubles differ in the last bits between runs."""
    keep = set(keep)
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and f.name not in keep
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def to_long(
    df: DataFrame, ids: Iterable[str], cols: Iterable[str], name: str, value: str, dtype: str
) -> DataFrame:
    """Columns to rows (ids, name, value) in one Expand, after casting to a common type."""
    ids, cols = list(ids), list(cols)
    typed = df.select(*ids, *[F.col(c).cast(dtype).alias(c) for c in cols])
    return typed.unpivot(ids, cols, name, value)
