"""Exact order statistics without one task seeing a whole group.

Rows are first reduced to (group, value, count), so a value that repeats a billion times is one row.
Ranks then come from three levels: the totals of coarse value bins, and of equal slices of bins that hold
many values, are accumulated over their (small) table, and the values are accumulated inside their slice only. One
task therefore sorts one slice of one bin of one group. The offset of a slice travels as a marker row ahead of its
values, which keeps groups whose key is NULL and needs no join back. NaN is the largest value and equal to itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actionspark.sources.tables import materialize

BINS_PER_E_FOLD = 16_384
FULL_BIN = 4_096
SLICES = 1_024
# Natural logarithms of positive doubles lie between these, with room for infinity and NaN.
LOG_FLOOR, LOG_CEILING = 746.0, 711.0


def _bin(value: Column) -> Column:
    """Monotone in ``value``: 0.006 % wide wherever the values lie, zero by itself, negatives mirrored; infinities and
    NaN have bins of their own."""
    size = F.least(F.ln(F.abs(value)), F.lit(LOG_CEILING)) + LOG_FLOOR
    place = F.floor(size * BINS_PER_E_FOLD) + 1
    last = int((LOG_FLOOR + LOG_CEILING) * BINS_PER_E_FOLD) + 2
    return F.when(F.isnan(value), F.lit(last)).when(value == 0, 0).when(value < 0, -place).otherwise(place).cast("long")


def sliced(counted: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Adds _bin and _slice: bins of more than FULL_BIN values are cut into equal parts between their extremes."""
    binned = counted.withColumn("_bin", _bin(F.col(value)))
    spans = binned.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_bin").alias("_full")).agg(
        F.count("*").alias("_values"), F.min(value).alias("_lo"), F.max(value).alias("_hi")
    )
    same = F.col("_bin") == F.col("_full")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    wide = binned.join(spans.filter(F.col("_values") > FULL_BIN), same, "left")
    part = (F.col(value) / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)  # halves cannot overflow
    slice_ = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor(part * SLICES), F.lit(SLICES - 1)))
    return wide.select(*counted.columns, "_bin", F.coalesce(slice_, F.lit(0)).cast("long").alias("_slice"))


def value_counts(
    df: DataFrame, keys: Sequence[str], value: str, counts: dict[str, Column] | None = None
) -> DataFrame:
    """(keys, value, one count column per entry of ``counts``); NULL values have no rank and are left out."""
    counts = counts or {"n": F.count("*")}
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(*[c.alias(name) for name, c in counts.items()])
    )


def cumulative_counts(
    counted: DataFrame, keys: Sequence[str], value: str, counts: Sequence[str] = ("n",)
) -> DataFrame:
    """Adds cum_<c> (rows with value <= this one) and total_<c> for every count column."""
    keys = list(keys)
    counted = materialize(counted, "value_counts")  # read for the bins, for the markers and for the rows
    binned = sliced(counted, keys, value)
    per_bin = binned.groupBy(*keys, "_bin", "_slice").agg(*[F.sum(c).alias(c) for c in counts])
    group = Window.partitionBy(*keys)
    before = group.orderBy("_bin", "_slice").rowsBetween(Window.unboundedPreceding, -1)
    markers = per_bin.select(
        *keys,
        "_bin",
        "_slice",
        F.lit(None).cast(counted.schema[value].dataType).alias(value),
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in counts],
        *[F.sum(c).over(group).alias(f"total_{c}") for c in counts],
    )
    rows = binned.select(
        *keys, "_bin", "_slice", value, *counts, *[F.lit(None).cast("long").alias(f"total_{c}") for c in counts]
    )
    inside = (
        Window.partitionBy(*keys, "_bin", "_slice")
        .orderBy(F.col(value).asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.unionByName(markers)
        .select(
            *keys,
            value,
            *counts,
            *[F.sum(c).over(inside).alias(f"cum_{c}") for c in counts],
            *[F.first(f"total_{c}").over(inside).alias(f"total_{c}") for c in counts],
        )
        .filter(F.col(value).isNotNull())
    )


def quantile_columns(ranked: DataFrame, value: str, probs: dict[str, float]) -> list[Column]:
    """Aggregates giving the linearly interpolated quantiles of a ranked (cum_n, total_n) frame."""
    held = lambda rank: (F.col("cum_n") - F.col("n") <= rank) & (rank < F.col("cum_n"))
    out = []
    for name, p in probs.items():
        position = (F.col("total_n") - 1) * F.lit(float(p))
        low = F.max(F.when(held(F.floor(position)), F.col(value)))
        high = F.max(F.when(held(F.ceil(position)), F.col(value)))
        part = F.max(position - F.floor(position))
        out.append(F.when(low == high, low).otherwise(low + (high - low) * part).alias(name))  # also infinite, NaN
    return out


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """(keys, one column per quantile), equal to sorting each group and interpolating between neighbours."""
    ranked = cumulative_counts(value_counts(df, keys, value), keys, value)
    return ranked.groupBy(*keys).agg(*quantile_columns(ranked, value, probs))


def row_ranks(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with the place of each row, from 1 on, in ``order``, which must be total.

    The rows are dealt by range and stored, so that their parts stay as they are; the parts' sizes, one row per
    part, give each part its offset, and a task ranks one part.
    """
    dealt = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    dealt = materialize(dealt, "ranked")
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    ranked = dealt.withColumn("_inside", inside).join(offsets, "_part")
    return ranked.withColumn(name, F.col("_offset") + F.col("_inside")).drop("_part", "_inside", "_offset")
