"""Numeric summaries: moments, quantiles, correlation, histogram, box-plot numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actionspark.functions.numeric import to_long
from actionspark.functions.ranks import (
    cumulative_counts,
    exact_quantiles,
    quantile_columns,
    value_counts,
)

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
APPROX_ACCURACY = 10_000


def approx_quantiles(column: str) -> list[Column]:
    """Sketched quartiles, all from one fixed-size buffer per group."""
    sketch = F.percentile_approx(column, list(QUARTILES.values()), APPROX_ACCURACY)
    return [sketch[i].alias(name) for i, name in enumerate(QUARTILES)]


def moments(column: str, sketched: bool) -> Column:
    """The figures of one DOUBLE column as a struct: aggregated side by side, turned into rows afterwards,
    so the rows themselves are not multiplied by the number of columns."""
    figures = [
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    ]
    if sketched:
        figures += [*approx_quantiles(column), F.approx_count_distinct(column).alias("n_distinct")]
    return F.struct(*figures).alias(column)


def numeric_summary(df: DataFrame, cols: Sequence[str], exact: bool = False) -> DataFrame:
    """(feature, n, mean, stddev, min, q25, q50, q75, max), all columns in one pass over the rows.

    ``exact`` replaces the sketched quartiles by interpolated ones, which takes a shuffle of the
    distinct values.
    """
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    one_row = typed.agg(*[moments(c, sketched=not exact) for c in cols])
    out = one_row.unpivot([], list(cols), "feature", "m").select("feature", "m.*")
    if exact:
        rows = to_long(typed, [], cols, "feature", "value", "double")
        # one row per summarised column: the size is known from the argument
        out = out.join(F.broadcast(exact_quantiles(rows, ["feature"], "value", QUARTILES)), "feature", "left")
    return out.select("feature", "n", "mean", "stddev", "min", *QUARTILES, "max")


def label_correlation(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Pearson correlation of each column with ``label`` over the rows where both are known.

    NULL where either side is constant (ANSI division would fail). One aggregate for all columns,
    strongest first.
    """

    def corr(c: str):
        x = F.when(F.col(label).isNotNull(), F.col(c).cast("double"))
        y = F.when(F.col(c).isNotNull(), F.col(label).cast("double"))
        spread = F.stddev_pop(x) * F.stddev_pop(y)
        return (F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))).alias(c)

    one_row = df.agg(*[corr(c) for c in cols])
    long = one_row.unpivot([], list(cols), "feature", "corr_with_label")
    return long.orderBy(F.desc_nulls_last(F.abs("corr_with_label")), "feature")


def histogram(df: DataFrame, col: str, bins: int = 25) -> DataFrame:
    """(bin, lower, upper, n_rows, n_nan): equal widths over the finite [min, max], the last bin closed, empty bins kept.

    A constant column gets the range of one around its value. Infinities count in the outermost bins; NaN counts in
    none, ``n_nan`` on every row says how many there are. Only counts per bin are shuffled.
    """
    value = F.col(col).cast("double")
    nan = F.isnan(value)
    finite = F.when(~nan & (F.abs(value) < F.lit(float("inf"))), value)
    single = F.col("lo") == F.col("hi")
    span = (
        df.agg(F.min(finite).alias("lo"), F.max(finite).alias("hi"), F.count_if(nan).alias("n_nan"))
        .filter(F.col("lo").isNotNull())
        .select(
            (F.col("lo") - F.when(single, 0.5).otherwise(0.0)).alias("lo"),
            (F.col("hi") + F.when(single, 0.5).otherwise(0.0)).alias("hi"),
            "n_nan",
        )
        .select("lo", "hi", "n_nan", ((F.col("hi") - F.col("lo")) / bins).alias("width"))
    )
    lo, hi, width = (span.select(c).scalar() for c in ("lo", "hi", "width"))
    inner = F.least(F.floor((value - lo) / width), F.lit(bins - 1))
    place = F.when(value >= hi, bins - 1).when(value <= lo, 0).otherwise(inner)
    counts = (
        df.filter(F.col(col).isNotNull() & ~nan)
        .select(place.cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n_rows"))
    )
    frame = span.select("lo", "width", "n_nan", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (
        frame.join(F.broadcast(counts), "bin", "left")  # at most ``bins`` rows
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("lower"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("upper"),
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            "n_nan",
        )
        .orderBy("bin")
    )


def boxplot_stats(df: DataFrame, col: str, by: str, exact: bool = False) -> DataFrame:
    """Per group: n, quartiles, whiskers at the last datum within 1.5 IQR of the box, outliers.

    Works on (group, value, count) rows throughout, so the raw rows are shuffled once, as counts.
    """
    values = df.select(F.col(by), F.col(col).cast("double").alias("value"))
    counted = value_counts(values, [by], "value")
    if exact:
        ranked = cumulative_counts(counted, [by], "value")
        boxes = ranked.groupBy(by).agg(*quantile_columns(ranked, "value", QUARTILES))
    else:
        boxes = values.groupBy(by).agg(*approx_quantiles("value"))
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    inside = F.col("value").between(F.col("q25") - reach, F.col("q75") + reach)
    group = boxes.withColumnRenamed(by, "_group")
    return (
        counted.join(group, F.col(by).eqNullSafe(F.col("_group")))
        .groupBy(by, *QUARTILES)
        .agg(
            F.sum("n").alias("n"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_outliers"),
        )
        .select(by, "n", *QUARTILES, "whisker_low", "whisker_high", "n_outliers")
    )


def quartile_check(values: DataFrame, keys: Sequence[str], quartiles: DataFrame, error: float) -> DataFrame:
    """(keys, n, one flag per quartile): whether each given quartile holds its rank among ``values`` to ``error``.

    ``values`` has keys and value, ``quartiles`` a row per key: the check of a sketch against all rows.
    """
    named = quartiles.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *QUARTILES)
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    joined = values.filter(F.col("value").isNotNull()).join(named, same)
    n = F.count("*")

    def holds(name: str, p: float) -> Column:
        below = F.count_if(F.col("value") < F.col(name)) / n
        upto = F.count_if(F.col("value") <= F.col(name)) / n
        return ((below <= p + error) & (upto >= p - error)).alias(f"{name}_ok")

    return joined.groupBy(*keys).agg(n.alias("n"), *[holds(q, p) for q, p in QUARTILES.items()])
