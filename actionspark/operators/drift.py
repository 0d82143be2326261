"""Distance between a current table and its baseline, per column.

With p the current and q the baseline share of a category or bin:
total variation = sum |p-q| / 2; PSI = sum (p-q) ln(p/q) on shares smoothed as (n+1/2)/(N+K/2);
Jensen-Shannon distance with logarithms to base 2; chi-squared on the 2 x K table; KS = max |F_p - F_q|.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actionspark.functions.numeric import safe_ratio, to_long
from actionspark.functions.ranks import cumulative_counts, value_counts


def _columns() -> tuple[Column, Column, Column, Column]:
    """Rows of a cell and of its feature: baseline, current, baseline total, current total."""
    return tuple(F.col(c) for c in ("n_baseline", "n_current", "total_baseline", "total_current"))


def _both_sides(current: DataFrame, baseline: DataFrame, cols: Sequence[str], dtype: str) -> DataFrame:
    sides = [
        to_long(df, [], cols, "feature", "value", dtype).withColumn("is_current", F.lit(flag))
        for df, flag in ((baseline, False), (current, True))
    ]
    return sides[0].unionByName(sides[1])


def _side_counts() -> dict[str, Column]:
    current = F.col("is_current")
    return {"n_baseline": F.count_if(~current), "n_current": F.count_if(current)}


def _with_totals(cells: DataFrame) -> DataFrame:
    """Adds both totals and the number of cells; one row per compared column, so broadcast."""
    totals = cells.groupBy("feature").agg(
        F.sum("n_baseline").alias("total_baseline"),
        F.sum("n_current").alias("total_current"),
        F.count("*").alias("k"),
    )
    return cells.join(F.broadcast(totals), "feature")


def _psi() -> Column:
    def smooth(n: Column, total: Column) -> Column:
        return (n + 0.5) / (total + 0.5 * F.col("k"))

    n_base, n_cur, t_base, t_cur = _columns()
    p, q = smooth(n_cur, t_cur), smooth(n_base, t_base)
    return F.sum((p - q) * F.ln(p / q))


def categorical_drift(current: DataFrame, baseline: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, total_baseline, total_current, n_categories, total_variation, psi, js_distance, chi2).

    Both tables are counted per category in one shuffle of partial counts; NULL is a category. A category
    that holds most rows costs one partial count per task.
    """
    rows = _both_sides(current, baseline, cols, "string")
    counts = [c.alias(n) for n, c in _side_counts().items()]
    cells = _with_totals(rows.groupBy("feature", F.col("value").alias("category")).agg(*counts))

    n_base, n_cur, t_base, t_cur = _columns()
    p, q = safe_ratio(n_cur, t_cur), safe_ratio(n_base, t_base)
    mid = (p + q) / 2

    def entropy_part(share: Column) -> Column:
        return F.when(share > 0, share * F.log2(share / mid)).when(share == 0, 0.0)

    row_total = n_base + n_cur

    def chi_part(n: Column, total: Column) -> Column:
        expected = safe_ratio(row_total * total, t_base + t_cur)
        return (n - expected) * (n - expected) / F.nullif(expected, F.lit(0.0))

    return cells.groupBy("feature", "total_baseline", "total_current").agg(
        F.count("*").alias("n_categories"),
        (F.sum(F.abs(p - q)) / 2).alias("total_variation"),
        _psi().alias("psi"),
        F.sqrt(F.greatest(F.sum(entropy_part(p) + entropy_part(q)) / 2, F.lit(0.0))).alias("js_distance"),
        F.sum(chi_part(n_base, t_base) + chi_part(n_cur, t_cur)).alias("chi2"),
    )


def numeric_drift(
    current: DataFrame, baseline: DataFrame, cols: Sequence[str], bins: int = 10
) -> DataFrame:
    """(feature, total_baseline, total_current, baseline_mean, current_mean, delta_mean, ks, psi).

    Bins are ``bins`` equal widths between the baseline's finite extremes plus one open bin at either end; KS is
    taken at the bin edges (:func:`ks_exact` takes it at every value). NULL and NaN do not take part.

    One aggregate per side counts all bins of all columns side by side; rows are not multiplied, and what becomes
    rows is one per column and bin.
    """

    def known(c: str) -> Column:
        return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))

    def finite(c: str) -> Column:
        return F.when(F.abs(known(c)) < F.lit(float("inf")), known(c))

    range_of = [F.struct(F.min(finite(c)).alias("lo"), F.max(finite(c)).alias("hi")).alias(c) for c in cols]
    ends = baseline.agg(*range_of).first()  # one row; as literals, since a subquery would stand in every bin of every column

    def bin_of(c: str) -> Column:
        lo, hi, value = F.lit(ends[c]["lo"]).cast("double"), F.lit(ends[c]["hi"]).cast("double"), F.col(c)
        inner = F.floor((value - lo) / F.nullif((hi - lo) / bins, F.lit(0.0)))
        inside = 1 + F.least(F.coalesce(inner, F.lit(0)), F.lit(bins - 1))
        return F.when(value.isNotNull(), F.when(value < lo, 0).when(value > hi, bins + 1).otherwise(inside)).cast("int")

    def counted(df: DataFrame, side: str) -> DataFrame:
        typed = df.select(*[known(c).alias(c) for c in cols])
        placed = typed.select(*cols, *[bin_of(c).alias(f"_bin_{c}") for c in cols])
        figures = [
            F.struct(
                F.array(*[F.count_if(F.col(f"_bin_{c}") == b) for b in range(bins + 2)]).alias("cells"),
                F.coalesce(F.sum(c), F.lit(0.0)).alias("sum"),
            ).alias(c)
            for c in cols
        ]
        one_row = placed.agg(*figures)
        rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias(f"m_{side}")) for c in cols])
        return one_row.select(F.inline(rows))

    sides = counted(baseline, "baseline").join(counted(current, "current"), "feature")  # a row per column
    cells = sides.select(
        "feature",
        F.col("m_baseline.sum").alias("sum_baseline"),
        F.col("m_current.sum").alias("sum_current"),
        F.posexplode(F.arrays_zip(F.col("m_baseline.cells").alias("b"), F.col("m_current.cells").alias("c"))).alias("bin", "n"),
    ).select(
        "feature", "sum_baseline", "sum_current", "bin", F.col("n.b").alias("n_baseline"), F.col("n.c").alias("n_current")
    )
    upto = Window.partitionBy("feature").orderBy("bin")  # bins + 2 rows per feature
    _, _, t_base, t_cur = _columns()
    curved = _with_totals(cells).withColumns(
        {
            "_f_base": safe_ratio(F.sum("n_baseline").over(upto), t_base),
            "_f_cur": safe_ratio(F.sum("n_current").over(upto), t_cur),
        }
    )
    out = curved.groupBy("feature", "total_baseline", "total_current").agg(
        safe_ratio(F.first("sum_baseline"), F.sum("n_baseline")).alias("baseline_mean"),
        safe_ratio(F.first("sum_current"), F.sum("n_current")).alias("current_mean"),
        F.max(F.abs(F.col("_f_cur") - F.col("_f_base"))).alias("ks"),
        _psi().alias("psi"),
    )
    return out.select(
        "feature",
        "total_baseline",
        "total_current",
        "baseline_mean",
        "current_mean",
        (F.col("current_mean") - F.col("baseline_mean")).alias("delta_mean"),
        "ks",
        "psi",
    )


def ks_exact(current: DataFrame, baseline: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, n_baseline, n_current, ks): the largest gap between the two distribution functions."""
    rows = _both_sides(current, baseline, cols, "double")
    counted = value_counts(rows, ["feature"], "value", _side_counts())
    ranked = cumulative_counts(counted, ["feature"], "value", ["n_baseline", "n_current"])
    gap = F.abs(
        safe_ratio(F.col("cum_n_current"), F.col("total_n_current"))
        - safe_ratio(F.col("cum_n_baseline"), F.col("total_n_baseline"))
    )
    return ranked.groupBy("feature").agg(
        F.max("total_n_baseline").alias("n_baseline"),
        F.max("total_n_current").alias("n_current"),
        F.max(gap).alias("ks"),
    )
