"""Windowed profiles of numeric columns and predictions, and how they change from window to window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actionspark.functions.numeric import percent, safe_ratio, to_long
from actionspark.functions.ranks import cumulative_counts, quantile_columns, value_counts
from actionspark.operators.summary import QUARTILES, moments

GRANULARITIES = ("day", "week")
SLICE = ("slice_key", "slice_value")


def window_start(ts: str, granularity: str) -> Column:
    """First day of the window; weeks start on Monday. Rows without a timestamp share a NULL window."""
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {GRANULARITIES}, not {granularity}")
    return F.date_trunc(granularity, F.col(ts)).cast("date")


def _slices(columns: Sequence[str]) -> Column:
    """The whole window, and the window per value of each slicing column."""
    everything = F.struct(F.lit("all").alias("slice_key"), F.lit("all").alias("slice_value"))
    return F.array(
        everything,
        *[
            F.struct(
                F.lit(c).alias("slice_key"),
                F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("slice_value"),
            )
            for c in columns
        ],
    )


def _row_hash(cols: Sequence[str], slices: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c).cast("double") for c in cols], *[F.col(c).cast("string") for c in slices]).cast(
        "decimal(20,0)"
    )


def profile(
    df: DataFrame,
    ts: str,
    granularity: str,
    cols: Sequence[str],
    slices: Sequence[str] = (),
    exact: bool = False,
) -> DataFrame:
    """Per window, slice and column: n_rows, n_null, n_distinct, mean, stddev, min, quartiles, max, content.

    ``content`` is a sum of hashes over the window's rows, in the profiled and slicing columns: what tells a refresh
    that rows were replaced although their number is the same.

    By default distinct counts and quartiles are sketches, and the whole profile is one scan and one
    shuffle of fixed-size buffers. ``exact`` takes them from the counts per distinct value instead.
    """
    cut = df.select(
        window_start(ts, granularity).alias("window_start"),
        _row_hash(cols, slices).alias("_hash"),
        F.inline(_slices(slices)),
        *[F.col(c).cast("double").alias(c) for c in cols],
    )
    window = ["window_start", *SLICE]
    keys = [*window, "column_name"]
    wide = cut.groupBy(*window).agg(
        F.count("*").alias("n_rows"),
        F.sum("_hash").alias("content"),
        *[moments(c, sketched=not exact) for c in cols],
    )
    out = wide.unpivot([*window, "n_rows", "content"], list(cols), "column_name", "m").select(
        *keys, "n_rows", "content", (F.col("n_rows") - F.col("m.n")).alias("n_null"), "m.*"
    )
    if exact:
        rows = to_long(cut, window, cols, "column_name", "value", "double")
        ranked = cumulative_counts(value_counts(rows, keys, "value"), keys, "value")
        ranks = ranked.groupBy(*keys).agg(
            F.count("*").alias("n_distinct"), *quantile_columns(ranked, "value", QUARTILES)
        )
        renamed = ranks.select(*[F.col(k).alias(f"r_{k}") for k in keys], "n_distinct", *QUARTILES)
        same = [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys]
        out = out.join(renamed, same, "left").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))
    shape = ["n_rows", "n_null", "n_distinct", "mean", "stddev", "min", *QUARTILES, "max", "content"]
    return out.select(F.lit(granularity).alias("granularity"), *keys, *shape)


def prediction_profile(
    log: DataFrame,
    ts: str = "inference_timestamp",
    granularity: str = "day",
    model: str = "model_version",
    prediction: str = "recommended_action",
) -> DataFrame:
    """Per window, overall and per model version: count and share of each prediction.

    The log is counted once at the finest level; the slices are sums of those few rows.
    """
    fine = log.groupBy(
        window_start(ts, granularity).alias("window_start"), F.col(model), F.col(prediction)
    ).agg(F.count("*").alias("n"))
    rolled = (
        fine.select("window_start", F.inline(_slices([model])), prediction, "n")
        .groupBy("window_start", *SLICE, prediction)
        .agg(F.sum("n").alias("n_rows"))
    )
    total = F.sum("n_rows").over(Window.partitionBy("window_start", *SLICE))
    return rolled.select(
        F.lit(granularity).alias("granularity"),
        "window_start",
        *SLICE,
        prediction,
        "n_rows",
        percent(F.col("n_rows"), total).alias("share_pct"),
    )


def drift_consecutive(profiles: DataFrame, since=None) -> DataFrame:
    """Change of every profiled column against the window before it, from ``since`` on if given.

    Runs on the profile table, which has one row per window, slice and column.
    """
    series = Window.partitionBy("granularity", *SLICE, "column_name").orderBy("window_start")
    null_pct = percent(F.col("n_null"), F.col("n_rows"))
    lagged = profiles.select(
        "granularity",
        "window_start",
        *SLICE,
        "column_name",
        F.lag("window_start").over(series).alias("previous_window"),
        (F.col("n_rows") - F.lag("n_rows").over(series)).alias("delta_rows"),
        (F.col("mean") - F.lag("mean").over(series)).alias("delta_mean"),
        (F.col("stddev") - F.lag("stddev").over(series)).alias("delta_stddev"),
        (null_pct - F.lag(null_pct).over(series)).alias("delta_null_pct"),
        safe_ratio(F.col("mean") - F.lag("mean").over(series), F.lag("stddev").over(series)).alias(
            "shift_in_stddev"
        ),
    ).filter(F.col("previous_window").isNotNull())
    return lagged if since is None else lagged.filter(F.col("window_start") >= since)


def stale_windows(
    stored: DataFrame, df: DataFrame, ts: str, granularity: str, cols: Sequence[str], slices: Sequence[str] = ()
) -> list[dt.date | None]:
    """Windows whose rows are not those that ``stored`` was made of: new, grown, replaced or emptied ones.

    One aggregate of counts and hashes over the source, joined with the stored figures; what reaches the driver is
    one date per stale window, so its size follows the time span, not the rows.
    """
    now = df.groupBy(window_start(ts, granularity).alias("window_start")).agg(
        F.count("*").alias("n_rows"), F.sum(_row_hash(cols, slices)).alias("content")
    )
    mine = stored.filter((F.col("granularity") == granularity) & (F.col("slice_key") == "all"))
    then = mine.select(F.col("window_start").alias("_window"), "n_rows", "content").distinct()
    same = (
        now["window_start"].eqNullSafe(then["_window"])
        & (now["n_rows"] == then["n_rows"])
        & now["content"].eqNullSafe(then["content"])
    )
    changed = now.join(then, same, "left_anti").select("window_start")
    gone = then.join(now, same, "left_anti").select(F.col("_window").alias("window_start"))
    return [r["window_start"] for r in changed.unionByName(gone).distinct().orderBy("window_start").collect()]


def in_windows(ts: str, granularity: str, windows: Sequence[dt.date | None]) -> Column:
    """Rows of the given windows, as plain ranges of ``ts`` (adjoining windows as one), which reach the scan."""
    step = dt.timedelta(days=7 if granularity == "week" else 1)
    ranges: list[list[dt.date]] = []
    for w in sorted(w for w in windows if w is not None):
        if ranges and ranges[-1][1] == w:
            ranges[-1][1] = w + step
        else:
            ranges.append([w, w + step])
    wanted = F.col(ts).isNull() if None in windows else F.lit(False)
    for a, b in ranges:
        wanted = wanted | ((F.col(ts) >= _midnight(a)) & (F.col(ts) < _midnight(b)))
    return wanted


def _midnight(day: dt.date) -> Column:
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


def refresh_profile(
    stored: DataFrame,
    df: DataFrame,
    ts: str,
    granularity: str,
    cols: Sequence[str],
    slices: Sequence[str] = (),
    exact: bool = False,
) -> DataFrame:
    """``stored`` brought up to date: every window whose rows changed since, however old, is computed again, and only
    those windows' rows are read for it."""
    mine = stored.filter(F.col("granularity") == granularity)
    stale = stale_windows(stored, df, ts, granularity, cols, slices)
    fresh = profile(df.filter(in_windows(ts, granularity, stale)), ts, granularity, cols, slices, exact)
    known = [w for w in stale if w is not None]
    kept = ~F.col("window_start").isin(known) if known else F.lit(True)
    missing = F.col("window_start").isNull()
    kept = F.when(missing, F.lit(None not in stale)).otherwise(kept)
    return mine.filter(kept).select(*fresh.columns).unionByName(fresh)


SKETCH_K = 1000
SKETCHED = ("n", "mean", "m2", "min", "max", "quantiles", "distinct")


def day_sketches(df: DataFrame, ts: str, cols: Sequence[str], slices: Sequence[str] = ()) -> DataFrame:
    """What a profile of any coarser window can be merged from: per day, slice and column the rows, the known values, their
    mean, sum of squared deviations and extremes, and two sketches as binary columns.

    ``quantiles`` is a KLL sketch (a rank is off by less than a hundredth), ``distinct`` an HLL one. A sketch has a fixed size, so
    the stored table grows with days, slices and columns only. NaN is not a value of a sketch.
    """
    cut = df.select(
        window_start(ts, "day").alias("window_start"),
        F.inline(_slices(slices)),
        *[F.col(c).cast("double").alias(c) for c in cols],
    )

    def sketch(c: str) -> Column:
        number = F.nanvl(F.col(c), F.lit(None).cast("double"))
        return F.struct(
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            (F.var_pop(c) * F.count(c)).alias("m2"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
            F.kll_sketch_agg_double(number, F.lit(SKETCH_K)).alias("quantiles"),
            F.hll_sketch_agg(F.col(c).cast("string")).alias("distinct"),
        ).alias(c)

    keys = ["window_start", *SLICE]
    wide = cut.groupBy(*keys).agg(F.count("*").alias("n_rows"), *[sketch(c) for c in cols])
    return wide.unpivot([*keys, "n_rows"], list(cols), "column_name", "m").select(*keys, "column_name", "n_rows", "m.*")


def merged_sketches(days: DataFrame, granularity: str | None = None) -> DataFrame:
    """``day_sketches`` of several days as one row per window (all time without ``granularity``), slice and column, sketches
    included, so that what was merged can be merged again."""
    start = F.date_trunc(granularity, F.col("window_start")).cast("date") if granularity else F.lit(None).cast("date")
    by = [start.alias("window_start"), *SLICE, "column_name"]
    total, sum_of = F.sum("n"), F.sum(F.col("n") * F.col("mean"))
    mean = safe_ratio(sum_of, total)
    within = F.sum("m2") + F.sum(F.col("n") * F.col("mean") * F.col("mean")) - sum_of * mean
    return days.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        total.alias("n"),
        F.when(total > 0, mean).alias("mean"),
        F.greatest(within, F.lit(0.0)).alias("m2"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def sketch_profile(merged: DataFrame, granularity: str) -> DataFrame:
    """The columns of ``profile`` from merged sketches, without the rows: no second scan of the source."""
    probs = F.array(*[F.lit(float(p)) for p in QUARTILES.values()])
    known = F.col("n") > 0
    quartiles = F.when(known, F.kll_sketch_get_quantile_double("quantiles", probs))
    shaped = merged.withColumn("_q", quartiles)
    return shaped.select(
        F.lit(granularity).alias("granularity"),
        "window_start",
        *SLICE,
        "column_name",
        "n_rows",
        (F.col("n_rows") - F.col("n")).alias("n_null"),
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("stddev"),
        "min",
        *[F.get("_q", F.lit(i)).alias(q) for i, q in enumerate(QUARTILES)],
        "max",
    )


def ks_of_sketches(current: DataFrame, baseline: DataFrame, points: int = 400) -> DataFrame:
    """(slice, column_name, n_baseline, n_current, ks) of two merged sketch tables with one window each: the largest gap
    between the distribution functions that ``points`` quantiles of either sketch draw, at any of those quantiles."""
    probs = F.array(*[F.lit((i + 0.5) / points) for i in range(points)])
    on = [*SLICE, "column_name"]
    sides = [
        side.filter("n > 0").select(
            *on, F.col("n").alias(f"n_{name}"), F.col("quantiles").alias(name),
            F.kll_sketch_get_quantile_double("quantiles", probs).alias(f"at_{name}"),
        )
        for name, side in (("baseline", baseline), ("current", current))
    ]
    both = sides[0].join(sides[1], on).withColumn("at", F.concat("at_baseline", "at_current"))

    def below(side: str, x: Column) -> Column:
        return F.size(F.filter(side, lambda v: v <= x)) / points

    gaps = F.transform("at", lambda x: F.abs(below("at_baseline", x) - below("at_current", x)))
    return both.select(*on, "n_baseline", "n_current", F.array_max(gaps).alias("ks"))
