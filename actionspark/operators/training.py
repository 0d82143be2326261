"""Training set joins and the train/test split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actionspark.functions.numeric import hash_u32
from actionspark.functions.ranks import row_ranks
from actionspark.sources.tables import materialize

PREFIX_BITS = 16


def training_set(
    labels: DataFrame, feats: DataFrame, columns: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Labels with their features. ``inner`` drops labels without features, ``left`` keeps them (lookup).

    Both sides hold one row per key (checked by ``key_check``), so the join cannot multiply rows.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    return labels.select("customer_id", "action_label").join(
        feats.select("customer_id", *columns), "customer_id", how
    )


def hash_split(df: DataFrame, key: str, test: float = 0.25, seed: int = 42) -> DataFrame:
    """Adds ``split`` by a hash of the key: no shuffle, stable under growth, share only close to ``test``."""
    in_test = hash_u32(key, seed) < F.lit(int(test * 2**32))
    return df.withColumn("split", F.when(in_test, "test").otherwise("train"))


def test_quotas(df: DataFrame, label: str, test: float = 0.25) -> DataFrame:
    """(label, n, test_quota): ceil(test * rows) test rows in all, the train rows shared out among the
    classes in proportion, the remainder going to the largest fractions (ties to the lower label).

    The classes' fractions are ranked in ranges, so there may be any number of classes."""
    classes = materialize(df.groupBy(label).agg(F.count("*").alias("n")), "classes")
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_all"))
    n_all = total.scalar()
    n_train = n_all - F.ceil(n_all * F.lit(test))
    share = classes.withColumn("exact", n_train * F.col("n") / n_all)
    left_over = share.agg(F.max(n_train) - F.sum(F.floor("exact"))).scalar()
    fraction = F.col("exact") - F.floor("exact")
    ranked = row_ranks(share.withColumn("fraction", fraction), [F.desc("fraction"), F.asc_nulls_last(label)])
    extra = (F.col("rank") <= left_over).cast("long")
    return ranked.select(label, "n", (F.col("n") - F.floor("exact") - extra).alias("test_quota"))


def exact_split(df: DataFrame, key: str, label: str, test: float = 0.25, seed: int = 42) -> DataFrame:
    """Adds ``split`` so that every class has exactly its quota of test rows, the lowest hashes first.

    Nothing ranks a whole class: counts per 16-bit hash prefix (at most 65,536 per class) show where
    the quota is reached, only rows of that one prefix are ranked, and the cut-off per class is then
    applied in a single pass over the rows.
    """
    hashed = df.withColumn("_hash", hash_u32(key, seed))
    prefix = F.shiftright("_hash", 32 - PREFIX_BITS).alias("_prefix")
    slim = hashed.select(label, F.col(key).alias("_key"), "_hash", prefix)

    counts = slim.groupBy(label, "_prefix").agg(F.count("*").alias("n"))
    run = Window.partitionBy(label).orderBy("_prefix")
    quotas = materialize(test_quotas(df, label, test), "quotas").select(F.col(label).alias("_label"), "test_quota")
    boundary = (
        counts.withColumn("upto", F.sum("n").over(run))
        .join(quotas, F.col(label).eqNullSafe(F.col("_label")))
        .filter((F.col("upto") >= F.col("test_quota")) & (F.col("upto") - F.col("n") < F.col("test_quota")))
        .select(
            "_label",
            F.col("_prefix").alias("_cut_prefix"),
            (F.col("test_quota") - (F.col("upto") - F.col("n"))).alias("_take"),
        )
    )
    in_boundary = slim.join(
        boundary,
        F.col(label).eqNullSafe(F.col("_label")) & (F.col("_prefix") == F.col("_cut_prefix")),
    )
    rank = F.row_number().over(Window.partitionBy("_label", "_cut_prefix").orderBy("_hash", "_key"))
    cutoff = in_boundary.withColumn("_rank", rank).filter(F.col("_rank") == F.col("_take")).select(
        "_label", F.col("_hash").alias("_cut_hash"), F.col("_key").alias("_cut_key")
    )
    below = (F.col("_hash") < F.col("_cut_hash")) | (
        (F.col("_hash") == F.col("_cut_hash")) & (F.col(key) <= F.col("_cut_key"))
    )
    return (
        hashed.join(cutoff, F.col(label).eqNullSafe(F.col("_label")), "left")
        .withColumn("split", F.when(below, "test").otherwise("train"))
        .drop("_hash", "_label", "_cut_hash", "_cut_key")
    )


RANGES = 64


def features_as_of(
    rows: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    since: str,
    columns: Sequence[str],
    ranges: int = RANGES,
) -> DataFrame:
    """``rows`` with ``columns`` of the history row that held at ``at``: of the same key, the newest with ``since`` <= ``at``.

    Asked are distinct (key, time) pairs, offered one history row per (key, time), so copies of either cost a partial
    aggregate. Time is cut into ``ranges`` of about equally many of them, and the newest row before is found in two levels:
    within a key's range, and for its start from the last row of each of its earlier ranges. So a task
    sorts one range of one key, however many rows a key has. Nothing is joined by inequality.

    Edge cases: a NULL key or time finds nothing; a row older than the key's history finds nothing; a history row at the very
    time counts; of several at one time the largest in the order of ``columns`` does. Rows are kept, also repeated ones;
    an empty history gives NULLs.
    """
    moment = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    asked = rows.select(F.col(key).alias("k"), moment(at).alias("t")).dropna().distinct()
    offered = (
        history.select(F.col(key).alias("k"), moment(since).alias("t"), F.struct(*columns).alias("row"))
        .dropna(subset=["k", "t"])
        .groupBy("k", "t")
        .agg(F.max("row").alias("row"))
    )
    asked, offered = materialize(asked, "asked"), materialize(offered, "offered")
    places = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    both = asked.select("t").unionAll(offered.select("t"))
    bounds = both.agg(F.percentile_approx("t", places, F.lit(10 * ranges))).first()[0] or []
    bounds = F.array(*[F.lit(b).cast("long") for b in sorted(set(bounds))]).cast("array<long>")
    in_range = F.size(F.filter(bounds, lambda b: b < F.col("t"))).alias("r")
    asked, offered = asked.select("k", "t", in_range), offered.select("k", "t", "row", in_range)

    last = offered.groupBy("k", "r").agg(F.max_by("row", "t").alias("row"))
    wanted = asked.select("k", "r").distinct().withColumn("row", F.lit(None).cast(offered.schema["row"].dataType))
    per_range = last.unionByName(wanted).groupBy("k", "r").agg(
        F.max("row").alias("row"), F.max(F.col("row").isNull()).alias("asked")
    )
    earlier = Window.partitionBy("k").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)  # at most a row a range
    carried = per_range.select("k", "r", F.last("row", ignorenulls=True).over(earlier).alias("row"), "asked")
    carried = carried.filter("asked").select("k", "r", F.lit(None).cast("long").alias("t"), "row", F.lit(0).alias("kind"))

    placed = offered.select("k", "r", "t", "row", F.lit(1).alias("kind"))
    asked = asked.select("k", "r", "t", F.lit(None).cast(offered.schema["row"].dataType).alias("row"), F.lit(2).alias("kind"))
    inside = (
        Window.partitionBy("k", "r")
        .orderBy(F.col("t").asc_nulls_first(), "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = carried.unionByName(placed).unionByName(asked).withColumn("row", F.last("row", ignorenulls=True).over(inside))
    found = found.filter("kind = 2").select(F.col("k").alias("_k"), F.col("t").alias("_t"), F.col("row").alias("_found"))
    same = (F.col(key) == F.col("_k")) & (moment(at) == F.col("_t"))
    kept = [c for c in rows.columns if c not in columns]
    return rows.join(found, same, "left").select(*kept, *[F.col(f"_found.{c}").alias(c) for c in columns])
