"""Categorical vocabulary learned once, and the drop-first encodings it gives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actionspark.functions.numeric import to_long
from actionspark.functions.ranks import row_ranks


def fit_vocabulary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, feature_ordinal, category, ordinal, is_base): sorted distinct values, the first is the base.

    Values are made distinct before anything else, and ranked in ranges, so a column may have any number of them.
    """
    order = F.create_map(*[F.lit(x) for i, c in enumerate(cols) for x in (c, i)])
    seen = to_long(df, [], cols, "feature", "category", "string").filter("category IS NOT NULL").distinct()
    placed = seen.withColumn("feature_ordinal", order[F.col("feature")])
    ranked = row_ranks(placed, [F.col("feature_ordinal"), F.col("category")])
    first = ranked.groupBy("feature").agg(F.min("rank").alias("first"))  # one row per column
    return (
        ranked.join(F.broadcast(first), "feature")
        .withColumn("ordinal", (F.col("rank") - F.col("first")).cast("int"))
        .select("feature", "feature_ordinal", "category", "ordinal", (F.col("ordinal") == 0).alias("is_base"))
        .orderBy("feature_ordinal", "ordinal")
    )


def load_vocabulary(vocabulary: DataFrame) -> list[tuple[str, str]]:
    """The encoded (feature, category) pairs in matrix order, base levels left out: the column names of
    the wide form, which is for reading and for few categories. The forest takes :func:`index_categories`."""
    rows = vocabulary.filter(~F.col("is_base")).orderBy("feature_ordinal", "ordinal").collect()
    return [(r["feature"], r["category"]) for r in rows]


def one_hot_columns(encoded: Sequence[tuple[str, str]], numerics: Sequence[str]) -> list[Column]:
    """Numerics, then one 0/1 column per pair; NULL and unseen categories give zeros."""
    hot = [
        F.coalesce((F.col(f) == F.lit(cat)).cast("int"), F.lit(0)).alias(f"{f}_{cat}")
        for f, cat in encoded
    ]
    return [F.col(n) for n in numerics] + hot


def one_hot(
    df: DataFrame, encoded: Sequence[tuple[str, str]], numerics: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Design matrix in the exact training order; one projection whatever the number of categories."""
    return df.select(*keep, *one_hot_columns(encoded, numerics))


def matrix_names(encoded: Sequence[tuple[str, str]], numerics: Sequence[str]) -> list[str]:
    return list(numerics) + [f"{f}_{cat}" for f, cat in encoded]


def category_sizes(vocabulary: DataFrame, cols: Sequence[str]) -> list[int]:
    """Indexes each column needs: one per category beside the base, and the last for base, NULL and unseen."""
    found = {r["feature"]: r["n"] for r in vocabulary.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    return [max(2, found.get(c, 0)) for c in cols]  # an encoder needs two


def index_name(col: str) -> str:
    return f"{col}_index"


def index_categories(
    df: DataFrame, vocabulary: DataFrame, cols: Sequence[str], sizes: Sequence[int], keep: Sequence[str]
) -> DataFrame:
    """``keep`` and an index column per categorical column, by a join with the vocabulary of any size.

    The base, NULL and categories that were not there at training get the last index, which the encoder drops.
    """
    slim = df.select(*keep, *[c for c in cols if c not in keep])
    for c, size in zip(cols, sizes, strict=True):
        known = vocabulary.filter((F.col("feature") == c) & ~F.col("is_base")).select(
            F.col("category").alias("_category"), (F.col("ordinal") - 1).alias("_at")
        )
        slim = slim.join(known, F.col(c).cast("string") == F.col("_category"), "left")
        index = F.coalesce("_at", F.lit(size - 1)).cast("double")
        slim = slim.withColumn(index_name(c), index).drop("_category", "_at")
    return slim.select(*keep, *map(index_name, cols))


def one_hot_sparse(df: DataFrame, vocabulary: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """(key, feature, category, position): the ones of the design matrix's categorical part, a row each.

    ``position`` is the column's place in that part, as in the wide form. The vocabulary is joined, not collected, so a column
    may have any number of categories and the driver holds none. Base, NULL and unseen categories have no row.
    """
    sizes = vocabulary.groupBy("feature", "feature_ordinal").agg((F.count("*") - 1).alias("n"))  # one row per column
    earlier = Window.partitionBy(F.lit(1)).orderBy("feature_ordinal").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("feature", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    known = vocabulary.filter(~F.col("is_base")).join(F.broadcast(firsts), "feature")
    known = known.select("feature", "category", (F.col("first") + F.col("ordinal") - 1).alias("position"))
    return to_long(df, [key], cols, "feature", "category", "string").join(known, ["feature", "category"]).select(
        key, "feature", "category", "position"
    )
