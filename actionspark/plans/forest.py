"""Random forest on the one-hot design matrix, and scoring with the model it gives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actionspark.functions.numeric import hash_u32
from actionspark.operators.encoding import category_sizes, index_categories, index_name
from actionspark.operators.logs import recommendations
from actionspark.sources.tables import materialize

VECTOR = "matrix_row"
MAX_BINS = 256
FIT_ROWS = 2_000_000


def fit_forest(
    train: DataFrame,
    vocabulary: DataFrame,
    categoricals: Sequence[str],
    numerics: Sequence[str],
    trees: int = 200,
    depth: int = 30,
    seed: int = 42,
    partitions: int | None = None,
    memory_mb: int = 1024,
    max_bins: int = MAX_BINS,
    fit_rows: int | None = FIT_ROWS,
    bootstrap: bool = True,
    features_per_split: str = "sqrt",
    key: str = "customer_id",
    label: str = "action_label",
) -> PipelineModel:
    """Fit on rows (key, label, features). The level-wise fit runs on the executors; the driver holds the
    trees only, and their size is bounded by ``fit_rows``: of more labelled rows about so many, those with the
    smallest hashes of the key, are fitted on; None takes all. Scoring is never bounded.

    The matrix is stored first, as the fit passes over it many times. Bootstrap weights depend on how rows
    lie in partitions, so it is stored by a hash of the key and sorted: the same rows then give the same
    forest however they arrived. ``partitions``, by default the session's shuffle partitions, sets the
    parallelism of the fit and belongs to the seed. ``memory_mb`` is the space for the split statistics of one
    pass; more of it means fewer passes. ``max_bins`` is how many thresholds a number can be split at: a column with no
    more distinct values than that is split exactly.
    """
    sizes = category_sizes(vocabulary, categoricals)
    if fit_rows is not None and (n := train.count()) > fit_rows:
        train = train.filter(hash_u32(key, seed + 1) < F.lit(int(fit_rows / n * 2**32)))  # the split uses the seed
    partitions = partitions or int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    indexed = index_categories(train, vocabulary, categoricals, sizes, [key, label, *numerics])
    matrix = materialize(indexed.repartition(partitions, key).sortWithinPartitions(key), "matrix")

    indexes = [index_name(c) for c in categoricals]
    vectors = [f"{c}_vector" for c in categoricals]
    largest = train.sparkSession.range(1).select(*[F.lit(float(s - 1)).alias(i) for i, s in zip(indexes, sizes, strict=True)])
    encoder = OneHotEncoder(inputCols=indexes, outputCols=vectors, dropLast=True, handleInvalid="error").fit(largest)

    def assembler(missing: str) -> VectorAssembler:
        return VectorAssembler(inputCols=[*numerics, *vectors], outputCol=VECTOR, handleInvalid=missing)

    rows = assembler("error").transform(encoder.transform(matrix))
    forest = RandomForestClassifier(
        featuresCol=VECTOR,
        labelCol=label,
        predictionCol="prediction",
        numTrees=trees,
        maxDepth=depth,
        maxBins=max_bins,
        bootstrap=bootstrap,
        featureSubsetStrategy=features_per_split,
        seed=seed,
        cacheNodeIds=True,  # rows remember their node, so deep trees are not shipped at every level
        checkpointInterval=10,
        maxMemoryInMB=memory_mb,
    )
    fitted = forest.fit(rows.select(VECTOR, F.col(label).cast("double").alias(label)))
    # a scoring row with a missing number must still be scored: NaN takes the right branch of a split
    return PipelineModel([encoder, assembler("keep"), fitted])


def predict(
    model: PipelineModel,
    feats: DataFrame,
    vocabulary: DataFrame,
    categoricals: Sequence[str],
    numerics: Sequence[str],
    keep: Sequence[str] = ("customer_id",),
) -> DataFrame:
    """(keep, predicted_label) for every row; the trees are shipped with the tasks."""
    sizes = model.stages[0].categorySizes
    wanted = [*keep, *[n for n in numerics if n not in keep]]
    scored = model.transform(index_categories(feats, vocabulary, categoricals, sizes, wanted))
    return scored.select(*keep, F.col("prediction").cast("int").alias("predicted_label"))


def forest_scores(
    model: PipelineModel,
    feats: DataFrame,
    vocabulary: DataFrame,
    categoricals: Sequence[str],
    numerics: Sequence[str],
    version: str | Column,
    run_ts,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Recommendations for a batch or for any frame of requests; both take the same path, so a single
    request gets what its row in a batch gets. ``carry`` names input columns that ``run_ts`` or
    ``version`` refer to."""
    predicted = predict(model, feats, vocabulary, categoricals, numerics, keep=["customer_id", *carry])
    return recommendations(predicted, "predicted_label", run_ts, version)
