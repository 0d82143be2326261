import pytest
from helpers import rows
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from actionspark.config import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from actionspark.operators import encoding, evaluation, training
from actionspark.operators.features import features, labels
from actionspark.plans.forest import fit_forest, forest_scores, predict
from actionspark.sources.schemas import FEATURES
from actionspark.sources.synthetic import generate_customers
from actionspark.sources.tables import materialize, overwrite_table
from actionspark.streaming.scoring import score_stream

NOW = "2024-05-06 07:08:09"


@pytest.fixture(scope="module")
def fitted(spark):
    raw = materialize(generate_customers(spark, 1200), "raw")
    feats = features(raw, NOW)
    encoded = materialize(encoding.fit_vocabulary(feats, CATEGORICAL_FEATURES), "vocabulary")
    joined = training.training_set(labels(raw), feats, NUMERIC_FEATURES + CATEGORICAL_FEATURES)
    parts = training.exact_split(joined, "customer_id", "action_label")
    train = parts.filter("split = 'train'")
    model = fit_forest(train, encoded, CATEGORICAL_FEATURES, NUMERIC_FEATURES, trees=15, depth=8)
    return model, feats, encoded, parts, train


def test_matrix_has_the_reference_width(fitted):
    assert len(encoding.matrix_names(encoding.load_vocabulary(fitted[2]), NUMERIC_FEATURES)) == 19
    assert fitted[0].stages[-1].numFeatures == 19


def test_forest_beats_the_majority_class(fitted):
    model, _, encoded, parts, _ = fitted
    held_out = parts.filter("split = 'test'")
    scored = predict(model, held_out, encoded, CATEGORICAL_FEATURES, NUMERIC_FEATURES, ["customer_id", "action_label"])
    n = held_out.count()
    majority = held_out.groupBy("action_label").count().agg(F.max("count")).first()[0] / n
    got = evaluation.accuracy(scored).first()
    assert got["n_rows"] == n and got["accuracy"] > max(0.9, majority)


def test_same_rows_same_forest_however_they_arrive(fitted):
    model, feats, encoded, _, train = fitted
    again = fit_forest(
        train.repartition(7).orderBy(F.rand(3)), encoded, CATEGORICAL_FEATURES, NUMERIC_FEATURES, trees=15, depth=8)
    trees = [m.stages[-1].toDebugString.split("numTrees", 1)[1] for m in (again, model)]  # after the uid
    assert trees[0] == trees[1]


def test_single_request_equals_its_row_in_the_batch(spark, fitted, tmp_path):
    model, feats, encoded, _, _ = fitted
    batch = {r["customer_id"]: r for r in forest_scores(model, feats, encoded, CATEGORICAL_FEATURES, NUMERIC_FEATURES, "3", F.lit(NOW)).collect()}
    assert len(batch) == 1200
    for customer in (5, 77, 1200):
        one = feats.filter(F.col("customer_id") == customer)
        assert forest_scores(model, one, encoded, CATEGORICAL_FEATURES, NUMERIC_FEATURES, "3", F.lit(NOW)).first() == batch[customer]
    odd = feats.limit(1).withColumns({"region": F.lit("Atlantis"), "income": F.lit(None).cast("double")})
    assert forest_scores(model, odd, encoded, CATEGORICAL_FEATURES, NUMERIC_FEATURES, "3", F.lit(NOW)).count() == 1
    path = str(tmp_path / "model")
    model.write().save(path)
    loaded = PipelineModel.load(path)
    kept = rows(forest_scores(loaded, feats, encoded, CATEGORICAL_FEATURES, NUMERIC_FEATURES, "3", F.lit(NOW)))
    assert kept == sorted(tuple(r) for r in batch.values())


def test_stream_equals_batch_and_goes_on_after_a_restart(spark, fitted, tmp_path):
    model, feats, encoded, _, _ = fitted
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    score = lambda df: forest_scores(
        model, df, encoded, CATEGORICAL_FEATURES, NUMERIC_FEATURES, "3", F.col("updated_at"), carry=["updated_at"]
    )
    first, second = feats.filter("customer_id <= 700"), feats.filter("customer_id > 700")
    overwrite_table(first.repartition(4), source)
    score_stream(spark, source, sink, state, score, max_files_per_trigger=1).awaitTermination()
    assert rows(spark.read.parquet(sink)) == rows(score(first))
    second.write.mode("append").parquet(source)
    for _ in range(2):  # the second restart finds nothing new
        score_stream(spark, source, sink, state, score).awaitTermination()
    assert rows(spark.read.parquet(sink)) == rows(score(feats))
    assert feats.columns == FEATURES.fieldNames()


def test_a_number_with_many_values_is_split_exactly(spark):
    """997 values and one clean threshold: every training row gets its label back."""
    df = spark.range(4000).select(
        F.col("id").alias("customer_id"), (F.col("id") * 7 % 997).cast("double").alias("x"), F.lit("St. Gallen").alias("town")
    )
    df = df.withColumn("town", F.when(F.col("customer_id") % 3 == 0, "Bern").otherwise(F.col("town")))
    train = df.withColumn("action_label", (F.col("x") >= 611).cast("int"))
    vocabulary = encoding.fit_vocabulary(train, ["town"])
    model = fit_forest(train, vocabulary, ["town"], ["x"], trees=1, depth=5, max_bins=1024, bootstrap=False, features_per_split="all")
    scored = predict(model, train, vocabulary, ["town"], ["x"], ["customer_id", "action_label"])
    assert scored.filter("action_label <> predicted_label").count() == 0


def test_the_fit_is_bounded_scoring_is_not(spark, fitted):
    _, feats, encoded, _, train = fitted
    small = fit_forest(train, encoded, CATEGORICAL_FEATURES, NUMERIC_FEATURES, trees=3, depth=4, fit_rows=200)
    assert predict(small, feats, encoded, CATEGORICAL_FEATURES, NUMERIC_FEATURES).count() == 1200
