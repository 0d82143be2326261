from helpers import rows
from pyspark.sql import functions as F

from actionspark.operators import encoding

CATS = ["region", "kind"]


def frame(spark, data):
    return spark.createDataFrame(data, "customer_id INT, x DOUBLE, region STRING, kind STRING")


TRAIN = [(1, 1.0, "South", "b"), (2, 2.0, "East", "a"), (3, 3.0, "West", None), (4, 4.0, "East", "c")]


def test_vocabulary_is_sorted_and_marks_the_base(spark):
    got = [tuple(r) for r in encoding.fit_vocabulary(frame(spark, TRAIN), CATS).collect()]
    assert got == [
        ("region", 0, "East", 0, True),
        ("region", 0, "South", 1, False),
        ("region", 0, "West", 2, False),
        ("kind", 1, "a", 0, True),
        ("kind", 1, "b", 1, False),
        ("kind", 1, "c", 2, False),
    ]


def test_vocabulary_takes_any_number_of_categories(spark):
    df = spark.range(10_000).select(F.format_string("c%05d", F.col("id") % 5000).alias("region"), F.lit("one").alias("kind"))
    got = encoding.fit_vocabulary(df, ["region", "kind"]).collect()
    assert [(r["feature"], r["category"], r["ordinal"]) for r in got] == [
        *[("region", f"c{i:05d}", i) for i in range(5000)], ("kind", "one", 0),
    ]


def test_indexes_send_base_null_and_unseen_to_the_last(spark):
    vocabulary = encoding.fit_vocabulary(frame(spark, TRAIN), CATS)
    sizes = encoding.category_sizes(vocabulary, CATS)
    assert sizes == [3, 3]
    batch = frame(spark, [*TRAIN, (9, 1.0, "North", "z")])
    got = encoding.index_categories(batch, vocabulary, CATS, sizes, ["customer_id"])
    assert rows(got) == [(1, 0.0, 0.0), (2, 2.0, 2.0), (3, 1.0, 2.0), (4, 2.0, 1.0), (9, 2.0, 2.0)]


def test_one_hot_is_the_same_for_any_batch(spark):
    encoded = encoding.load_vocabulary(encoding.fit_vocabulary(frame(spark, TRAIN), CATS))
    assert encoding.matrix_names(encoded, ["x"]) == ["x", "region_South", "region_West", "kind_b", "kind_c"]
    full = encoding.one_hot(frame(spark, TRAIN), encoded, ["x"], keep=["customer_id"])
    assert full.columns == ["customer_id", "x", "region_South", "region_West", "kind_b", "kind_c"]
    assert rows(full) == [
        (1, 1.0, 1, 0, 1, 0),
        (2, 2.0, 0, 0, 0, 0),
        (3, 3.0, 0, 1, 0, 0),
        (4, 4.0, 0, 0, 0, 1),
    ]
    for row in TRAIN:  # a batch of one, without the base category or with the base only
        single = encoding.one_hot(frame(spark, [row]), encoded, ["x"], keep=["customer_id"])
        assert rows(single) == [r for r in rows(full) if r[0] == row[0]]
    unseen = encoding.one_hot(frame(spark, [(9, 1.0, "North", "z")]), encoded, ["x"])
    assert rows(unseen) == [(1.0, 0, 0, 0, 0)]


def test_sparse_form_holds_the_ones_of_the_wide_one(spark):
    vocabulary = encoding.fit_vocabulary(frame(spark, TRAIN), CATS)
    encoded = encoding.load_vocabulary(vocabulary)
    batch = frame(spark, [*TRAIN, (9, 1.0, "North", "z")])
    got = rows(encoding.one_hot_sparse(batch, vocabulary, CATS, "customer_id"))
    wide = encoding.one_hot(batch, encoded, [], keep=["customer_id"]).collect()
    want = [(r[0], *pair, i) for r in wide for i, pair in enumerate(encoded) if r[i + 1]]
    assert got == sorted(want)
