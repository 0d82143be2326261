import pytest
from helpers import raw_frame
from pyspark.sql import functions as F

from actionspark.functions import rules
from actionspark.operators.features import features, labels, on_date, present, stamp, trailing
from actionspark.sources.schemas import FEATURES


@pytest.mark.parametrize(
    "age,spend,n,browse,expected",
    [
        (27, 0.0, 0, 0.0, "Push"),
        (28, 0.0, 0, 0.0, "SMS"),
        (50, 0.0, 0, 0.0, "SMS"),
        (51, 0.0, 0, 0.0, "Email"),
        (20, 600.0, 0, 0.0, "Push"),
        (20, 600.01, 0, 0.0, "Email"),
        (20, 0.0, 5, 0.0, "Push"),
        (20, 0.0, 6, 0.0, "Email"),
        (60, 0.0, 0, 200.0, "Email"),
        (60, 0.0, 0, 200.01, "Push"),
        (40, 0.0, 0, 200.01, "Push"),
        (None, 0.0, 0, 0.0, "Email"),
        (None, 0.0, 0, 300.0, "Push"),
        (40, None, 0, 0.0, "SMS"),
        (40, None, 6, 0.0, "Email"),
        (40, 0.0, None, None, "SMS"),
        (40, 700.0, None, None, "Email"),
    ],
)
def test_best_action(spark, age, spend, n, browse, expected):
    df = spark.createDataFrame(
        [(age, spend, n, browse)],
        "age BIGINT, purchase_amount_last_month DOUBLE, num_purchases_last_month BIGINT, "
        "browsing_minutes_last_week DOUBLE",
    )
    assert df.select(rules.best_action()).first()[0] == expected


def test_feature_rules_with_nulls(spark):
    df = raw_frame(
        spark,
        [
            dict(gender="M", age=27, purchase_amount_last_month=600.0, num_purchases_last_month=0),
            dict(gender="F", age=28, purchase_amount_last_month=600.01, num_purchases_last_month=4),
            dict(gender=None, age=50, purchase_amount_last_month=None, num_purchases_last_month=2),
            dict(gender="X", age=51, purchase_amount_last_month=9.0, num_purchases_last_month=None),
            dict(gender="M", age=None, purchase_amount_last_month=None, num_purchases_last_month=0),
        ],
    )
    out = features(df, "2024-01-02 03:04:05").orderBy("customer_id")
    assert out.columns == FEATURES.fieldNames()
    got = out.select("gender_ix", "age_bucket", "avg_purchase_value", "is_high_spender").collect()
    assert [tuple(r) for r in got] == [
        (1, "young", 0.0, 0),
        (0, "mid", 600.01 / 4, 1),
        (0, "mid", None, None),
        (0, "senior", 0.0, 0),
        (1, "senior", 0.0, None),
    ]
    assert str(out.first()["updated_at"]) == "2024-01-02 03:04:05"


def test_label_codes_and_inverse(spark):
    df = raw_frame(spark, [dict(best_action=a) for a in ("Email", "SMS", "Push", None, "Fax")])
    coded = labels(df).orderBy("customer_id")
    assert [r["action_label"] for r in coded.collect()] == [0, 1, 2, 2, 2]
    assert [r[0] for r in coded.select(rules.action_name("action_label")).collect()] == [
        "Email", "SMS", "Push", "Push", "Push",
    ]
    with pytest.raises(Exception, match="unknown action code: 7"):
        spark.range(1).select(rules.action_name(F.lit(7))).collect()
    assert spark.range(1).select(rules.action_name(F.lit(None).cast("int"))).first()[0] is None


def test_stamp_and_date_filters(spark):
    df = spark.range(1)
    row = stamp(df, "2024-05-06 07:08:09", "2024-05-06", "3").first()
    assert str(row["log_date"]) == "2024-05-06" and row["model_version"] == "3"
    days = spark.sql("SELECT date_sub(date'2024-01-31', CAST(id AS INT)) AS d FROM range(12)")
    assert trailing(days, "d", "2024-01-31").count() == 8  # both ends count
    later = days.unionByName(spark.sql("SELECT date'2024-03-01' AS d"))
    assert trailing(later, "d", "2024-01-31").count() == 9  # no upper bound
    assert on_date(days, "d", "2024-01-30").count() == 1
    assert present(spark.sql("SELECT CAST(NULL AS INT) AS x UNION ALL SELECT 1"), "x").count() == 1
