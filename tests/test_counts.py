import datetime as dt

from helpers import rows
from pyspark.sql import functions as F

from actionspark.operators import counts


def test_class_balance_orders_by_count_then_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "best_action STRING")
    assert [tuple(r) for r in counts.class_balance(df).collect()] == [("c", 2), (None, 1), ("a", 1), ("b", 1)]


def test_category_counts_and_shares(spark):
    df = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", None), ("x", "q")], "f STRING, g STRING")
    cc = counts.category_counts(df, ["f", "g"])
    assert rows(cc) == [("f", "x", 3), ("f", "y", 1), ("g", "p", 1), ("g", "q", 2), ("g", None, 1)]
    shares = {(r["feature"], r["category"]): r["share_pct"] for r in counts.shares(cc).collect()}
    assert shares[("f", "x")] == 75.0 and shares[("g", None)] == 25.0
    zero = spark.createDataFrame([("f", "x", 0)], "feature STRING, category STRING, n_rows INT")
    assert counts.shares(zero).first()["share_pct"] == 0.0
    assert counts.shares(zero.limit(0)).count() == 0


def test_action_distribution_is_ordered(spark):
    log = spark.sql(
        "SELECT date_add(date'2024-01-01', CAST(id % 2 AS INT)) AS log_date, "
        "IF(id % 3 = 0, 'SMS', 'Email') AS recommended_action FROM range(9)"
    )
    got = [tuple(r) for r in counts.action_distribution(log).collect()]
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert got == [(d1, "Email", 3), (d1, "SMS", 2), (d2, "Email", 3), (d2, "SMS", 1)]


def test_extent(spark):
    df = spark.sql(
        "SELECT IF(id = 0, NULL, id % 3) AS k, date_add(date'2024-01-01', CAST(id % 4 AS INT)) AS d FROM range(8)"
    )
    r = counts.extent(df, "k", "d").first()
    assert (r["n_rows"], r["n_keys"], r["n_dates"]) == (8, 4, 4)
    assert (r["baseline_date"], r["current_date"]) == (dt.date(2024, 1, 1), dt.date(2024, 1, 4))
    empty = counts.extent(df.filter(F.lit(False)), "k", "d").first()
    assert (empty["n_rows"], empty["n_keys"], empty["n_dates"], empty["baseline_date"]) == (0, 0, 0, None)
