"""Frames and brute-force twins shared by the tests."""

from pyspark.sql import DataFrame

RAW_DDL = (
    "customer_id BIGINT, age BIGINT, gender STRING, region STRING, income DOUBLE, "
    "num_purchases_last_month BIGINT, purchase_amount_last_month DOUBLE, "
    "browsing_minutes_last_week DOUBLE, top_category STRING, best_action STRING"
)


def raw_frame(spark, rows):
    """Rows as dicts; missing columns get harmless values."""
    base = dict(
        customer_id=1,
        age=40,
        gender="M",
        region="South",
        income=50000.0,
        num_purchases_last_month=2,
        purchase_amount_last_month=100.0,
        browsing_minutes_last_week=10.0,
        top_category="Toys",
        best_action="SMS",
    )
    filled = [{**base, "customer_id": i + 1, **r} for i, r in enumerate(rows)]
    names = [c.split()[0] for c in RAW_DDL.split(", ")]
    return spark.createDataFrame([[r[c] for c in names] for r in filled], RAW_DDL)


def rows(df: DataFrame, *order):
    got = [tuple(r) for r in df.collect()]
    return sorted(got, key=lambda t: tuple((x is None, x) for x in t)) if not order else got


def as_dict(df: DataFrame, key: str):
    return {r[key]: r.asDict() for r in df.collect()}


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def partitions_read(df: DataFrame) -> list[int]:
    """Partitions each file scan of the main plan has read, after running the query."""
    df.collect()
    found = []

    def walk(node):
        metrics = node.metrics()
        if "Scan" in node.nodeName() and metrics.contains("numPartitions"):
            found.append(metrics.apply("numPartitions").value())
        for inner in ("executedPlan", "plan"):
            if hasattr(node, inner):
                try:
                    walk(getattr(node, inner)())
                except Exception:  # py4j offers every name; only the adaptive nodes answer
                    pass
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found
