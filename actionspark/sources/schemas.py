"""Explicit schemas and the checks made on them when a table is read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


INT, LONG, DOUBLE, TEXT, TIME = (
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.StringType(),
    T.TimestampNTZType(),
)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# The warehouse tables the customer view is built from.
WAREHOUSE = {
    "region": _struct(r_regionkey=INT, r_name=TEXT),
    "nation": _struct(n_nationkey=INT, n_name=TEXT, n_regionkey=INT),
    "customer": _struct(
        c_custkey=LONG, c_name=TEXT, c_nationkey=INT, c_acctbal=DOUBLE, c_mktsegment=TEXT
    ),
    "part": _struct(
        p_partkey=LONG, p_name=TEXT, p_brand=TEXT, p_type=TEXT, p_size=INT, p_retailprice=DOUBLE
    ),
    "orders": _struct(
        o_orderkey=LONG,
        o_custkey=LONG,
        o_orderstatus=TEXT,
        o_totalprice=DOUBLE,
        o_orderdate=TIME,
        o_orderpriority=TEXT,
    ),
    "lineitem": _struct(
        l_orderkey=LONG,
        l_partkey=LONG,
        l_suppkey=LONG,
        l_linenumber=INT,
        l_quantity=DOUBLE,
        l_extendedprice=DOUBLE,
        l_discount=DOUBLE,
        l_tax=DOUBLE,
        l_returnflag=TEXT,
        l_linestatus=TEXT,
        l_shipdate=TIME,
    ),
    "events": _struct(event_id=LONG, ts=TIME, user_id=LONG, event_type=TEXT, value=DOUBLE, props=TEXT),
}

# Columns of the raw customer table and of the feature table, in their order.
RAW_CUSTOMERS = _struct(
    customer_id=LONG,
    age=LONG,
    gender=TEXT,
    region=TEXT,
    income=DOUBLE,
    num_purchases_last_month=LONG,
    purchase_amount_last_month=DOUBLE,
    browsing_minutes_last_week=DOUBLE,
    top_category=TEXT,
    best_action=TEXT,
)

FEATURES = _struct(
    customer_id=LONG,
    age=LONG,
    gender_ix=INT,
    income=DOUBLE,
    num_purchases_last_month=LONG,
    purchase_amount_last_month=DOUBLE,
    avg_purchase_value=DOUBLE,
    browsing_minutes_last_week=DOUBLE,
    is_high_spender=INT,
    region=TEXT,
    top_category=TEXT,
    age_bucket=TEXT,
    updated_at=TIME,
)

RECOMMENDATIONS = _struct(
    customer_id=LONG, recommended_action=TEXT, scored_at_ts=TIME, model_version=TEXT
)

_LOGGED_FEATURES = [f for f in FEATURES.fields if f.name not in ("customer_id", "updated_at")]
INFERENCE_LOG = T.StructType(
    _struct(customer_id=LONG, recommended_action=TEXT, scored_at_ts=TIME).fields
    + _LOGGED_FEATURES
    + _struct(inference_timestamp=TIME, log_date=T.DateType(), model_version=TEXT, batch_id=TEXT).fields
)

# What the monitors need to find in each monitored table.
MONITOR_REQUIRED = {
    "features": ("updated_at",),
    "inference_log": ("inference_timestamp", "model_version", "recommended_action"),
}


class SchemaMismatch(ValueError):
    """A table lacks a required column or holds it in another type."""


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema`` in its order; a missing column or another type is an error, not a NULL."""
    found = {f.name: f.dataType for f in df.schema.fields}
    problems = [
        f"{f.name}: expected {f.dataType.simpleString()}, "
        + (f"found {found[f.name].simpleString()}" if f.name in found else "missing")
        for f in schema.fields
        if found.get(f.name) != f.dataType
    ]
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df.select(*schema.fieldNames())
