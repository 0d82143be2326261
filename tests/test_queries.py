"""Every named query against its SQL twin, and the shape of its plan."""

import datetime as dt
import math

import duckdb
import pytest
from helpers import plan

from __spark_entry__ import entry
from actionspark.plans.catalogue import QUERIES
from oracle.sql import ORACLE

TABLES = "region nation customer supplier part orders lineitem events".split()
SLOW = {"rf_scores", "stream_scores", "rf_requests", "stream_against_batch"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def norm(v):
    if v is None or isinstance(v, (bool, str)):
        return repr(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def table(columns, data):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(norm(r[i]) for i in order) for r in data)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    data = df.collect()
    text = plan(df)
    for forbidden in ("NestedLoop", "Cartesian", "EvalPython", "InPandas"):
        assert forbidden not in text
    want = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert table(df.columns, data) == table(want.columns, want.fetchall())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["best_action", "n_rows"] and df.count() == 3
