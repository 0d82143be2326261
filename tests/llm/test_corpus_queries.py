"""The named queries against their SQL twins, and the pipeline against brute force."""

import duckdb
import pytest
from brute import contamination, near_groups, quality_kept, words

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from actionspark.llm.queries import QUERIES, SQL

TABLES = "documents pages benchmark conversations labels".split()


def test_every_operator_has_a_query():
    names = [n for n in queries() if n.startswith("op")]
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in queries() and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_twin(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    want = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in df.columns]
    assert sorted(repr(tuple(r)) for r in df.collect()) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_returns_a_row_per_document(spark, sf, name):
    rows = QUERIES[name](spark, sf).collect()
    table, key, more = ("conversations", "conv_id", 1) if "chat" in name else ("documents", "doc_id", 0)
    keys = {r[key] for r in rows}
    assert len(rows) == len(keys) == spark.read.parquet(f"{sf}/{table}.parquet").select(key).distinct().count() + more


def test_stages_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: tuple(r) for r in docs.collect()}
    frame = docs

    def applied(name):
        nonlocal frame
        frame = corpus_pipeline.stored(stage[name](spark, frame, sf), "test")
        assert frame.columns[:5] == docs.columns
        return frame.collect()

    verdicts = quality_kept([(r[3], r[1]) for r in rows.values()])
    left = {k: r for (k, r), kept in zip(rows.items(), verdicts, strict=True) if kept}
    assert {r.doc_id: tuple(r) for r in applied(names[0])} == left
    listed = list(left.values())
    groups = near_groups([(r[0], r[1]) for r in listed])
    left = {listed[i][0]: listed[i] for i, (_, m) in groups.items() if listed[i][0] == min(listed[j][0] for j in m)}
    assert {r.doc_id: tuple(r) for r in applied(names[1])} == left
    clean = contamination([r[1] for r in left.values()], items)
    left = {k: r for (k, r), c in zip(left.items(), clean, strict=True) if not c[3]}
    assert {r.doc_id: tuple(r) for r in applied(names[2])} == left
    before = sum(len(words(r[1])) for r in left.values())
    mixed = applied(names[3])
    longest = max(len(words(r[1])) for r in left.values())
    assert abs(sum(len(words(r.text)) for r in mixed) - before) <= 20 * (1 + longest / 2)  # half a row a source
    assert all(tuple(r) == left[r.doc_id] for r in mixed)
    final = applied(names[4])
    assert sorted(tuple(r)[:5] for r in final) == sorted(tuple(r) for r in mixed)
    places = {(r.shard, r.slot) for r in final}
    assert len(places) == len(final)


def test_run_gives_the_last_stage(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
