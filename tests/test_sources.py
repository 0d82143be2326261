import datetime as dt

import pytest
from helpers import plan, raw_frame, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actionspark.sources import tables
from actionspark.sources.customer360 import customer_snapshots, load_warehouse, raw_customers
from actionspark.sources.schemas import RAW_CUSTOMERS, WAREHOUSE, SchemaMismatch, conform


def test_conform_rejects_missing_and_retyped_columns(spark):
    good = raw_frame(spark, [{}])
    assert conform(good.select(*reversed(good.columns)), RAW_CUSTOMERS).columns == RAW_CUSTOMERS.fieldNames()
    with pytest.raises(SchemaMismatch, match="income: expected double, missing"):
        conform(good.drop("income"), RAW_CUSTOMERS)
    with pytest.raises(SchemaMismatch, match="age: expected bigint, found int"):
        conform(good.withColumn("age", F.col("age").cast("int")), RAW_CUSTOMERS)


def test_overwrite_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not tables.table_exists(spark, path)
    tables.overwrite_table(spark.range(5), path)
    tables.overwrite_table(spark.range(2).select("id", F.lit("x").alias("extra")), path)
    assert tables.table_exists(spark, path)
    assert rows(tables.read_table(spark, path)) == [(0, "x"), (1, "x")]
    with pytest.raises(SchemaMismatch):
        tables.read_table(spark, path, RAW_CUSTOMERS)


def test_catalog_tables(spark):
    tables.overwrite_table(spark.range(3), "catalogued")
    assert tables.table_exists(spark, "catalogued") and not tables.table_exists(spark, "absent_table")
    assert tables.read_table(spark, "catalogued", T.StructType([T.StructField("id", T.LongType())])).count() == 3
    assert tables.baseline_full(spark.range(7), "catalogued_baseline").count() == 7


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    feats = spark.range(200).select(F.col("id").alias("customer_id"), (F.col("id") * 2).alias("x"))
    recs = spark.range(300).select(F.col("id").alias("customer_id"), F.lit("SMS").alias("action"))
    tables.overwrite_table(feats, "feats_bucketed", bucket_by=(4, "customer_id"))
    tables.overwrite_table(recs, "recs_bucketed", bucket_by=(4, "customer_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("recs_bucketed").join(spark.table("feats_bucketed"), "customer_id", "left")
        assert "Exchange" not in plan(joined) and joined.count() == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        tables.overwrite_table(feats, str(tmp_path / "t"), bucket_by=(4, "customer_id"))


def log_rows(spark, day, version, n):
    return spark.range(n).select(
        F.col("id").alias("customer_id"),
        F.lit(dt.date(2024, 1, day)).alias("log_date"),
        F.lit(version).alias("model_version"),
    )


def test_a_batch_replaces_itself_and_adds_to_others(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.append_log(log_rows(spark, 1, "1", 5), path, batch_id="a")
    tables.append_log(log_rows(spark, 2, "1", 4), path, batch_id="a")
    tables.append_log(log_rows(spark, 2, "2", 3), path, batch_id="a")
    tables.append_log(log_rows(spark, 2, "1", 4), path, batch_id="a")  # rerun
    tables.append_log(log_rows(spark, 2, "1", 6), path, batch_id="02")  # another batch of the day
    tables.append_log(log_rows(spark, 2, "1", 1), path, batch_id="2")
    log = tables.read_log(spark, path)
    assert log.count() == 19 and dict(log.dtypes)["model_version"] == dict(log.dtypes)["batch_id"] == "string"
    tables.append_log(log_rows(spark, 2, "1", 2), path, batch_id="a")  # rerun with fewer rows replaces that batch only
    assert tables.read_log(spark, path).count() == 17
    with pytest.raises(SchemaMismatch):
        tables.append_log(spark.range(1), path, batch_id="a")
    with pytest.raises(SchemaMismatch, match="batch_id"):
        tables.append_log(log_rows(spark, 2, "1", 2), path)


def test_append_may_add_columns(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.append_log(log_rows(spark, 1, "1", 2), path, batch_id="a")
    tables.append_log(log_rows(spark, 2, "1", 1).withColumn("channel", F.lit("app")), path, batch_id="a")
    log = tables.read_log(spark, path)
    assert {r["channel"] for r in log.filter("log_date = '2024-01-01'").collect()} == {None}
    assert log.filter("channel = 'app'").count() == 1
    assert tables.read_log(spark, path, log.schema).count() == 3


def test_log_reads_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "log")
    for day in (1, 2, 3):
        tables.append_log(log_rows(spark, day, "1", 5), path, batch_id="a")
    day = tables.read_log(spark, path).filter("log_date = date'2024-01-02'")
    assert day.count() == 5
    assert "PartitionFilters: [isnotnull(log_date" in plan(day) and "log_date#" in plan(day)


def test_baseline_sample_is_stable_and_bounded(spark):
    df = spark.range(500).withColumnRenamed("id", "customer_id")
    one = rows(tables.baseline_sample(df.repartition(1), "customer_id", 50))
    assert one == rows(tables.baseline_sample(df.repartition(9), "customer_id", 50)) and len(one) == 50
    assert tables.baseline_sample(df.limit(3), "customer_id", 50).count() == 3
    assert "TakeOrderedAndProject" in plan(tables.baseline_sample(df, "customer_id", 50))


def test_intermediate_tables_go_to_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = tables.shared_dir(spark)
    assert named is None or folder == named.rstrip("/")
    stored = tables.materialize(spark.range(4), "numbers")
    assert stored.count() == 4 and folder.removeprefix("file:") in stored.inputFiles()[0]
    assert tables.scratch_path(spark, "a") != tables.scratch_path(spark, "a")


def test_scratch_tables_of_a_block_go_with_it(spark):
    import os

    outer = tables.materialize(spark.range(2), "outer")
    with tables.scratch(spark):
        inner = tables.materialize(spark.range(3), "inner")
        where = inner.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(where) and inner.count() == 3
    assert not os.path.exists(where) and outer.count() == 2


def brute_customers(t, as_of, browse_as_of):
    """Plain Python over collected tables."""
    get = lambda n: [r.asDict() for r in t[n].collect()]
    region = {r["r_regionkey"]: r["r_name"] for r in get("region")}
    nation = {r["n_nationkey"]: region[r["n_regionkey"]] for r in get("nation")}
    kind = {r["p_partkey"]: r["p_type"] for r in get("part")}
    start = as_of - dt.timedelta(days=540)
    orders = {r["o_orderkey"]: r for r in get("orders") if start < r["o_orderdate"] <= as_of}
    spend, n, cats, minutes = {}, {}, {}, {}
    for o in orders.values():
        c = o["o_custkey"]
        n[c] = n.get(c, 0) + 1
        spend[c] = spend.get(c, 0) + round(o["o_totalprice"] * 100)
    for li in get("lineitem"):
        if li["l_orderkey"] in orders and li["l_partkey"] in kind:
            k = cats.setdefault(orders[li["l_orderkey"]]["o_custkey"], {})
            k[kind[li["l_partkey"]]] = k.get(kind[li["l_partkey"]], 0) + round(li["l_extendedprice"] * 100)
    for e in get("events"):
        if e["event_type"] in ("view", "click") and browse_as_of - dt.timedelta(days=7) < e["ts"] <= browse_as_of:
            minutes[e["user_id"]] = minutes.get(e["user_id"], 0) + round(e["value"] * 100)
    out = {}
    for c in get("customer"):
        k = c["c_custkey"]
        out[k] = (
            nation[c["c_nationkey"]],
            n.get(k, 0),
            int(spend.get(k, 0) / 100 / 1800 * 100) / 100,
            int(minutes.get(k, 0) / 100 / 5 * 100) / 100,
            min(cats[k], key=lambda x: (-cats[k][x], x)) if k in cats else "NONE",
        )
    return out


COMPARED = (
    "region",
    "num_purchases_last_month",
    "purchase_amount_last_month",
    "browsing_minutes_last_week",
    "top_category",
)


def test_customer_view_against_brute_force(spark, sf):
    t = load_warehouse(spark, sf)
    as_of, browse = dt.datetime(2000, 6, 1), dt.datetime(2024, 1, 20, 12)
    got = {
        r["customer_id"]: tuple(r[c] for c in COMPARED)
        for r in raw_customers(t, as_of=as_of, browse_as_of=str(browse)).collect()
    }
    assert got == brute_customers(t, as_of, browse)


def test_snapshots_in_one_pass_equal_single_snapshots(spark, sf):
    t = load_warehouse(spark, sf)
    many = customer_snapshots(t, 3)
    newest = t["orders"].agg(F.max("o_orderdate")).first()[0]
    browse = t["events"].agg(F.max("ts")).first()[0]
    for k in range(3):
        single = raw_customers(
            t, as_of=newest - dt.timedelta(days=180 * k), browse_as_of=browse - dt.timedelta(days=7 * k)
        )
        part = many.filter(F.col("snapshot") == k)
        assert rows(part.select(*RAW_CUSTOMERS.fieldNames())) == rows(single)
        assert part.select("as_of").distinct().first()[0] == newest - dt.timedelta(days=180 * k)


def test_chosen_snapshots_equal_those_of_all(spark, sf):
    t = load_warehouse(spark, sf)
    some, every = customer_snapshots(t, [0, 2]), customer_snapshots(t, 3)
    assert rows(some) == rows(every.filter("snapshot <> 1"))


def test_customer_view_with_a_hot_customer(spark, sf):
    """A third of the orders belongs to one customer, a third of the lines to one order."""
    t = dict(load_warehouse(spark, sf))
    t["orders"] = t["orders"].withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey")).cast("long")
    )
    busiest = t["orders"].orderBy(F.desc("o_orderdate"), "o_orderkey").first()["o_orderkey"]
    t["lineitem"] = t["lineitem"].withColumn(
        "l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(busiest)).otherwise(F.col("l_orderkey"))
    )
    as_of = t["orders"].agg(F.max("o_orderdate")).first()[0]
    browse = t["events"].agg(F.max("ts")).first()[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r["customer_id"]: tuple(r[c] for c in COMPARED) for r in raw_customers(t).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == brute_customers(t, as_of, browse)


def test_scans_are_pruned_and_filtered(spark, sf):
    text = plan(raw_customers(load_warehouse(spark, sf)))
    assert "GreaterThan(o_orderdate,ScalarSubquery" in text and "GreaterThan(ts,ScalarSubquery" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in text


def test_declared_schemas_match_the_files(spark, sf):
    for name, schema in WAREHOUSE.items():
        found = spark.read.parquet(f"{sf}/{name}.parquet").schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schema], name


def test_hot_keys_are_split_in_both_fact_joins(spark, sf, tmp_path):
    """A third of the lines on one order and one part: the adaptive planner marks both joins as skewed."""
    t = dict(load_warehouse(spark, sf))
    lines = t["lineitem"]
    hot = F.col("l_linenumber") % 3 == 0
    many = lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("copy")
    many = many.withColumn("l_orderkey", F.when(hot, F.lit(5)).otherwise(F.col("l_orderkey")).cast("long"))
    many = many.withColumn("l_partkey", F.when(hot, F.lit(7)).otherwise(F.col("l_partkey")).cast("long"))
    many.repartition(16).write.parquet(str(tmp_path / "lineitem"))
    t["lineitem"] = spark.read.parquet(str(tmp_path / "lineitem"))
    t["orders"] = t["orders"].withColumn(
        "o_orderdate", F.when(F.col("o_orderkey") == 5, F.lit("2001-07-01").cast("timestamp_ntz")).otherwise(F.col("o_orderdate"))
    )
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        df = raw_customers(t)
        assert len(df.collect()) == 150
        assert plan(df).count("SortMergeJoin(skew=true)") >= 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
