"""Writes that are seen whole or not at all."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from actionspark.sources import tables, versions


def failing(spark, n=100):
    """Rows of which one fails after others were written."""
    return spark.range(n, numPartitions=4).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))


@pytest.mark.parametrize("keep", [None, 2])
def test_a_failed_overwrite_leaves_the_rows(spark, tmp_path, keep):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="lost"):
        tables.overwrite_table(failing(spark), path, keep=keep)
    assert not tables.table_exists(spark, path)
    tables.overwrite_table(spark.range(5), path, keep=keep)
    with pytest.raises(Exception, match="lost"):
        tables.overwrite_table(failing(spark), path, keep=keep)
    assert rows(tables.read_table(spark, path)) == [(i,) for i in range(5)]
    tables.overwrite_table(spark.range(2), path, keep=keep)
    assert rows(tables.read_table(spark, path)) == [(0,), (1,)]
    left = [n for n in os.listdir(tmp_path) if not n.endswith(".crc")]
    assert left == ["t"]
    if keep:
        assert len(os.listdir(tmp_path / "t" / "_versions")) == 2


def test_a_failed_overwrite_leaves_a_catalogued_table(spark):
    tables.overwrite_table(spark.range(5), "survivor")
    with pytest.raises(Exception, match="lost"):
        tables.overwrite_table(failing(spark), "survivor")
    assert tables.read_table(spark, "survivor").count() == 5
    tables.overwrite_table(spark.range(3).withColumn("more", F.lit("x")), "survivor")
    assert rows(tables.read_table(spark, "survivor")) == [(i, "x") for i in range(3)]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("survivor")] == ["survivor"]
    spark.sql("DROP TABLE survivor")


@pytest.mark.parametrize("keep", [None, 3])
def test_a_table_may_be_made_of_itself(spark, tmp_path, keep):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(4), path, keep=keep)
    for _ in range(3):
        tables.overwrite_table(tables.read_table(spark, path).select((F.col("id") * 2).alias("id")), path, keep=keep)
    assert rows(tables.read_table(spark, path)) == [(0,), (8,), (16,), (24,)]


def test_an_exchange_that_was_cut_short_is_put_right(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(5), path)
    os.rename(path, tmp_path / ".t.old")  # where the process died
    with pytest.raises(Exception, match="lost"):
        tables.overwrite_table(failing(spark), path)
    assert tables.read_table(spark, path).count() == 5


def test_versions_are_kept_by_count_and_pins_hold_them(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.version_numbers(spark, path) == [] and not versions.is_versioned(spark, path)
    with pytest.raises(versions.NoSuchVersion):
        versions.read_version(spark, path)
    assert versions.write_version(spark.range(1), path, keep=2) == 1
    assert versions.pin(spark, path, "baseline") == 1
    for n in range(2, 6):
        assert versions.write_version(spark.range(n).withColumn("n", F.lit(n)), path, keep=2) == n
    assert versions.version_numbers(spark, path) == [1, 4, 5]
    assert rows(versions.read_pinned(spark, path, "baseline")) == [(0,)]
    assert versions.read_version(spark, path, 4).count() == 4 and versions.read_version(spark, path).columns == ["id", "n"]
    with pytest.raises(versions.NoSuchVersion, match="no version 3"):
        versions.read_version(spark, path, 3)
    with pytest.raises(versions.NoSuchVersion, match="no pin other"):
        versions.read_pinned(spark, path, "other")
    versions.pin(spark, path, "baseline", 4)
    versions.write_version(spark.range(6), path, keep=2)
    assert versions.version_numbers(spark, path) == [4, 5, 6] and versions.pins(spark, path) == {"baseline": 4}
    versions.unpin(spark, path, "baseline")
    versions.write_version(spark.range(7), path, keep=1)
    assert versions.version_numbers(spark, path) == [7]
    assert len(os.listdir(tmp_path / "t" / "_versions")) == 1
    with pytest.raises(ValueError):
        versions.write_version(spark.range(1), path, keep=0)


def test_a_reader_keeps_the_version_it_began_with(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(5), path, keep=2)
    before = tables.read_table(spark, path)
    tables.overwrite_table(spark.range(9), path)  # stays versioned
    assert before.count() == 5 and tables.read_table(spark, path).count() == 9


def test_writers_at_the_same_time_all_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda n: versions.write_version(spark.range(n + 1), path, keep=9), range(4)))
    assert sorted(numbers) == [1, 2, 3, 4] == versions.version_numbers(spark, path)
    assert {versions.read_version(spark, path, number).count(): number for number in numbers}.keys() == {1, 2, 3, 4}


def test_a_taken_number_is_not_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write_version(spark.range(1), path)
    files = versions._Files(spark, path)
    assert not files.put(f"{path}/_commits/000000000001.json", "{}")
    assert versions.read_version(spark, path).count() == 1


def test_partitions_and_empty_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write_version(spark.range(9).withColumn("part", (F.col("id") % 3).cast("string")), path, ["part"])
    third = versions.read_version(spark, path).filter("part = '1'")
    assert third.count() == 3 and "PartitionFilters: [isnotnull(part" in plan(third)
    versions.write_version(spark.range(0), path)
    empty = tables.read_table(spark, path)
    assert empty.columns == ["id"] and empty.isEmpty() and tables.table_exists(spark, path)


def test_baseline_is_a_pin(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(5), path, keep=1)
    baseline = tables.baseline_version(spark, path)
    tables.overwrite_table(spark.range(9), path, keep=1)
    tables.overwrite_table(spark.range(10), path, keep=1)
    assert baseline.count() == 5 and versions.read_pinned(spark, path, "baseline").count() == 5
    assert {f.rsplit("/", 2)[1] for f in baseline.inputFiles()} <= set(os.listdir(tmp_path / "t" / "_versions"))
