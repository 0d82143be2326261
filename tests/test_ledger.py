"""Refreshing from changed files, dates from the list of partitions, keyed upserts."""

import datetime as dt
import os

import pytest
from helpers import partitions_read, plan, rows
from pyspark.sql import functions as F

from actionspark.operators import logs, profiles
from actionspark.plans.jobs import refresh_from_files
from actionspark.sources import ledger
from actionspark.sources.tables import append_log, read_log, read_table
from actionspark.sources.upsert import read_keyed, upsert

DAY = dt.date(2024, 1, 1)


def entries(spark, days, n=4, shift=0):
    rows_ = [(DAY + dt.timedelta(days=d) if d is not None else None, float(i + shift), f"m{i % 2}") for d in days for i in range(n)]
    return spark.createDataFrame(rows_, "log_date DATE, x DOUBLE, model_version STRING")


SCHEMA = "log_date DATE, x DOUBLE, model_version STRING, batch_id STRING"


def refreshed(spark, log, path, granularity="day"):
    schema = spark.createDataFrame([], SCHEMA).schema
    return refresh_from_files(spark, log, path, granularity, ["x"], ["model_version"], schema, exact=True)


def fresh(spark, log, granularity="day"):
    return profiles.profile(read_log(spark, log), "log_date", granularity, ["x"], ["model_version"], exact=True)


@pytest.mark.parametrize("granularity", ["day", "week"])
def test_refreshed_profile_is_the_profile(spark, tmp_path, granularity):
    log, path = str(tmp_path / "log"), str(tmp_path / "profile")

    def same():
        columns = [c for c in fresh(spark, log, granularity).columns]
        assert rows(refreshed(spark, log, path, granularity).select(*columns)) == rows(fresh(spark, log, granularity))

    append_log(entries(spark, [0, 1, 8, 9, None]), log, batch_id="a")
    same()
    append_log(entries(spark, [1, 20]), log, batch_id="b")  # a late batch and a new day
    same()
    append_log(entries(spark, [9], shift=5), log, batch_id="a")  # replaced, with as many rows
    same()
    ledger.drop_partitions(spark, log, [DAY + dt.timedelta(days=8), None])  # windows vanish
    same()
    same()  # nothing changed
    left = {r[0] for r in read_table(spark, path).select("window_start").distinct().collect()}
    assert None not in left and (granularity == "week" or DAY + dt.timedelta(days=8) not in left)


def test_two_granularities_share_a_table(spark, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "profile")
    append_log(entries(spark, [0, 1, 8]), log, batch_id="a")
    refreshed(spark, log, path, "day")
    both = refreshed(spark, log, path, "week")
    assert {(r[0], r[1]) for r in both.groupBy("granularity").agg(F.count_distinct("window_start")).collect()} == {("day", 3), ("week", 2)}


def test_only_changed_partitions_are_read(spark, tmp_path, monkeypatch):
    log, path = str(tmp_path / "log"), str(tmp_path / "profile")
    append_log(entries(spark, range(10)), log, batch_id="a")
    refreshed(spark, log, path)
    append_log(entries(spark, [3, 12]), log, batch_id="b")
    read = []
    whole = profiles.profile

    def watched(df, *args, **named):
        read.append(max(partitions_read(df), default=0))
        return whole(df, *args, **named)

    monkeypatch.setattr(profiles, "profile", watched)
    refreshed(spark, log, path)
    assert read == [6]  # day 3 holds two versions of two batches, day 12 two of one: not all 24
    refreshed(spark, log, path)
    assert read[1] == 0


def test_dates_come_from_the_folders(spark, tmp_path):
    log = str(tmp_path / "log")
    assert ledger.partition_dates(spark, log) == [] and ledger.extent_of_dates(spark, log) is None
    append_log(entries(spark, [5, 1, None]), log, batch_id="a")
    assert ledger.partition_dates(spark, log) == [DAY + dt.timedelta(days=1), DAY + dt.timedelta(days=5), None]
    extent = ledger.extent_of_dates(spark, log)
    assert extent == (DAY + dt.timedelta(days=1), DAY + dt.timedelta(days=5))
    drifted = logs.mean_drift(read_log(spark, log), ["x"], dates=extent)
    assert plan(drifted).count("FileScan") == 1 and "Subquery" not in plan(drifted)
    assert rows(drifted) == rows(logs.mean_drift(read_log(spark, log), ["x"]))


def keyed(spark, *rows_):
    return spark.createDataFrame(list(rows_), "k BIGINT, at INT, v STRING")


def test_upsert_keeps_the_newest_and_touches_what_it_must(spark, tmp_path):
    table = str(tmp_path / "t")
    first = upsert(keyed(spark, *[(i, 1, "old") for i in range(100)]), table, ["k"], ["at"], 16)
    assert first == list(range(16))

    def files():
        return {d: sorted(os.listdir(tmp_path / "t" / d)) for d in os.listdir(tmp_path / "t") if d.startswith("key_bucket=")}

    before = files()
    touched = upsert(keyed(spark, (5, 2, "new"), (5, 0, "late"), (6, 0, "late"), (None, 9, "lost"), (200, 1, "x"), (200, 1, "x")), table, ["k"], ["at"], 16)
    after = files()
    changed = {int(d.split("=")[1]) for d in before if before[d] != after[d]}
    assert changed == set(touched) and 0 < len(touched) <= 3
    got = {r.k: (r["at"], r.v) for r in read_keyed(spark, table).collect()}
    assert len(got) == 101 == read_keyed(spark, table).count()
    assert got[5] == (2, "new") and got[6] == (1, "old") and got[200] == (1, "x") and None not in got
    assert upsert(keyed(spark), table, ["k"], ["at"], 16) == [] and files() == after
    with pytest.raises(ValueError, match="not those of the table"):
        upsert(keyed(spark, (1, 1, "x")).drop("v"), table, ["k"], ["at"], 16)


def test_an_upsert_run_again_changes_nothing(spark, tmp_path):
    table, new = str(tmp_path / "t"), keyed(spark, (1, 5, "b"), (2, 1, "a"))
    upsert(keyed(spark, (1, 1, "a"), (3, 1, "a")), table, ["k"], ["at"], 4)
    upsert(new, table, ["k"], ["at"], 4)
    once = rows(read_keyed(spark, table))
    upsert(new, table, ["k"], ["at"], 4)
    assert rows(read_keyed(spark, table)) == once
