"""The micro-batches of ``stream_into_log`` are not written by one task each."""

from pathlib import Path

from actionspark.plans.catalogue import QUERIES
from actionspark.sources.tables import shared_dir


def test_requests_of_a_micro_batch_are_written_by_several_tasks(spark, sf):
    root = Path(shared_dir(spark).removeprefix("file:"))
    before = set(root.glob("actionspark-*/requests"))
    QUERIES["stream_into_log"](spark, sf).collect()
    (source,) = set(root.glob("actionspark-*/requests")) - before
    assert len(list(source.glob("*.parquet"))) > 4
