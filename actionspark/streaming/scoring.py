"""Scoring of feature rows as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from actionspark.sources.schemas import FEATURES


def score_stream(
    spark: SparkSession,
    source_dir: str,
    sink_dir: str,
    checkpoint: str,
    scorer: Callable[[DataFrame], DataFrame],
    max_files_per_trigger: int | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Read feature files, score them with the batch scorer, append to Parquet.

    Scoring keeps no state, so there is no watermark and nothing to shuffle; file source, checkpoint and
    file sink together deliver every row exactly once, also after a restart. ``once`` works off what is
    there and stops; otherwise the query keeps running.
    """
    reader = spark.readStream.schema(FEATURES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = scorer(reader.parquet(source_dir))
    writer = scored.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(sink_dir)
