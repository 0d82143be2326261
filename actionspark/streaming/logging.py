"""Scores of arriving requests in the inference log, and a profile that follows a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from actionspark.config import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from actionspark.operators.logs import inference_log
from actionspark.sources import versions
from actionspark.sources.schemas import FEATURES
from actionspark.sources.tables import append_log, materialize, scratch

Scorer = Callable[[DataFrame], DataFrame]


def decided_once(spark: SparkSession, folder: str, name: str, decide: Callable[[], str]) -> str:
    """What was decided under ``name``: by an earlier attempt if there was one, else now, and kept for later ones."""
    files = versions._Files(spark, folder)
    files.system.mkdirs(files.path(folder))
    path = f"{folder}/{name}"
    if not files.system.exists(files.path(path)):
        files.put(path, decide())  # if another attempt was faster, its word counts
    return files.read(path)


def log_batch(
    rows: DataFrame,
    number: int,
    log: str,
    decisions: str,
    champion: Callable[[], str],
    scorer_of: Callable[[str], Scorer],
    stream: str = "stream",
    columns: Sequence[str] = NUMERIC_FEATURES + CATEGORICAL_FEATURES,
) -> None:
    """Score one micro-batch with the champion of the moment and append it to the log under its number.

    The number names the batch, and the version that scores it is written down before the first row is, so a micro-batch
    that is run again, also after another version was promoted, replaces exactly its own partitions.
    """
    version = decided_once(rows.sparkSession, decisions, f"{number:012d}", champion)
    recs = scorer_of(version)(rows)
    stamps = [F.col("scored_at_ts"), F.col("scored_at_ts")]
    scored = inference_log(recs, rows, *stamps, keys=["customer_id"], columns=columns)
    append_log(scored, log, batch_id=f"{stream}-{number}")


def score_into_log(
    spark: SparkSession,
    source: str,
    log: str,
    checkpoint: str,
    champion: Callable[[], str],
    scorer_of: Callable[[str], Scorer],
    delay: str = "1 day",
    max_files_per_trigger: int | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Score feature files as they land, into the inference log.

    A request is a customer at a time (customer_id, updated_at); one that arrives again within ``delay`` is dropped. State
    is kept for that long only. ``champion`` is asked per micro-batch that has rows. After a crash the last micro-batch is
    run again and replaces itself.
    """
    reader = spark.readStream.schema(FEATURES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    requests = reader.parquet(source).withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    requests = requests.withWatermark("updated_at", delay).dropDuplicatesWithinWatermark(["customer_id", "updated_at"])
    requests = requests.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))

    def each(rows: DataFrame, number: int) -> None:
        with scratch(spark):
            rows = materialize(rows, "requests")  # scored and logged from here, so the state is gone through once
            if not rows.isEmpty():
                log_batch(rows, number, log, f"{checkpoint}/decisions", champion, scorer_of)

    writer = requests.writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoint}/state")
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def follow_counts(
    rows: DataFrame, ts: str, value: str, table: str, checkpoint: str, delay: str, once: bool = True
) -> StreamingQuery:
    """Keep a daily profile of ``value`` up to date with a stream: per day n_rows, n, total, min and max.

    Days are held in the state store until the watermark, ``delay`` behind the newest row, has passed them. Each micro-batch
    writes the days it changed (update mode) as a partition of its own number; ``followed`` takes the newest of each
    day. Rows behind the watermark are not counted; Spark's query progress tells their number.
    """
    seen = rows.withColumn("at", F.col(ts).cast("timestamp")).withWatermark("at", delay)
    figures = seen.groupBy(F.window("at", "1 day").alias("day")).agg(
        F.count("*").alias("n_rows"),
        F.count(value).alias("n"),
        F.sum(F.round(F.col(value) * 100).cast("long")).alias("cents"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    figures = figures.select(F.to_date(F.col("day.start").cast("timestamp_ntz")).alias("window_start"), *figures.columns[1:])

    def each(changed: DataFrame, number: int) -> None:
        append_log(changed.withColumn("batch", F.lit(number)), table, partition_by=["batch"])

    writer = figures.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def followed(spark: SparkSession, table: str) -> DataFrame:
    """The profile that ``follow_counts`` keeps: of each day what the last micro-batch that touched it wrote."""
    written = spark.read.parquet(table)
    columns = [c for c in written.columns if c not in ("batch", "window_start")]
    newest = written.groupBy("window_start").agg(F.max_by(F.struct(*columns), "batch").alias("row"))
    return newest.select("window_start", "row.*")
