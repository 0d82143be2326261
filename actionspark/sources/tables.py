"""Table lifecycle on Parquet: scan, overwrite, append by partition, snapshots, shared scratch space."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actionspark.sources import versions
from actionspark.sources.schemas import WAREHOUSE, SchemaMismatch, conform

LOG_PARTITIONS = ("log_date", "model_version", "batch_id")
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def warehouse_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One table of the warehouse. The declared schema is applied, so no file is opened to infer it."""
    return spark.read.schema(WAREHOUSE[name]).parquet(f"{directory}/{name}.parquet")


def _is_path(table: str) -> bool:
    return "/" in table


def _scan(spark: SparkSession, table: str) -> DataFrame:
    if not _is_path(table):
        return spark.table(table)
    return versions.read_version(spark, table) if versions.is_versioned(spark, table) else spark.read.parquet(table)


def read_table(spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a stored table, given as a path or as a catalog name; with ``schema`` the stored columns and
    types are checked against it."""
    df = _scan(spark, table)
    return df if schema is None else conform(df, schema)


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether a catalog table, or a directory that holds a readable Parquet table, is there."""
    if not _is_path(table):
        return spark.catalog.tableExists(table)
    if versions.is_versioned(spark, table):
        return True
    try:
        spark.read.parquet(table).schema
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return False
        raise
    return True


def overwrite_table(
    df: DataFrame,
    table: str,
    partition_by: Iterable[str] = (),
    bucket_by: tuple[int, str] | None = None,
    keep: int | None = None,
) -> None:
    """Replace rows and schema of a path or a catalog table, which the input may be read from.

    All files are written aside before anything of the old table is touched, so a write that fails leaves the old rows.
    With ``keep`` a path becomes a versioned table (see ``versions``) that keeps so many versions, and one that is versioned
    stays so; a reader then sees the old or the new rows at any moment. Without, the two folders, or the
    two catalog names, are exchanged at the end.

    ``bucket_by`` (number, key) stores a catalog table hashed and sorted by its key; tables bucketed
    alike are then joined on it without a shuffle, such as recommendations with features every day.
    """
    if bucket_by and _is_path(table):
        raise ValueError("buckets are recorded in the catalog: give a table name, not a path")
    if bucket_by:
        df = df.repartition(*bucket_by)  # a task per bucket, or every task writes a file for each of them
    spark, partition_by = df.sparkSession, list(partition_by)
    if _is_path(table) and (keep or versions.is_versioned(spark, table)):
        versions.write_version(df, table, partition_by, keep or versions.KEEP)
        return
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        buckets, key = bucket_by
        writer = writer.bucketBy(buckets, key).sortBy(key)
    if _is_path(table):
        _replace_folder(spark, writer, table.rstrip("/"))
    else:
        _replace_catalogued(spark, writer.format("parquet"), table)


def _replace_folder(spark: SparkSession, writer: DataFrameWriter, path: str) -> None:
    """Write next to ``path``, then exchange the two folders by renaming. If the process dies between the two renames, the old
    rows are in the hidden folder ``.<name>.old`` and the next overwrite puts them back first."""
    parent, _, name = path.rpartition("/")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    new, old, here = (hadoop.Path(p) for p in (f"{parent}/.{name}.{uuid.uuid4().hex}", f"{parent}/.{name}.old", path))
    files = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(old):
        if files.exists(here):
            files.delete(old, True)
        else:
            files.rename(old, here)
    try:
        writer.parquet(new.toString())
    except Exception:
        files.delete(new, True)
        raise
    if files.exists(here) and not files.rename(here, old):
        raise OSError(f"{path} cannot be moved aside")
    if not files.rename(new, here):
        files.rename(old, here)
        raise OSError(f"{path} cannot be replaced")
    files.delete(old, True)
    spark.catalog.refreshByPath(path)


def _replace_catalogued(spark: SparkSession, writer: DataFrameWriter, table: str) -> None:
    """Write a table of another name, then exchange the names."""
    new, old = (f"{table}__{kind}_{uuid.uuid4().hex}" for kind in ("new", "old"))
    try:
        writer.saveAsTable(new)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    replaced = spark.catalog.tableExists(table)
    if replaced:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except Exception:
        if replaced:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    if replaced:
        spark.sql(f"DROP TABLE {old}")


def append_log(
    df: DataFrame, path: str, partition_by: Iterable[str] = LOG_PARTITIONS, batch_id: str | None = None
) -> None:
    """Append by replacing exactly the partitions present in ``df``: a rerun leaves one copy.

    ``batch_id``, stored as a column, tells a rerun from a further batch: a batch written again replaces itself,
    another batch of the same day and version stays next to it. The rebalance hint lets the adaptive planner
    size the files: it merges small partitions and splits a large one, where a plain repartition by the
    date would send a whole day to one task.
    """
    partition_by = list(partition_by)
    if batch_id is not None:
        df = df.withColumn("batch_id", F.lit(str(batch_id)))
    missing = [c for c in partition_by if c not in df.columns]
    if missing:
        raise SchemaMismatch(f"log rows lack partition columns {missing}")
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def read_log(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The log with all columns any append brought; older rows hold NULL in newer columns.

    Without ``schema`` the columns are merged from the footers of all files; a reader that knows what it
    needs passes it and opens none. Partition values are read as stored: version and batch are text even if they
    look like numbers.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    merged = spark.read.option("mergeSchema", "true").parquet(path)
    wanted = {"log_date": T.DateType(), "model_version": T.StringType(), "batch_id": T.StringType()}
    fields = [
        T.StructField(f.name, wanted.get(f.name, f.dataType), True) for f in merged.schema.fields
    ]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def baseline_full(df: DataFrame, table: str) -> DataFrame:
    """Store all rows as the baseline of later drift checks."""
    overwrite_table(df, table)
    return _scan(df.sparkSession, table)


def baseline_version(spark: SparkSession, table: str, name: str = "baseline") -> DataFrame:
    """The newest version of a versioned table, pinned as the baseline of later drift checks: no row is copied."""
    versions.pin(spark, table, name)
    return versions.read_pinned(spark, table, name)


def baseline_sample(df: DataFrame, key: str, rows: int = 1000) -> DataFrame:
    """At most ``rows`` rows in the order of md5(key): a sample that does not change between runs.

    Counts per 16-bit hash prefix first show up to which prefix the sample can reach, so a task hands on
    only rows below it, not ``rows`` candidates each. A NULL key comes last.
    """
    digest = F.md5(F.col(key).cast("string"))
    prefix = F.coalesce(F.conv(F.substring(digest, 1, 4), 16, 10).cast("int"), F.lit(1 << 16))
    counts = df.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(F.lit(1)).orderBy("prefix"))  # at most 65,537 rows
    reach = counts.withColumn("upto", upto).filter(F.col("upto") >= rows).agg(F.min("prefix")).scalar()
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c != key]
    return (
        df.filter(prefix <= F.coalesce(reach, F.lit(1 << 16)))
        .orderBy(digest.asc_nulls_last(), F.col(key).asc_nulls_last(), *rest)
        .limit(rows)
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, which all executors reach: the one ``spark.checkpoint.dir`` names, the
    same on every master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder on shared storage")
    return named.rstrip("/")


_OPEN: list[list[str]] = []  # folders made in the scratch blocks that are open, the innermost last


def scratch_path(spark: SparkSession, name: str) -> str:
    folder = f"{shared_dir(spark)}/actionspark-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(folder)
    return f"{folder}/{name}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables made inside the block when it ends; what it returned must be stored or read.

    Tables made outside of any block belong to lazy results and stay until the folder's owner clears it.
    """
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.remove(made)
        for folder in made:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage through a table in the shared folder.

    Iterative jobs read their input many times; from here each pass scans only the columns it needs,
    and a lost executor costs a re-read, not a recomputation of the joins upstream.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
