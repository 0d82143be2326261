"""What a stored result was made of: the files of a partitioned table, and the partitions whose files changed since.

Files are told by path, size and time of modification, as the file system lists them; none is opened for it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actionspark.sources.tables import scratch_path

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of rows whose partition value is NULL
LISTING_BYTES = 1 << 50


def _value(name: str) -> str | None:
    return None if name == NO_VALUE else name


def partition_dates(spark: SparkSession, table: str, column: str = "log_date") -> list[dt.date | None]:
    """The dates a table is partitioned by at its first level, oldest first, a NULL date last: from the folders' names.

    One listing of one folder on the driver; its size follows the time span, not the rows or the files.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
    values = [_value(n.removeprefix(f"{column}=")) for n in names if n.startswith(f"{column}=")]
    return sorted((v if v is None else dt.date.fromisoformat(v) for v in values), key=lambda v: (v is None, v))


def extent_of_dates(spark: SparkSession, table: str, column: str = "log_date") -> tuple[dt.date, dt.date] | None:
    """First and last date of a partitioned table; None if it has none."""
    known = [d for d in partition_dates(spark, table, column) if d is not None]
    return (known[0], known[-1]) if known else None


def on_dates(column: str, dates: list[dt.date | None]) -> Column:
    """Rows of the given dates: a list of literals, which prunes partitions."""
    known = [d for d in dates if d is not None]
    wanted = F.col(column).isin(known) if known else F.lit(False)
    return wanted | F.col(column).isNull() if None in dates else wanted


def drop_partitions(spark: SparkSession, table: str, dates: list[dt.date | None], column: str = "log_date") -> None:
    """Remove whole dates from a table, as retention does."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for day in dates:
        path = fs.Path(f"{table}/{column}={NO_VALUE if day is None else day.isoformat()}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def files_of(spark: SparkSession, table: str, column: str = "log_date") -> DataFrame:
    """(part, file, size, modified) of each Parquet file of a table, with the date of its partition, stored.

    The listing is dealt over the cores whatever the files weigh, since no content is read.
    """
    own = spark.newSession()  # a setting of this listing alone
    own.conf.set("spark.sql.files.maxPartitionBytes", str(LISTING_BYTES))
    listed = own.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    named = F.regexp_extract("path", f"/{column}=([^/]*)/", 1)
    rows = listed.load(table).select(
        F.when(named != NO_VALUE, named).cast("date").alias("part"),
        F.regexp_extract("path", f"/({column}=.*)$", 1).alias("file"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )
    path = scratch_path(spark, "files")
    rows.write.parquet(path)
    return spark.read.schema("part date, file string, size long, modified timestamp").parquet(path)


def changed_dates(known: DataFrame, now: DataFrame) -> DataFrame:
    """(part) of partitions that gained, lost or replaced a file between two listings."""
    keys = ("part", "file", "size", "modified")

    def missing(one: DataFrame, other: DataFrame) -> DataFrame:
        renamed = other.toDF(*(f"o_{k}" for k in keys))
        same = [F.col(k).eqNullSafe(F.col(f"o_{k}")) for k in keys]
        return one.select(*keys).join(renamed, same, "left_anti").select("part")

    return missing(now, known).unionAll(missing(known, now)).distinct()
