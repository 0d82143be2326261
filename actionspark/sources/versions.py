"""Versioned tables: a write becomes visible by one small commit file, or not at all.

A table is a folder. Each write goes to a folder of its own below ``_versions``; when all its files are there, a commit
file with the next number is put into ``_commits``, which names that folder and the schema. Readers take the highest
number. A write that fails half-way has no commit, so the rows before it stay the table. Old versions are kept by
count, pinned ones until they are unpinned; a pin is a file that holds a number and copies no row.

The file system must create a file by renaming it without replacing another, as HDFS and local disks do. Commits and pins
are a handful of small files per table, which the driver lists; rows are read and written by the tasks only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

KEEP = 3
RETRIES = 20


class NoSuchVersion(LookupError):
    """The table has no version, or not the one asked for."""


class ConcurrentCommit(RuntimeError):
    """Another writer committed every number this one tried."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    schema: StructType


class _Files:
    """The few calls to Hadoop's file system that commits need."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.system = self.path(path).getFileSystem(self.conf)

    def path(self, path: str):
        return self.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        if not self.system.exists(self.path(folder)):
            return []
        return sorted(s.getPath().getName() for s in self.system.listStatus(self.path(folder)))

    def read(self, path: str) -> str:
        stream = self.system.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def put(self, path: str, text: str, replace: bool = False) -> bool:
        """Write a file under another name and rename it; False if ``path`` is there already."""
        fs = self.hadoop.fs
        aside = self.path(f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        stream = self.system.create(aside, False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        rename = self.gateway.new_array(fs.Options.Rename, 1)
        rename[0] = fs.Options.Rename.OVERWRITE if replace else fs.Options.Rename.NONE
        context = fs.FileContext.getFileContext(aside.getFileSystem(self.conf).getUri(), self.conf)
        qualified = self.system.makeQualified
        try:
            context.rename(qualified(aside), qualified(self.path(path)), rename)
        except Py4JJavaError as e:
            self.system.delete(aside, False)
            if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        self.system.delete(self.path(path), True)


def _commit_number(name: str) -> int | None:
    stem = name.removesuffix(".json")
    return int(stem) if stem.isdigit() else None


def version_numbers(spark: SparkSession, table: str) -> list[int]:
    """The versions of a table that can be read, oldest first; none for a folder that is not such a table."""
    names = _Files(spark, table).names(f"{table}/_commits")
    return sorted(n for n in map(_commit_number, names) if n is not None)


def version(spark: SparkSession, table: str, number: int | None = None) -> Version:
    """A version of the table, the newest by default."""
    if number is None:
        numbers = version_numbers(spark, table)
        if not numbers:
            raise NoSuchVersion(f"{table} has no version")
        number = numbers[-1]
    files = _Files(spark, table)
    path = f"{table}/_commits/{number:012d}.json"
    if not files.system.exists(files.path(path)):
        raise NoSuchVersion(f"{table} has no version {number}")
    said = json.loads(files.read(path))
    return Version(number, f"{table}/_versions/{said['folder']}", StructType.fromJson(said["schema"]))


def is_versioned(spark: SparkSession, table: str) -> bool:
    return bool(version_numbers(spark, table))


def read_version(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """The rows of a version, the newest by default. The schema comes from the commit, so no file is opened for it."""
    found = version(spark, table, number)
    return spark.read.schema(found.schema).parquet(found.folder)


def write_version(df: DataFrame, table: str, partition_by: Iterable[str] = (), keep: int = KEEP) -> int:
    """Store ``df``, rows and schema, as the next version; returns its number.

    The rows may be read from the table itself. Of two writers at a time both commit, one after the other. Versions beyond
    the newest ``keep`` go unless pinned: who reads an older one should pin it.
    """
    if keep < 1:
        raise ValueError("the newest version is always kept")
    spark = df.sparkSession
    files = _Files(spark, table)
    name = uuid.uuid4().hex
    folder = f"{table}/_versions/{name}"
    partition_by = list(partition_by)
    try:
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(folder)
    except Exception:
        files.delete(folder)
        raise
    said = json.dumps({"folder": name, "schema": json.loads(df.schema.json())})
    files.system.mkdirs(files.path(f"{table}/_commits"))
    for _ in range(RETRIES):
        number = max(version_numbers(spark, table), default=0) + 1
        if files.put(f"{table}/_commits/{number:012d}.json", said):
            _forget(spark, table, keep)
            return number
    files.delete(folder)
    raise ConcurrentCommit(f"{table}: {RETRIES} numbers were taken by other writers")


def _forget(spark: SparkSession, table: str, keep: int) -> None:
    """Remove the versions beyond the newest ``keep`` that no pin names: first the commit, then the rows."""
    files = _Files(spark, table)
    held = set(pins(spark, table).values())
    for number in version_numbers(spark, table)[:-keep]:
        if number not in held:
            old = version(spark, table, number)
            files.delete(f"{table}/_commits/{number:012d}.json")
            files.delete(old.folder)


def pins(spark: SparkSession, table: str) -> dict[str, int]:
    """The pinned versions by the names of their pins."""
    files = _Files(spark, table)
    names = [n for n in files.names(f"{table}/_pins") if not n.startswith(".")]
    return {n: int(files.read(f"{table}/_pins/{n}")) for n in names}


def pin(spark: SparkSession, table: str, name: str, number: int | None = None) -> int:
    """Keep a version, the newest by default, under ``name``, which moves if it was given before. Nothing is copied."""
    number = version(spark, table, number).number
    files = _Files(spark, table)
    files.system.mkdirs(files.path(f"{table}/_pins"))
    files.put(f"{table}/_pins/{name}", str(number), replace=True)
    return number


def unpin(spark: SparkSession, table: str, name: str) -> None:
    """Give up a pin; its version goes with the next write if it is beyond those kept."""
    _Files(spark, table).delete(f"{table}/_pins/{name}")


def read_pinned(spark: SparkSession, table: str, name: str) -> DataFrame:
    """The rows of the version that ``name`` holds."""
    held = pins(spark, table)
    if name not in held:
        raise NoSuchVersion(f"{table} has no pin {name}")
    return read_version(spark, table, held[name])
