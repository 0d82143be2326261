"""The corpus pipeline: documents through quality rules, near-duplicate removal, decontamination, mixing, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actionspark.llm.common import stored, table
from actionspark.llm.decontaminate import decontaminate
from actionspark.llm.mixing import mix, repeated
from actionspark.llm.near import near_duplicates, one_of_each
from actionspark.llm.quality import quality
from actionspark.llm.sharding import shard


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others stay as they are."""
    return quality(docs).filter("kept").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    return one_of_each(near_duplicates(docs)).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go; the others stay as they are."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(~F.col("contaminated")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return repeated(mix(docs)).select(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in shuffled shards: shard and slot follow the columns of documents."""
    return shard(docs)


STAGES = [
    ("quality", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# Near-duplicate groups and shuffled slots cannot be stated in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, over all documents; each stage's result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
