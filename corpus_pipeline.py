"""The training-data pipeline: each stage reads what the one before it kept and writes Parquet."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontamination, jaccard, mixing, quality, sharding
from strata.llm.queries import importable
from strata.session import scratch_folder


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep (operator 5)."""
    return quality.good_documents(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (operator 4)."""
    return jaccard.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item (operator 1)."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, once or twice (operator 7)."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in a uniformly random order, in shards of equal size (operator 10)."""
    return sharding.shuffle_into_shards(docs)


STAGES = [
    ("quality", good),
    ("near duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: The first stage is learned and the mix is drawn: SQL can't express them.
ORACLE_SQL = None


@importable
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every result is written to the scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_folder(spark)}/pipeline-{uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name.replace(' ', '-')}")
        docs = spark.read.parquet(f"{folder}/{name.replace(' ', '-')}")
    return docs
