"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing and sharding of documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from assayspark.llm import decontam, mixing, quality, sharding, simhash
from assayspark.session import scratch_path, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark contaminates go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix, as often as it takes them."""
    return mixing.mixed_docs(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard of eight, and of nine."""
    return sharding.assign_shards(sharding.assign_shards(docs, ["doc_id"], 8), ["doc_id"], 9, "grown_shard")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_sources),
    ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs


#: Near-duplicate groups and quantile limits are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None
