"""Training corpus from ``documents``: five stages, each written and read again.

A stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
frame: the columns of ``documents``, and after the last stage its shard as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from baobab.llm import decontaminate, mixing, quality_rules, sharding, simhash
from baobab.llm.queries import SHARDS
from baobab.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.drop_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    return sharding.place(docs, SHARDS)


STAGES = [("quality rules", quality), ("simhash near-dedup", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixture), ("sharding", shards)]

# Fingerprints (XXH64) and the components' transitive closure are beyond DuckDB's SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline_" + name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
