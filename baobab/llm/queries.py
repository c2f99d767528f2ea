"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from baobab.llm import (decontaminate, hard_negatives, license_scan, merkle, mixing, multiset_hash, preferences,
                        quality_classifier, quality_rules, secret_scan, sharding, simhash, substring_dedup)
from baobab.llm.oracle import ORACLE

SHARDS = [f"shard-{i:03d}" for i in range(64)]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_table(spark, sf_dir, "documents"), SHARDS).select("doc_id", "shard")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(_table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(_table(spark, sf_dir, "documents"))


def op9_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.digest(_table(spark, sf_dir, "conversations"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.digest(_table(spark, sf_dir, "embeddings"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.digest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_license_scan, op2_sharding, op3_decontaminate, op4_secret_scan, op5_substring_dedup,
                            op6_simhash, op7_mixing, op8_quality_rules, op9_preferences, op10_quality_classifier,
                            op11_merkle_manifest, op12_hard_negatives, op13_fingerprints)}

__all__ = ["ORACLE", "QUERIES"]
