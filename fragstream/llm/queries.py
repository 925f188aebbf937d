"""The registered queries of the corpus operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, langid, mixing, quality, rollup, secret_scan, sharding, topk, toxicity
from .minhash import near_duplicate_classes


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(_t(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.token_counts(_t(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_of(_t(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(_t(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_of(_t(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(_t(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_t(spark, sf_dir, "embeddings"), "id % 50 = 0")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    all_ = (op1_minhash, op2_token_counts, op3_mixing, op4_quality, op5_language, op6_sharding, op7_secrets, op8_decontaminate, op9_toxicity, op10_top_k)
    return {f.__name__: f for f in all_}


def oracle_sql() -> dict[str, str]:
    """Ops 1, 4, 5, 6 and 9 hash, learn or write files, which SQL can't express; tests/llm holds them against brute force, held-out rows and round trips."""
    return {
        "op2_token_counts": rollup.ORACLE_SQL,
        "op3_mixing": mixing.ORACLE_SQL,
        "op7_secrets": secret_scan.ORACLE_SQL,
        "op8_decontaminate": decontaminate.ORACLE_SQL,
        "op10_top_k": topk.ORACLE_SQL,
    }
