"""A corpus made ready for training: quality, near-duplicates, contamination, mixture, shards.

Each stage reads what the one before has written and works on all of it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fragstream.llm import common, decontaminate, minhash, mixing, quality, sharding


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.scored(docs, model, score_col="__quality")
    return scored.where(F.col("__quality") >= quality.KEEP).drop("__quality")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest id, of each group of near-duplicates; a null id comes last, and rows that repeat an id are rows like others."""
    # rows are named by a number of this stage's own, written once so that it stays
    rows = common.checkpoint(docs.withColumn("__row", F.monotonically_increasing_id()))
    found = minhash.near_duplicate_classes(rows, id_col="__row").select("__row", "component_id")
    ranked = found.join(rows.select("__row", "doc_id"), "__row").withColumn("__rank", F.struct(F.col("doc_id").isNull(), "doc_id", "__row"))
    first = ranked.groupBy("component_id").agg(F.min("__rank").alias("__rank")).select(F.col("__rank")["__row"].alias("__row"))
    gone = common.checkpoint(found.select("__row").join(first, "__row", "left_anti"))
    return rows.join(common.sent(gone), "__row", "left_anti").select(*(f"`{c}`" for c in docs.columns))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as the shards of a new store hold them, with the number and the bytes of their shard."""
    return sharding.shard(docs, f"{common.shared_dir(spark)}/corpus-{uuid.uuid4().hex}").numbered()


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good),
    ("minhash near-dedup", distinct),
    ("benchmark decontamination", clean),
    ("mixing sources", mixed),
    ("sharding", sharded),
]

#: The stages learn models and hash texts, which SQL can't express; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each stage's result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        path = f"{common.shared_dir(spark)}/stage-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            common.delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
