"""Corpus preparation: quality rules, near-duplicates, benchmark leaks, source
mixing, shards. Each stage takes all that its predecessor kept."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from shoal.llm.common import shared_path
from shoal.llm.decontaminate import drop_leaks
from shoal.llm.mixing import mix_documents
from shoal.llm.quality_rules import filter_documents
from shoal.llm.sharding import shard_table
from shoal.llm.simhash import drop_near_duplicates


def release(spark: SparkSession) -> None:
    """Between stages: drops what the driver still holds of the last one (frames, models, broadcasts),
    so that Spark's cleaner removes its shuffles, broadcasts and checkpoints, which are tied to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of light sources come twice at most; none is left out."""
    release(spark)
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return shard_table(docs)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

#: Fingerprints and latent vectors are beyond SQL; tests compare the stages
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the
    shared checkpoint folder and read again by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = shared_path(spark, f"corpus-{uuid.uuid4().hex}")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{base}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
