"""Registered queries of the corpus operators, one per operator, each over its
whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.llm.simhash import simhash_groups
    return simhash_groups(_table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.llm.suffix_dedup import repeats
    return repeats(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.llm.quality_rules import quality_rules
    return quality_rules(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.llm.mixing import mix_plan
    return mix_plan(_table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.llm.sharding import shard_table
    return shard_table(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.llm.decontaminate import leaks
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.llm.url_filter import judge_pages, query_heavy_hosts
    pages = _table(spark, sf_dir, "pages")
    return judge_pages(pages, query_heavy_hosts(pages))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.llm.quality_gam import quality_scores
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.llm.licenses import licences
    return licences(_table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.llm.html_extract import extract
    return extract(_table(spark, sf_dir, "pages"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.llm.line_dedup import line_report
    return line_report(_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.llm.spelling import spelling_variants
    return spelling_variants(_table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.llm.importance import importance_ranks
    return importance_ranks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_simhash, op2_suffix_dedup, op3_quality_rules, op4_mixing, op5_url_filters, op6_sharding, op7_decontamination,
        op8_quality_classifier, op9_licenses, op10_html_extraction, op11_line_dedup, op12_spelling_variants,
        op13_importance_resampling)}
