"""The queries of the training-data operators over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evidentia.llm import byte_bpe, katz, language_id, license_scan, media_store, near_dedup, packing, quality_rules, secret_scan, toxicity
from evidentia.llm.arrow import documents


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.query(documents(spark, sf_dir))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.query(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.query(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.query(documents(spark, sf_dir))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.query(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_media_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_store.query(documents(spark, sf_dir))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.query(documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.query(documents(spark, sf_dir))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.query(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_katz, op2_near_dedup, op3_language_id, op4_quality_rules, op5_license_scan, op6_toxicity, op7_media_store, op8_byte_bpe, op9_packing, op10_secret_scan)}


def oracle_sql() -> dict[str, str]:
    return {"op2_near_dedup": near_dedup.ORACLE, "op4_quality_rules": quality_rules.ORACLE}
