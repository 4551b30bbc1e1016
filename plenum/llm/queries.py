"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import compression_quality, embedding_dedup, media, mixing, ngram_join, packing, secrets, substring_dedup, token_counts, toxicity
from .common import table


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op4_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near(table(spark, sf_dir, "embeddings"))


def op10_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries():
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": ngram_join.sql(),
        "op2_substring_dedup": substring_dedup.sql(),
        "op4_pareto_mixing": mixing.sql(),
        "op7_secret_scans": secrets.sql(),
        "op9_embedding_dedup": embedding_dedup.sql(),
    }
