"""The operators over their whole tables, as the queries that the driver contract names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import (
    decontamination, fingerprints, jaccard, language, minhash, packing, quality, scoring, secrets, spelling, substrings, toxicity,
    whitening,
)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(_documents(spark, folder))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontamination.contaminated(_documents(spark, folder), benchmark)


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(_documents(spark, folder))


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.linked(_documents(spark, folder))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(_documents(spark, folder), _labels(spark, folder))


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_spans(spark, _documents(spark, folder))


def op7_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.scores(_documents(spark, folder))


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(_documents(spark, folder))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(_documents(spark, folder), _labels(spark, folder))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.deduplicated(_documents(spark, folder))


def op11_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, folder), width=4, percent=80)


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_documents(spark, folder))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_decontamination, op3_packing, op4_jaccard_join, op5_toxicity, op6_secret_scan, op7_lm_score, op8_fingerprints,
    op9_quality_classifier, op10_substring_dedup, op11_minhash_dedup, op12_embedding_whitening, op13_spelling_variants)}
ORACLE: dict[str, str] = {}
