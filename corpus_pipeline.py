"""Corpus pipeline: quality, near duplicates, benchmark overlap, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all rows it gets, and returns a DataFrame that is written and reread
as the input of the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.llm import decontamination, jaccard, packing, quality, secrets
from starmart.llm.tables import Stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.with_score(docs, model, into="quality_of_stage")
    return scored.where(F.col("quality_of_stage") >= quality.CUT).select(*docs.columns)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8 or more)."""
    return jaccard.first_of_groups(docs)


def keep_clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a marker in place of each secret."""
    return secrets.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 4096 tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("ngram_jaccard_join", keep_one_of_group),
    ("benchmark_decontamination", keep_clean_of_benchmark),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]
#: Models and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    stored = Stored(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if k == len(STAGES) - 1 else stored.keep(out, name)
    return docs
