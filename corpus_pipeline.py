"""The training-data pipeline: documents through five stages, in order.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as
Parquet and read again as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from courtline.llm import decontaminate, near_dup, packing, quality, secrets
from courtline.session import delete_path, scratch_path, scratch_scope
from courtline.sources.tables import table_path

VOCABULARY = "byte_bpe_50k.tiktoken"

#: Near copies from this Jaccard similarity (in percent) on are one group.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return near_dup.keep_one(docs, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(table_path(sf_dir, "benchmark")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the secrets in its text masked."""
    return secrets.redact_secrets(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: MinHash, LSH and tokenizers are beyond SQL; tests compare the stages with
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows.  Once a stage is written, what
    it used on the way goes, and the copy of the stage before it."""
    docs, before = spark.read.parquet(table_path(sf_dir, "documents")), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
