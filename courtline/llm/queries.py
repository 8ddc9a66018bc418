"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.llm import (decontaminate, fim, language, licenses, near_dup, packing, quality, secrets,
                           sharding, suffix_tree, toxicity, warc, whitening)
from courtline.llm.common import crc_mod
from courtline.llm.oracles import ORACLES
from courtline.session import scratch_path
from courtline.sources.tables import table_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    third = crc_mod(F.col("doc_id"), 3)
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), usable=third != 1)
    return toxicity.score_documents(docs, model, held_out=third == 1)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"),
                                    read(spark, sf_dir, "benchmark")).drop("uid")


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(read(spark, sf_dir, "documents"),
                                       held_out=crc_mod(F.col("doc_id"), 7) == 2)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archives(read(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.page_rows(warc.assemble(warc.read_archives(spark, path, with_payload=False)))


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents")).select(
        "doc_id", F.col("bytes").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents")).drop("detections")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = fim.transform_documents(read(spark, sf_dir, "documents"))
    return fim.restore_documents(outputs).drop("text")


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    fifth = crc_mod(F.col("doc_id"), 5)
    return language.predict_documents(docs, language.train(docs, usable=fifth != 0), held_out=fifth == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(read(spark, sf_dir, "embeddings"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_toxicity": op2_toxicity,
    "op3_decontaminate": op3_decontaminate,
    "op4_lm": op4_lm,
    "op5_secrets": op5_secrets,
    "op6_warc": op6_warc,
    "op7_near_dup": op7_near_dup,
    "op8_sharding": op8_sharding,
    "op9_quality": op9_quality,
    "op10_licenses": op10_licenses,
    "op11_fim": op11_fim,
    "op12_language": op12_language,
    "op13_whitening": op13_whitening,
}


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(REGISTRY)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
