"""A corpus pipeline: each stage reads what the one before it kept.

language_id drops documents without letters or in no learned language; line_dedup removes lines that
stand elsewhere already, and documents of which nothing stays; near_dedup keeps one document of each group of
near copies, the smallest doc_id; decontaminate drops documents that hold a benchmark item; byte_bpe encodes
what is left and decodes it again. The first four return the columns of documents.

Null ids and texts, empty tables and further columns have the results that the operators' modules state.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpool.llm import byte_bpe, common, decontaminate, language_id, line_dedup, near_dedup


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from a sample of all labelled documents, language_id.TRAIN_DOCS a language: nothing is held out here."""
    return language_id.keep_known_languages(docs, language_id.learn(docs, F.lit(True)))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs, shortest=line_dedup.EVERY)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language_id", language_stage), ("line_dedup", line_stage), ("near_dedup", near_stage), ("decontaminate", decontaminate_stage), ("byte_bpe", encode_stage)]

#: SQL can't express the learned and the fuzzy stages; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written to the shared folder and read again.

    What a stage wrote on its way, and what it read, is deleted once its result is stored.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    since = common.mark()
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
        common.sweep(since, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
