"""Corpus pipeline: quality, language, near-duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftline.llm import contamination, language, packing, quality, simhash
from driftline.llm.common import table, tokenizer_path, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents without a letter or in no language with a clear share go."""
    return language.keep_known(docs)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each group of near-duplicates stays."""
    return simhash.keep_one(docs, shingle=4, bits=4)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a benchmark item go."""
    return contamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the documents' tokens in sequences of at most 2048."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), 2048, specials=True)


STAGES = [("quality", keep_quality), ("language", keep_language), ("near_duplicates", keep_distinct),
          ("decontamination", keep_clean), ("packing", pack)]

ORACLE_SQL = None  # the classifiers cannot be written in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
