"""Corpus pipeline: quality rules, near duplicates, repeated passages,
benchmark leaks, tokens.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from recsmith.llm import bpe, decontaminate, ngram_join, quality_rules, substring_dedup
from recsmith.llm.common import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep (operator 4)."""
    return quality_rules.quality_filter(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 5)."""
    return ngram_join.drop_near_duplicates(docs)


def repeated_passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier in the corpus go; a document of which
    nothing stays goes (operator 9)."""
    return substring_dedup.dedup_filter(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a test item go (operator 7)."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids and the digests of ids and decoded text
    (operator 6)."""
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), docs.columns)


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("substring_dedup", repeated_passages_stage),
    ("decontamination", decontamination_stage),
    ("bpe_encoding", encoding_stage),
]

#: The last stage encodes texts with a tokenizer, which SQL cannot express;
#: tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the `documents` table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
