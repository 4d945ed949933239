"""Corpus pipeline: quality, near-duplicates, repeated strings, benchmark leaks, source mix.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before kept; its
result is written and read again as the next one's documents. All but the last return the
columns of ``documents``; the last returns the words that the mix takes of each document.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lendlake.llm import decontaminate, minhash_dedup, mixing, quality, suffix_dedup  # noqa: E402
from lendlake.llm.common import read, staged  # noqa: E402


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, 0.8)."""
    return minhash_dedup.drop_near_duplicates(docs)


def repeated_string_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words and strings of 400 bytes that occur more than once are cut out."""
    return suffix_dedup.remove_repeats(docs, words=suffix_dedup.PASSAGE_WORDS)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out."""
    return decontaminate.remove_leaks(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words taken of each document for a mix of sources by weight."""
    return mixing.mix_sources(docs).taken()


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicate_filter),
    ("repeated_strings", repeated_string_filter),
    ("benchmark_leaks", benchmark_filter),
    ("source_mix", source_mix),
]

#: The classifier and the permutations of the mix can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
