"""Corpus pipeline: quality, language, near-duplicates, packing."""

from __future__ import annotations

import sys
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from narrakin.llm import langid, packing, quality, simhash  # noqa: E402
from narrakin.llm.tables import table  # noqa: E402
from narrakin.session import settle  # noqa: E402


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(spark, docs, table(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in one language by at least half."""
    return langid.keep_identified(spark, docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.one_of_each_group(spark, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the remaining documents in training sequences."""
    return packing.pack(spark, docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", without_near_duplicates),
    ("packing", packed),
]

#: The stages fit models and hash shingles, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
