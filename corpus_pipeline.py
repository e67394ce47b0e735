"""From raw documents to packed sequences: language, quality, near copies, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm.jaccard_join import one_per_group
from quayside.llm.language import fourth_of_ids, keep_languages
from quayside.llm.packing import pack
from quayside.llm.quality_model import keep_quality, third_of_ids
from quayside.llm.registry import table
from quayside.session import durable


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that the labelled ones teach."""
    return keep_languages(docs, fourth_of_ids())


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, taught by the labels, holds good."""
    return keep_quality(docs, table(spark, sf_dir, "labels"), third_of_ids())


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: sets of 5-word shingles that are 80 % alike."""
    return one_per_group(docs, width=5, percent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents and their places in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("quality", quality),
    ("near_copies", near_copies),
    ("packing", packing),
]

# Trained models and tokenizers are no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each on the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
