"""From documents to packed training sequences: quality, language, near-duplicates, secrets, packing.

Every stage works on what its predecessor kept, written as Parquet and read again, and all but the last keep the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from verdure.llm import jaccard, language, packing, quality, secrets
from verdure.llm.common import bounded_batches, table
from verdure.llm.queries import WORD_BPE, WORD_END, tokenizer_path
from verdure.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(fn: Stage) -> Stage:
    """A stage that hands texts to Python workers in small batches."""

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return fn(bounded_batches(spark), docs, sf_dir)

    return run_stage


@stage
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects; it learns from ``labels``."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told."""
    return language.keep_identified(docs)


@stage
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of exact and near copies."""
    return jaccard.one_per_component(docs)


@stage
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark in the place of every secret."""
    return secrets.redact(docs)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.pack(docs, "word", tokenizer_path(WORD_BPE), WORD_END)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("language", known_language),
    ("near_duplicates", without_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: SQL cannot express the classifiers; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
