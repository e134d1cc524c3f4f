"""Corpus pipeline over ``documents``: identify, deduplicate, decontaminate, mask, mix.

Each stage gets the documents that its predecessor kept and returns documents; the last returns the mix, in
which a document stands as often as it is taken (``copy`` counts from 1).

The stages that hand whole texts to Python lower the session's rows per Arrow batch (``common.text_batches``), as a
stage's result is only computed when its caller writes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventmart.llm import decontamination, language_id, mixing, near_copies, pii
from eventmart.llm.common import stage, table, text_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; texts without letters, or of no likely language, go."""
    text_batches(spark)
    return language_id.keep_identified(docs, language_id.train(docs))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8), that with the least doc_id."""
    text_batches(spark)
    return near_copies.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; those that mostly consist of them go."""
    text_batches(spark)
    return decontamination.remove_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    text_batches(spark)
    return pii.mask(docs, pii.train(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources."""
    return mixing.mixture(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify),
    ("simhash", deduplicate),
    ("decontamination", decontaminate),
    ("pii", mask_personal_data),
    ("mixing", mix),
]

#: SQL can express neither the trained models nor the random rounding.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
