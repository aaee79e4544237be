"""The corpus pipeline: identified, deduplicated, decontaminated, redacted and tokenised documents.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all rows the stage before it kept; the
first four return the columns of ``documents``, the last one tokens. ``run`` writes each
stage's result into the session's shared folder and reads it again for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, language, neardup, pii
from tidemark.llm.common import table
from tidemark.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or without one prevailing language, go."""
    return language.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return neardup.drop_near_duplicates(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts gives way to the names of its kinds."""
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text: doc_id, n_tokens, ids."""
    return bpe.encode(docs)


STAGES = [("language_id", identify_language), ("near_dedup", near_dedup), ("decontamination", decontaminate_benchmark),
          ("pii", redact_pii), ("bpe", encode)]

#: signatures, fitted models and tokens have no SQL; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
