"""A corpus pipeline of the operators in ``sentimill.llm``; each stage works on all its predecessor kept.

Every stage but the last returns the columns of documents:
language ID drops documents without a determined language, near-duplicate removal keeps one document of each group, PII puts
``<kind>`` in place of personal data, mixing repeats or leaves out documents by their source's target, and packing places the
documents' tokens in sequences.  Nulls, empty texts and empty tables are handled as each operator says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sentimill.llm import langid, mixing, packing, pii, simhash_dedup
from sentimill.llm.common import table
from sentimill.llm.queries import vocabulary_path
from sentimill.plans.staging import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined."""
    return langid.accepted(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash_dedup.keep_one(docs)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data masked."""
    return pii.masked(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in sequences of 2048 tokens."""
    return packing.pack_documents(docs, vocabulary_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("without_pii", without_pii),
    ("mixed", mixed),
    ("packed", packed),
]

# Language models, fingerprints and token ids have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
