"""The queries of the operators: each applies one to its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentimill.llm import (
    ann,
    collocations,
    html_extract,
    langid,
    lexical,
    mixing,
    packing,
    pii,
    quality,
    simhash_dedup,
    topk_exact,
    toxicity,
    url_filter,
)
from sentimill.llm.common import table
from sentimill.llm.oracles import ORACLES


def vocabulary_path() -> str:
    """The byte-level vocabulary; installed wherever tasks run."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op3_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op4_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op5_topk_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_exact.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op9_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op11_document_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_url_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    "op1_source_mixing": op1_source_mixing,
    "op2_language_id": op2_language_id,
    "op3_html_consensus": op3_html_consensus,
    "op4_pii_anchors": op4_pii_anchors,
    "op5_topk_exact": op5_topk_exact,
    "op6_quality_votes": op6_quality_votes,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_collision_ann": op9_collision_ann,
    "op10_toxicity_severity": op10_toxicity_severity,
    "op11_document_tree_search": op11_document_tree_search,
    "op12_collocations": op12_collocations,
    "op13_url_automaton": op13_url_automaton,
}
