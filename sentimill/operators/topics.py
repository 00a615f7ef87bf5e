"""Topics of negative reviews, for all products at once."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimill.functions import text as tx
from sentimill.functions.constants import SHOP_WORDS, STOP_WORDS
from sentimill.operators.features import unit_length
from sentimill.operators.naive_bayes import NaiveBayesModel
from sentimill.operators.nmf import Factors, nmf_fit, nmf_residual
from sentimill.plans.skew import lookup
from sentimill.plans.term_blocks import Found, found_by_block

# Functions that run inside tasks travel with them, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Terms of a block of negative reviews with repeats, about: a block's weights are one table in a task.
WEIGHT_TERMS = 1 << 22
#: The largest residual of finished topics; the rule by loss stops at 0.014 and less on the given tables, five steps leave 0.07 and more.
STATIONARY = 0.02


def _weights(block: Found, is_unit: bool) -> list[pa.Array]:
    """Keys, term and weight of every entry; ``is_unit``: divided by the length of the review's vector."""
    weights = block.tf * block.values["idf"][block.cols]
    if is_unit:
        weights = weights / np.sqrt(block.summed(weights * weights))[block.docs]
    docs, cols = pa.array(block.docs), pa.array(block.cols)
    return [*(k.take(docs) for k in block.keys), block.terms.take(cols), pa.array(weights)]


def negative_tfidf(
    model: NaiveBayesModel,
    negative: DataFrame,
    key: str = "doc_id",
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """``productid, key, term, weight``: negative reviews in the model's vocabulary; rows that share product and key share a length."""
    keys = ["productid", key]
    docs = negative.select(*keys, tx.vector_terms(F.col("text"), stop_words).alias("terms"))
    schema = T.StructType([*(docs.schema[c] for c in keys), T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())])
    is_unit = negative.groupBy(*keys).count().filter("count > 1").isEmpty()
    table = model.terms.select("term", "idf")
    found = found_by_block(docs, keys, table, partial(_weights, is_unit=is_unit), schema, block_terms=WEIGHT_TERMS)
    return found if is_unit else unit_length(found, keys)


def topic_terms(f: Factors) -> DataFrame:
    """``productid, topic, term, weight`` of the product's topics."""
    long = f.h.select("productid", "term", "k", F.posexplode("h").alias("topic", "weight"))
    return long.filter(F.col("topic") < F.col("k")).select("productid", "topic", "term", "weight")


def nmf_topics(weights: DataFrame, **settings) -> DataFrame:
    """``productid, topic, term, weight`` of the fitted topics."""
    return topic_terms(nmf_fit(weights, **settings))


def topic_facts(f: Factors, bound: float = STATIONARY, key: str = "doc_id") -> DataFrame:
    """Per product what its factors are and whether they are finished: settled by loss, and with a residual within ``bound``."""
    reviews = f.w.groupBy("productid").agg(F.max("k").alias("topics"), F.count("*").alias("reviews"))
    terms = f.h.groupBy("productid").agg(F.count("*").alias("terms"))
    facts = reviews.join(terms, "productid").join(f.fits.drop("loss"), "productid")
    return facts.join(nmf_residual(f, key=key), "productid").withColumn(
        "is_stationary", (F.col("residual") <= bound).cast("int")
    )


def save_factors(f: Factors, path: str, tables: Sequence[str] = ("x", "w", "h", "fits")) -> None:
    """Write the four tables below ``path``, or those of them that are not written elsewhere."""
    for name in tables:
        getattr(f, name).write.option("compression", "zstd").parquet(f"{path}/{name}")


def load_factors(spark: SparkSession, path: str, x: DataFrame | None = None) -> Factors:
    """The written factors; ``x``: the weights, if they are not below ``path``."""
    x = spark.read.parquet(f"{path}/x") if x is None else x
    tables = [spark.read.parquet(f"{path}/{name}") for name in ("w", "h", "fits")]
    most = tables[1].agg(F.max(F.size("h"))).first()[0]
    return Factors(x, *tables, most or 0)


def top_topic_words(topics: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` heaviest terms of each topic; near-equal weights go by the term."""
    heaviest = Window.partitionBy("productid", "topic").orderBy(
        F.desc(F.round("weight", 9)), F.col("term")
    )
    return (
        topics.withColumn("place", F.row_number().over(heaviest))
        .filter(F.col("place") <= n)
        .select("productid", "topic", "place", "term")
    )


def word_class(words: DataFrame, model: NaiveBayesModel) -> DataFrame:
    """Add the class in which a word is likelier; ties are class 0, unknown words are dropped."""
    likelier = (F.round(F.col("log_p1") - F.col("log_p0"), 9) > 0).cast("int")
    known = model.terms.select("term", "df", likelier.alias("word_class"))
    return lookup(words, known, ["term"], "df", ["productid"]).drop("df")


def negative_words(classed: DataFrame, shop_words: Sequence[str] = SHOP_WORDS) -> DataFrame:
    """Words of class 0 that are not about the shop."""
    return classed.filter((F.col("word_class") == 0) & ~F.col("term").isin(*shop_words))


def word_weights(words: DataFrame, n: int = 200) -> DataFrame:
    """``productid, term, frequency``: the ``n`` most frequent words of each product."""
    counted = words.groupBy("productid", "term").agg(F.count("*").alias("frequency"))
    place = F.row_number().over(
        Window.partitionBy("productid").orderBy(F.desc("frequency"), "term")
    )
    return (
        counted.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")
    )
