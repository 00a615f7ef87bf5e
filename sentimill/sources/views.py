"""Review tables derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentimill.functions.text import review_terms
from sentimill.operators.naive_bayes import TRAIN, TRAIN0, TRAIN1, NaiveBayesModel, bernoulli_nb_fit_blocks, score_reviews
from sentimill.operators.sampling import stratified_split
from sentimill.plans.staging import fine_scans, kept, spread, stage, version
from sentimill.plans.term_blocks import Blocks, pack
from sentimill.plans.term_table import fits_broadcast
from sentimill.sources.reviews import load_model, read_entries, save_model, write_entries

FIRST_DAY = 1_325_376_000
DAY = 86_400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, spread over the cores for work on their texts."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id")


def reviews_raw(spark: SparkSession, sf_dir: str, text_work: bool = True) -> DataFrame:
    """Raw reviews, all columns text: documents with a score made from their label."""
    return _reviews_raw(spark, sf_dir, text_work).drop("doc_id")


def _reviews_raw(spark: SparkSession, sf_dir: str, text_work: bool = True) -> DataFrame:
    """``reviews_raw`` with the number of the document, by which it is dealt out."""
    docs = documents(spark, sf_dir) if text_work else table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    score = (
        F.when(F.col("quality") == 1, "5")
        .when(F.col("quality") == 0, "1")
        .when(doc % 7 == 0, "junk")
        .when(doc % 11 == 0, F.lit(None))
        .otherwise((2 + doc % 3).cast("string"))
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        doc.cast("string").alias("Id"),
        F.col("source").alias("ProductId"),
        score.alias("Score"),
        (FIRST_DAY + doc * DAY).cast("string").alias("Time"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("Summary"),
        F.col("text").alias("Text"),
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled reviews with the columns the report tables need."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return documents(spark, sf_dir).join(labels, "doc_id").select(
        "doc_id",
        "label",
        "text",
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("predicted_summary"),
        F.when(F.col("label") == 1, 5).otherwise(1).alias("score"),
        F.col("source").alias("productid"),
        (FIRST_DAY + F.col("doc_id") * DAY).alias("time"),
    )


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    return (sf_dir, *version(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet"))


def keep(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The folder of a result that is written once for a state of the documents and labels."""
    return kept(spark, name, _version(spark, sf_dir), write)


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, label, is_train`` of the labelled documents (75/25, stratified), from a stored table.

    The split is decided on the narrow key tables.  It is written, so its size is known when texts are joined.
    """

    def write(path: str) -> None:
        labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
        ids = table(spark, sf_dir, "documents").select("doc_id")
        stratified_split(labels.join(ids, "doc_id", "left_semi")).write.parquet(path)

    return spark.read.parquet(keep(spark, sf_dir, "split", write))


def split_terms(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test part of the tokenised documents, from a stored table.

    They are tokenised once for all queries that read single documents' terms.
    """

    def write(path: str) -> None:
        terms = split(spark, sf_dir).join(documents(spark, sf_dir), "doc_id").select(
            "doc_id", "label", "is_train", review_terms(F.col("text")).alias("terms")
        )
        terms.write.partitionBy("is_train").option("compression", "zstd").parquet(path)

    schema = "doc_id bigint, label int, terms array<string>, is_train boolean"
    written = spark.read.schema(schema).parquet(keep(spark, sf_dir, "labelled-terms", write))
    return (
        written.filter("is_train").drop("is_train"),
        written.filter(~F.col("is_train")).drop("is_train"),
    )


def document_blocks(spark: SparkSession, sf_dir: str) -> Blocks:
    """All documents, tokenised once and packed, with how often each is a training document of either class."""
    train = split(spark, sf_dir).filter("is_train").groupBy("doc_id").agg(
        F.count("*").cast("int").alias(TRAIN),
        F.count_if(F.col("label") == 0).cast("int").alias(TRAIN0),
        F.count_if(F.col("label") == 1).cast("int").alias(TRAIN1),
    )
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in (TRAIN, TRAIN0, TRAIN1)]
    # Narrow, at most a row per document; written, its size is known when the texts are joined.
    docs = documents(spark, sf_dir).join(stage(train, "train"), "doc_id", "left")
    return pack(docs.select("doc_id", *counts, review_terms(F.col("text")).alias("terms")), ["doc_id", TRAIN, TRAIN0, TRAIN1])


def trained_model(spark: SparkSession, sf_dir: str, blocks: Blocks) -> NaiveBayesModel:
    """The Bernoulli model of the training part of ``document_blocks``."""
    train = split(spark, sf_dir).filter("is_train").join(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    n0, n1 = train.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    return bernoulli_nb_fit_blocks(blocks, n0, n1)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reviews, labelled or not, with the columns the report tables need."""
    return _reviews_raw(spark, sf_dir).select(
        F.col("doc_id").cast("bigint"),
        F.col("Text").alias("text"),
        F.col("Summary").alias("predicted_summary"),
        # 0: without a valid score.
        F.coalesce(F.col("Score").try_cast("int"), F.lit(0)).alias("score"),
        F.col("ProductId").alias("productid"),
        F.col("Time").cast("bigint").alias("time"),
    )


def _one_row_each(df: DataFrame, key: str) -> bool:
    """Whether every row has a key of its own."""
    return df.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull()).isEmpty()


def stored_scores(spark: SparkSession, sf_dir: str) -> str:
    """The folder with ``entries``, ``negative_reviews`` and ``model``, written by one batch job."""
    proba = F.round("predicted_proba", 6)

    def write(path: str) -> None:
        # The texts are tokenised once: the model is fitted and looked up on the same blocks.
        blocks = document_blocks(spark, sf_dir)
        save_model(trained_model(spark, sf_dir, blocks), f"{path}/model")
        model = load_model(spark, f"{path}/model")
        if fits_broadcast(model.terms) and not _one_row_each(table(spark, sf_dir, "documents"), "doc_id"):
            # Rows that share a key have one evidence in the blocks; a small model scores each apart, on the words in its row.
            rows = reviews(spark, sf_dir).select("*", review_terms(F.col("text")).alias("terms"))
            # Written, as clustering reads them twice.
            scored = stage(score_reviews(model, rows).withColumn("predicted_proba", proba), "scored")
        else:
            scored = score_reviews(model, reviews(spark, sf_dir), blocks=blocks).withColumn("predicted_proba", proba)
        write_entries(scored, path)

    with fine_scans(spark):
        return keep(spark, sf_dir, "scores", write)


def entries_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reviews scored by the trained model, from the stored table."""
    return read_entries(spark, stored_scores(spark, sf_dir))


def negative_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_entries(spark, stored_scores(spark, sf_dir), "negative_reviews")


def stored_model(spark: SparkSession, sf_dir: str) -> NaiveBayesModel:
    return load_model(spark, f"{stored_scores(spark, sf_dir)}/model")


def entries_num(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored reviews without text, one per line item, for the roll-ups."""
    shipped = F.col("l_shipdate")
    seconds = F.hour(shipped) * 3600 + F.minute(shipped) * 60 + F.second(shipped)
    returned = F.col("l_returnflag") == "R"
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("productid"),
        (F.unix_date(F.to_date(shipped)).cast("bigint") * DAY + seconds).alias("time"),
        F.when(returned, 0).otherwise(1).alias("predicted_score"),
        F.when(returned, -1).otherwise(1).alias("predicted_sentiment"),
        F.least(F.round(F.col("l_extendedprice") / 105000, 6), F.lit(1.0)).alias("predicted_proba"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
    )
