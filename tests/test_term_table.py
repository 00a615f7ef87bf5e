"""Scoring inside the rows and scoring by joins give the same, and only the second one shuffles."""

import re
import shutil
from functools import partial

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sentimill.functions import text as text_functions
from sentimill.operators import naive_bayes
from sentimill.plans import staging, term_blocks, term_table
from sentimill.sources import views
from sentimill.sources.reviews import load_model, save_model


def documents(spark):
    rows = [(i, i % 2, [f"w{(i * k) % 13}" for k in range(1, 3 + i % 5)] + ["é"] * (i % 3)) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, label int, terms array<string>")


ODD = [(100, ["unseen"]), (101, []), (102, None), (103, ["w1", None, "w1"]), (100, ["w2", "unseen", "w2", "w3"])]


@pytest.mark.parametrize("fit", [naive_bayes.bernoulli_nb_fit, naive_bayes.multinomial_nb_fit])
def test_both_ways_of_scoring_agree(spark, tmp_path, fit):
    save_model(fit(documents(spark), min_df=1, max_df=1.0), str(tmp_path / "model"))
    model = load_model(spark, str(tmp_path / "model"))
    # Rows that share a key are one document for the joins, so they are left out here.
    unseen = spark.createDataFrame(ODD[:4], "doc_id long, terms array<string>").unionByName(documents(spark).drop("label"))

    def rows(df):
        return [(r.doc_id, round(r.score0, 9), round(r.score1, 9), r.predicted) for r in df.orderBy("doc_id").collect()]

    inside = naive_bayes.nb_predict(model, unseen)
    found = rows(inside)
    assert len(found) == 64
    plan = plan_of(inside)
    assert "Exchange" not in plan and "Join" not in plan
    assert "from_json" not in plan and "JsonToStructs" not in plan  # a constant, not read anew in each row
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not term_table.fits_broadcast(model.terms)
        joined = naive_bayes.nb_predict(model, unseen)
        assert "Exchange" in plan_of(joined)
        assert rows(joined) == found
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_a_large_model_is_joined_with_the_terms_of_blocks(spark, monkeypatch):
    """Every term of every document was shuffled to the model, and its two numbers back to the document."""
    model = naive_bayes.bernoulli_nb_fit(documents(spark))
    docs = spark.createDataFrame([*ODD, (None, ["w1", "w3"])], "doc_id long, terms array<string>").coalesce(1)
    held = docs.select("doc_id", F.explode(F.array_distinct("terms")).alias("term")).join(model.terms, "term")
    plain = held.groupBy("doc_id").agg(F.sum(F.col("log_p0") - F.col("log_not0")).alias("e0"), F.sum(F.col("log_p1") - F.col("log_not1")).alias("e1"))
    monkeypatch.setattr(naive_bayes, "lookup", lambda *a: pytest.fail("the documents' terms are joined"))
    monkeypatch.setattr(naive_bayes, "found_by_block", partial(term_blocks.found_by_block, block_terms=3))
    rows = lambda df: {r.doc_id: (round(r.e0, 9), round(r.e1, 9)) for r in df.collect()}
    found = naive_bayes._evidence(model, docs, "doc_id")
    assert rows(found) == rows(plain) and set(rows(found)) == {100, 103, None}
    # The blocks are read where they lie; only their terms and the terms' values move.
    assert not re.search(r"Exchange hashpartitioning\(block#", plan_of(found))


def test_a_model_is_fitted_on_blocks_as_on_the_documents(spark):
    """F32: the training texts were tokenised and stored on their own, and their terms counted row by row."""
    texts = [(1, ["a1", "b1", "a1"]), (1, ["c1", None, "b1"]), (2, ["b1"]), (3, ["only"]), (4, None), (5, []), (None, ["b1", "lost"]), (6, ["odd"])]
    docs = spark.createDataFrame(texts, "doc_id long, terms array<string>").coalesce(1)
    # Documents 1 and 2 have two labels, 5 has no terms, 6 has a label of neither class, 3 and the NULL none.
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1), (4, 0), (5, 1), (6, 2)], "doc_id long, label int")
    rows = labels.join(docs, "doc_id")
    counts = labels.groupBy("doc_id").agg(
        F.count("*").alias(naive_bayes.TRAIN), F.count_if(F.col("label") == 0).alias(naive_bayes.TRAIN0), F.count_if(F.col("label") == 1).alias(naive_bayes.TRAIN1)
    )
    keys = ["doc_id", naive_bayes.TRAIN, naive_bayes.TRAIN0, naive_bayes.TRAIN1]
    weighed = docs.join(F.broadcast(counts), "doc_id", "left").select("terms", "doc_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in keys[1:]])
    n0, n1 = rows.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    for size in (1, 3, 1 << 23):
        blocks = term_blocks.pack(weighed, keys, block_terms=size)
        for bounds in ({}, {"min_df": 2}, {"max_df": 0.5}):
            ours = naive_bayes.bernoulli_nb_fit_blocks(blocks, n0, n1, **bounds)
            # A NULL is no word; the plain fit would count it.
            plain = naive_bayes.bernoulli_nb_fit(rows.withColumn("terms", F.filter("terms", lambda t: t.isNotNull())), **bounds)
            assert sorted(ours.terms.collect()) == sorted(plain.terms.collect())
            assert (ours.start0, ours.start1) == pytest.approx((plain.start0, plain.start1))
    # Blocks that are there are looked up whatever the model's size, with the sums that the documents' own terms give.
    found = naive_bayes.nb_predict(ours, docs.select("doc_id").distinct(), blocks=blocks).collect()
    held = docs.filter("doc_id <> 1 OR doc_id IS NULL")
    apart = {r.doc_id: r.score0 for r in naive_bayes.nb_predict(ours, held).collect() if r.doc_id}
    assert {r.doc_id: r.score0 for r in found if r.doc_id in apart} == pytest.approx(apart)


def test_scoring_reads_each_text_s_words_once(spark, sf_dir, tmp_path, monkeypatch):
    """F32: scoring tokenised the labelled texts twice, for the model and for the scores."""
    shutil.copytree(sf_dir, tmp_path / "sf")
    calls = []
    monkeypatch.setattr(views, "review_terms", lambda text: calls.append(1) or text_functions.review_terms(text))
    assert views.entries_text(spark, str(tmp_path / "sf")).count() > 0
    assert len(calls) == 1


def test_small_models_score_rows_of_one_document_apart(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    twice = docs.unionByName(docs.filter("doc_id = 7").withColumn("text", F.lit("a text of its own")))
    alone = docs.filter("doc_id <> 7").unionByName(twice.filter("doc_id = 7 AND text = 'a text of its own'"))
    found = {}
    for name, table in (("plain", docs), ("twice", twice), ("alone", alone)):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.read.parquet(f"{sf_dir}/labels.parquet").filter("doc_id <> 7").write.parquet(str(tmp_path / name / "labels.parquet"))
        found[name] = sorted(r.predicted_proba for r in views.entries_text(spark, str(tmp_path / name)).filter("doc_id = 7").collect())
    assert found["twice"] == sorted(found["plain"] + found["alone"])


def test_scans_are_cut_for_the_cores(spark, tmp_path):
    """F32: with one task a core and one too many, the other cores waited for a second round."""
    spark.range(400_000).withColumn("x", F.sha2(F.col("id").cast("string"), 512)).repartition(40).write.parquet(str(tmp_path / "t"))
    usual = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        tasks = lambda: spark.read.parquet(str(tmp_path / "t")).select("x").rdd.getNumPartitions()
        plain, cores = tasks(), spark.sparkContext.defaultParallelism
        with staging.fine_scans(spark):
            assert tasks() >= 4 * cores > plain
        assert tasks() == plain
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", usual)


def test_rows_of_one_key_are_scored_apart(spark):
    model = naive_bayes.bernoulli_nb_fit(documents(spark))
    docs = spark.createDataFrame(ODD, "doc_id long, terms array<string>")
    assert len(set(naive_bayes.nb_predict(model, docs).filter("doc_id = 100").select("score0").collect())) == 2


def test_empty_model(spark):
    docs = documents(spark)
    model = naive_bayes.bernoulli_nb_fit(docs, min_df=1000)
    assert naive_bayes.nb_predict(model, docs).count() == 60


def test_limit_is_read_from_the_session(spark):
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, size in (("-1", -1), ("10MB", 10 << 20), ("10485760b", 10485760), ("7", 7)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert term_table.broadcast_limit(spark.range(1)) == size
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
