"""Models against MLlib, brute force and their own properties."""

import math
from collections import Counter

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

import __spark_entry__ as entry_file
from conftest import plan_of
from sentimill.operators import features, linear, metrics, naive_bayes, nmf, topics
from sentimill.sources import reviews, views

DOCS = [
    (0, 0, ["bad", "taste", "bad"]),
    (1, 0, ["stale", "taste"]),
    (2, 1, ["good", "taste"]),
    (3, 1, ["good", "fresh", "good"]),
    (4, 1, ["fresh", "taste", "smell"]),
    (5, 1, []),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, label int, terms array<string>").coalesce(2)


def test_term_counts_need_no_shuffle(spark, docs):
    counts = features.term_counts(docs)
    assert "Exchange" not in plan_of(counts)
    expected = {(d, t, n) for d, _, ts in DOCS for t, n in Counter(ts).items()}
    assert {tuple(r) for r in counts.collect()} == expected


def test_tfidf_has_unit_length(spark, docs):
    postings = features.term_counts(docs)
    n = features.document_total(docs)
    weights = features.tfidf(postings, features.vocabulary(postings, n), n)
    lengths = weights.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("l")).collect()
    assert len(lengths) == 5 and all(abs(r.l - 1) < 1e-12 for r in lengths)


def test_vocabulary_limits(spark, docs):
    postings = features.term_counts(docs)
    n = features.document_total(docs)
    kept = {r.term for r in features.vocabulary(postings, n, 2, 0.5).collect()}
    assert kept == {"good", "fresh"}


def _mllib_log_probs(docs, kind):
    vectorizer = CountVectorizer(inputCol="terms", outputCol="features", binary=kind == "bernoulli").fit(docs)
    model = NaiveBayes(modelType=kind, smoothing=1.0).fit(vectorizer.transform(docs))
    theta = model.theta.toArray()
    return {(c, t): theta[c][i] for c in (0, 1) for i, t in enumerate(vectorizer.vocabulary)}


def test_bernoulli_parameters_equal_mllib(spark, docs):
    ours = {(r["class"], r.term): r.log_prob for r in naive_bayes.bernoulli_nb_fit(docs).params().collect()}
    assert ours == pytest.approx(_mllib_log_probs(docs, "bernoulli"))


def test_bernoulli_prediction_equals_brute_force(spark, docs):
    model = naive_bayes.bernoulli_nb_fit(docs)
    words = {t for _, _, ts in DOCS for t in ts}
    classes = {c: [set(ts) for _, l, ts in DOCS if l == c] for c in (0, 1)}

    def score(c, ts):
        total = math.log(len(classes[c]) / len(DOCS))
        for w in words:
            p = (sum(w in d for d in classes[c]) + 1) / (len(classes[c]) + 2)
            total += math.log(p if w in ts else 1 - p)
        return total

    unseen = spark.createDataFrame([(9, ["good", "never"]), (10, []), (11, ["unknown"])], "doc_id long, terms array<string>")
    for r in naive_bayes.nb_predict(model, unseen).collect():
        ts = {9: {"good"}, 10: set(), 11: set()}[r.doc_id]
        assert (r.score0, r.score1) == pytest.approx((score(0, ts), score(1, ts)))
        assert r.predicted == int(score(1, ts) > score(0, ts))


def test_missing_class_predicts_the_other(spark, docs):
    model = naive_bayes.bernoulli_nb_fit(docs.filter("label = 1"))
    assert {r.predicted for r in naive_bayes.nb_predict(model, docs).collect()} == {1}


def test_saved_model_scores_the_same(spark, docs, tmp_path):
    for fit in (naive_bayes.bernoulli_nb_fit, naive_bayes.multinomial_nb_fit):
        model = fit(docs, min_df=1, max_df=1.0)
        path = str(tmp_path / model.kind)
        reviews.save_model(model, path)
        again = reviews.load_model(spark, path)
        before = naive_bayes.nb_predict(model, docs).orderBy("doc_id").collect()
        assert naive_bayes.nb_predict(again, docs).orderBy("doc_id").collect() == before


def test_probabilities_sum_to_one(spark, docs):
    model = naive_bayes.multinomial_nb_fit(docs, min_df=1, max_df=1.0)
    for r in naive_bayes.nb_predict_proba(model, docs).collect():
        assert r.proba0 + r.proba1 == pytest.approx(1) and 0 <= r.proba1 <= 1


def predictions(spark):
    return spark.range(4000).select(
        ((F.col("id") * 7919 % 101) % 3 == 0).cast("int").alias("label"),
        (F.round((F.col("id") * 31 % 977) / 977, 2)).alias("proba"),
        (F.col("id") % 2).cast("int").alias("predicted"),
    )


def test_auc_equals_mllib(spark):
    scored = predictions(spark)
    theirs = BinaryClassificationEvaluator(rawPredictionCol="proba", labelCol="label", numBins=0)
    assert metrics.roc_auc(scored).first().auc == pytest.approx(theirs.evaluate(scored), abs=1e-9)


def test_auc_without_a_class_is_null(spark):
    assert metrics.roc_auc(predictions(spark).filter("label = 1")).first().auc is None


def test_curve_ends_at_one_and_drops_only_points_on_the_line(spark):
    scored = predictions(spark)
    full = metrics.roc_curve(scored, drop_intermediate=False).orderBy(F.desc("threshold")).collect()
    short = metrics.roc_curve(scored).orderBy(F.desc("threshold")).collect()
    assert (full[0].fpr, full[0].tpr) == (0, 0) and (short[-1].fpr, short[-1].tpr) == (1, 1)
    assert set(short) <= set(full)

    def area(points):
        return sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(points, points[1:]))

    assert area(short) == pytest.approx(area(full))


def test_confusion_keeps_absent_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "label int, predicted int")
    assert [tuple(r) for r in metrics.confusion_matrix(df).orderBy("predicted").collect()] == [(0, 0, 0), (1, 0, 2)]
    assert metrics.confusion_rates(df).first().tpr == 1


def test_linear_models_learn_the_training_set(spark):
    rows = [(i, i % 2, ["good", "tea"] if i % 2 else ["bad", "tea"]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, label int, terms array<string>").coalesce(1)
    for fit in (linear.logistic_fit, linear.svm_fit):
        scored = linear.linear_predict(fit(df), df)
        assert metrics.accuracy(scored).first().accuracy == 1.0
    grid = linear.lr_grid_search(df, cs=[1.0], folds=2)
    assert grid.first().mean_auc == 1.0


def weights(spark):
    """One product with many reviews, one with a single review."""
    rows = [
        (p, d, f"t{(d * 7 + j * j) % 13}", 0.2 + ((d + j) % 5) / 10)
        for p, n in (("big", 30), ("one", 1)) for d in range(n) for j in range(6)
    ]
    df = spark.createDataFrame(rows, "productid string, doc_id long, term string, weight double")
    return df.groupBy("productid", "doc_id", "term").agg(F.max("weight").alias("weight"))


def test_topic_loss_never_rises_without_penalties(spark):
    x = weights(spark)
    losses = []
    for steps in (1, 2, 3):
        f = topics.nmf_fit(x, topics=3, iterations=steps, alpha=0.0, tolerance=None)
        losses.append({r.productid: r.loss for r in f.fits.collect()})
        assert losses[-1] == pytest.approx({r.productid: r.loss for r in nmf.nmf_residual(f, alpha=0.0).collect()})
    for p in ("big", "one"):
        assert losses[0][p] >= losses[1][p] - 1e-9 >= losses[2][p] - 2e-9


def by_name(f):
    return (
        {(r.productid, r.term): r.h for r in f.h.collect()},
        {(r.productid, r.doc_id): r.w for r in f.w.collect()},
        {r.productid: (r.steps, r.is_settled) for r in f.fits.collect()},
    )


@pytest.mark.parametrize("rules", [{"iterations": 2, "tolerance": None}, {"iterations": 60, "tolerance": 1e-3, "check_every": 5}])
def test_topics_do_not_depend_on_the_blocks(spark, rules):
    """A product in one block is fitted where it lies, one in several step by step with the others."""
    whole = by_name(topics.nmf_fit(weights(spark), topics=3, **rules))
    parted = by_name(topics.nmf_fit(weights(spark), topics=3, block_entries=40, **rules))
    assert whole[2] == parted[2]
    for a, b in zip(whole[:2], parted[:2], strict=True):
        assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)
    assert all(v >= 0 for row in whole[0].values() for v in row)
    assert all(row[1:] == [0.0, 0.0] for (p, _), row in whole[0].items() if p == "one")


def test_a_step_exchanges_factors_only(spark):
    packed = spark.createDataFrame(
        [("p", b, 2, 1, ["1"], ["t"], b"", b"", b"") for b in range(2)],
        "productid string, block int, blocks int, k int, keys array<string>, terms array<string>, docs binary, cols binary, values binary",
    )
    table, name = nmf._in_place(packed)
    given = spark.createDataFrame([], "productid string, block int, kind int, term string, given array<double>")
    blocks = table.select("productid", "block", "terms", "docs", "cols", "values")
    plan = nmf.step_rows(blocks, given, 2, nmf.Rules(0.0, 0.0, 1, None, 1))._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"DROP TABLE {name}")
    assert plan.count("Exchange") == 1 and "Exchange" not in plan[plan.index("FileScan") - 200 : plan.index("FileScan")]


def test_unfinished_topics_are_told(spark):
    for steps, finished in ((0, 0), (5, 0), (200, 1)):
        f = topics.nmf_fit(weights(spark).filter("productid = 'big'"), topics=3, iterations=steps, tolerance=1e-4)
        facts = topics.topic_facts(f).first()
        assert (facts.is_settled, facts.is_stationary) == (finished, finished)
        assert (facts.topics, facts.reviews, facts.terms) == (3, 30, 13 if finished else facts.terms)


def test_products_without_name_and_without_reviews(spark):
    schema = "productid string, doc_id long, term string, weight double"
    rows = [("", 1, "a", 1.0), (None, 2, "a", 1.0), ("p", 3, "b", 0.5), ("p", None, "b", 0.5)]
    f = topics.nmf_fit(spark.createDataFrame(rows, schema), topics=2, iterations=3, tolerance=None)
    assert {r.productid for r in f.fits.collect()} == {"", "p"}
    assert sorted(r.topic for r in topics.topic_terms(f).filter("productid = ''").collect()) == [0]
    none = topics.nmf_fit(spark.createDataFrame([], schema), topics=2)
    assert topics.topic_terms(none).count() == 0 and none.fits.count() == 0


def test_shop_words_are_left_out(spark):
    words = spark.createDataFrame([("p", "producer", 0), ("p", "stale", 0), ("p", "good", 1)], "productid string, term string, word_class int")
    assert [r.term for r in topics.negative_words(words).collect()] == ["stale"]


def test_a_class_missing_from_a_training_part(spark):
    """One document of a class: the fold that holds it out has no such class to learn from."""
    rows = [(i, int(i == 0), ["a", "b"] if i % 2 else ["b", "c"]) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id int, label int, terms array<string>")
    found = naive_bayes.cross_validate(docs, folds=3)
    assert found.agg(F.sum("rows")).first()[0] == 12
    assert found.filter("accuracy is null").count() == 0
    assert naive_bayes.nb_grid_search(docs, alphas=[1.0], min_dfs=[1], max_dfs=[1.0], folds=3).count() == 1


def test_searched_settings_are_flagged_and_refitted(spark):
    rows = [(i, i % 2, ["good", f"w{i % 5}"] if i % 2 else ["bad", f"w{i % 5}"]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id int, label int, terms array<string>").cache()
    found = linear.lr_grid_search(docs, cs=[0.1, 1.0], folds=2)
    assert found.filter("is_best = 1").count() == 1
    scored = linear.linear_predict(linear.lr_refit(docs, found), docs)
    assert scored.filter("predicted != label").count() == 0
    searched = linear.svm_grid_search(docs, alphas=[0.01], min_dfs=[1.0], folds=2)
    assert searched.count() == 4 and searched.filter('is_converged = 0').count() == 0
    assert linear.linear_predict(linear.svm_refit(docs, searched), docs).count() == 40


def test_linear_model_round_trip(spark, tmp_path):
    rows = [(i, i % 2, ["good"] if i % 2 else ["bad"]) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id int, label int, terms array<string>").cache()
    model = linear.logistic_fit(docs)
    linear.save_linear(model, str(tmp_path / "m"))
    again = linear.linear_predict(linear.load_linear(spark, str(tmp_path / "m")), docs)
    assert again.exceptAll(linear.linear_predict(model, docs)).count() == 0


def test_topics_converge(spark):
    rows = [("p", d, f"t{(d * 7 + j) % 11}", 1.0 + j) for d in range(8) for j in range(4)]
    weights = spark.createDataFrame(rows, "productid string, doc_id int, term string, weight double")
    few = topics.nmf_fit(weights, topics=2, iterations=2, tolerance=None)
    settled = topics.nmf_fit(weights, topics=2, iterations=40, tolerance=0.02, check_every=3)
    losses = [f.fits.first()["loss"] for f in (few, settled)]
    assert losses[1] < losses[0]


def test_topics_of_a_product_do_not_change_with_the_other_products(spark):
    def rows(p, n, scale):
        return [(p, d, f"t{(d * 7 + j) % 11}", scale * (1.0 + j)) for d in range(n) for j in range(4)]

    columns = "productid string, doc_id int, term string, weight double"
    alone = spark.createDataFrame(rows("small", 5, 1.0), columns)
    beside = spark.createDataFrame(rows("small", 5, 1.0) + rows("large", 9, 1000.0), columns)
    settings = {"topics": 2, "iterations": 24, "tolerance": 0.01, "check_every": 3}
    found = [
        {(r.topic, r.term): r.weight for r in topics.nmf_topics(w, **settings).filter("productid = 'small'").collect()}
        for w in (alone, beside)
    ]
    assert found[0] and found[0] == pytest.approx(found[1])




def test_a_product_of_many_entries_exchanges_nothing_in_its_steps(spark, monkeypatch):
    """Beyond 2^18 entries a product's steps had each moved and written the factors of all its terms."""
    rows = spark.range(300_000).select(
        F.lit("p").alias("productid"), F.floor(F.col("id") / 100).alias("doc_id"),
        F.concat(F.lit("t"), F.col("id") % 100).alias("term"), (1 + F.col("id") % 7).cast("double").alias("weight"),
    )
    monkeypatch.setattr(nmf, "step_rows", lambda *a: pytest.fail("factors are exchanged"))
    found = nmf.nmf_fit(rows, topics=2, iterations=2, tolerance=None)
    assert (found.w.count(), found.h.count()) == (3000, 100)
    assert found.fits.select("productid", "steps").first() == ("p", 2)


def test_weights_of_negative_reviews_are_written_once(spark, tmp_path, monkeypatch):
    """They were written by the weights' step, by the fit and with the factors, for the five steps and again for the finished topics."""
    texts = [(i, f"s{i % 2}", f"{'good' if i % 3 else 'awful'} term{i % 5} term{i % 7} {'fine' if i % 3 else 'broken'}") for i in range(60)]
    spark.createDataFrame([*texts, texts[0]], "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    staged, worked_out = [], []
    one, weigh = nmf.stage, topics.negative_tfidf
    monkeypatch.setattr(nmf, "stage", lambda df, label: staged.append(df.columns) or one(df, label))
    monkeypatch.setattr(topics, "negative_tfidf", lambda *a: worked_out.append(1) or weigh(*a))
    for name in ("negative_words_five_steps", "nmf_topics_finished"):
        entry_file.queries()[name](spark, str(tmp_path)).collect()
    assert len(worked_out) == 1 and not [c for c in staged if c == ["productid", "doc_id", "term", "weight"]]
    # Rows that share their key share a length.
    lengths = weigh(views.stored_model(spark, str(tmp_path)), views.negative_text(spark, str(tmp_path))).groupBy("doc_id").agg(
        F.sum(F.col("weight") * F.col("weight")).alias("l"), F.count("*").alias("n")
    )
    assert {round(r.l, 9) for r in lengths.collect()} == {1.0} and max(r.n for r in lengths.collect()) == 6
