"""Linear models: the duality gap, plain solutions, folds, settings and blocks."""

import warnings
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentimill.operators import dual, linear
from sentimill.operators.dual import Setting
from sentimill.plans.cuts import stratified_folds

DOCS = "doc_id long, label int, terms array<string>"


@pytest.fixture(scope="module")
def docs(spark):
    """Overlapping classes, an empty document, a repeated one, and one without known terms later on."""
    rnd = np.random.default_rng(7)
    rows = []
    for i in range(90):
        label = int(rnd.random() < 0.6)
        own = [f"{'g' if label ^ (rnd.random() < 0.2) else 'b'}{x}" for x in rnd.zipf(1.6, 6) % 12]
        rows.append((i, label, own + [f"c{x}" for x in rnd.integers(0, 9, 5)]))
    rows += [(90, 1, []), (91, 0, rows[0][2]), (92, 0, rows[0][2])]
    return spark.createDataFrame(rows, DOCS).cache()


def plain_vectors(rows, min_df=1.0, fitted=None):
    """Dense TF-IDF rows with a constant; frequencies from ``fitted``."""
    fitted = rows if fitted is None else fitted
    df = {}
    for _, _, terms in fitted:
        for t in set(terms):
            df[t] = df.get(t, 0) + 1
    n = len(fitted)
    least = min_df if min_df >= 1 else min_df * n
    names = {t: i for i, t in enumerate(sorted(t for t, d in df.items() if d >= least))}
    x = np.zeros((len(rows), len(names) + 1))
    for i, (_, _, terms) in enumerate(rows):
        for t in terms:
            if t in names:
                x[i, names[t]] += np.log((n + 1) / (df[t] + 1)) + 1
        length = np.sqrt((x[i] ** 2).sum())
        x[i] /= length or 1.0
        x[i, -1] = 1.0
    return x, names


def plain_loss(w, x, y, s):
    z = y * (x @ w)
    loss = np.logaddexp(0, -z) if s.loss == "log" else np.maximum(0, 1 - z)
    return loss.mean() + s.l2 / 2 * (w @ w) + s.l1 * np.abs(w).sum()


def plain_fit(x, y, s, steps=20000):
    """Proximal gradient (log) or averaged subgradient descent (hinge)."""
    w, best = np.zeros(x.shape[1]), (np.inf, None)
    reach = np.linalg.norm(x, 2) ** 2 / len(y) / 4 + s.l2
    for t in range(steps):
        z = y * (x @ w)
        if s.loss == "log":
            g = -(x.T @ (y / (1 + np.exp(z)))) / len(y) + s.l2 * w
            step = 1 / reach
        else:
            g = -(x.T @ (y * (z < 1))) / len(y) + s.l2 * w
            step = 1 / (s.l2 * (t + 100))
        w = w - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * s.l1, 0)
        if t % 200 == 0 or t == steps - 1:
            best = min(best, (plain_loss(w, x, y, s), t), key=lambda b: b[0])
    return best[0]


SETTINGS = [
    Setting("log", 0.01), Setting("log", 0.02, 0.01), Setting("hinge", 0.02), Setting("hinge", 0.02, 0.01), Setting("hinge", 0.3, 0.05),
]


def rows_of(docs):
    return [(r.doc_id, r.label, r.terms) for r in docs.orderBy("doc_id").collect()]


@pytest.mark.parametrize(
    # A hinge model with a weak penalty takes many rounds when several blocks share it, so those have the others only.
    ("block_rows", "blocks", "settings", "tolerance"),
    [(5000, 1, SETTINGS, 1e-5), (35, 3, [*SETTINGS[:2], SETTINGS[4]], 1e-4)],
)
def test_the_gap_brackets_the_best_loss(docs, monkeypatch, block_rows, blocks, settings, tolerance):
    """One block or several: the loss is what the bound says, and no plain solution is below it."""
    monkeypatch.setattr(dual, "BLOCK_ROWS", block_rows)
    corpus = linear.encode(docs)
    fit = dual.fit_many(corpus.blocks, corpus.idf(), settings, [corpus.documents] * len(settings), tolerance)
    assert corpus.blocks.count() == blocks
    assert fit.converged.all() and (fit.gap <= tolerance).all() and (fit.gap > -1e-12).all()
    rows = rows_of(docs)
    x, names = plain_vectors(rows)
    y = np.array([1.0 if label else -1.0 for _, label, _ in rows])
    order = [names[r.term] for r in corpus.terms.orderBy("id").collect()] + [len(names)]
    for m, s in enumerate(settings):
        w = np.zeros(len(names) + 1)
        w[order] = fit.weights[:, m]
        assert plain_loss(w, x, y, s) == pytest.approx(fit.primal[m], rel=1e-9)
        assert fit.dual[m] <= plain_fit(x, y, s, 4000) + 1e-9
        assert fit.primal[m] <= plain_fit(x, y, s, 4000) * (1 + 10 * tolerance)


@pytest.mark.parametrize("fit", [linear.logistic_fit, linear.svm_fit, lambda d: linear._fit(linear.encode(d), Setting("hinge", 0.02, 0.01))])
def test_the_certificate_is_worked_out_anew(docs, fit):
    model = fit(docs)
    found = linear.optimum(model, docs).first()
    assert (found.documents, found.is_optimal) == (93, 1)
    assert found.terms == model.terms.count()
    assert abs(found.relative_gap) <= 2 * dual.TOLERANCE
    # The same weights are no optimum of another penalty, nor of other documents.
    other = replace(model, setting=replace(model.setting, l2=model.setting.l2 * 5))
    assert linear.optimum(other, docs).first().is_optimal == 0
    flipped = docs.withColumn("label", 1 - F.col("label"))
    assert linear.optimum(model, flipped).first().is_optimal == 0


def test_an_untrained_model_is_refused(docs):
    corpus = linear.encode(docs)
    for setting in (linear.logistic_setting(93), linear.sgd_setting("hinge", "l2", 1e-4)):
        with pytest.warns(UserWarning, match="have not closed their gap"):
            model = linear._fit(corpus, setting, most_epochs=0)
        assert model.terms.filter("weight <> 0").count() == 0
        found = linear.optimum(model, docs).first()
        assert (found.relative_gap, found.is_optimal) == (1.0, 0)
        with pytest.warns(UserWarning, match="1 of 1 models"):
            short = linear._fit(corpus, setting, most_epochs=1)
        assert linear.optimum(short, docs).first().is_optimal == 0


def test_many_models_equal_single_ones(docs):
    corpus = linear.encode(docs)
    together = dual.fit_many(corpus.blocks, corpus.idf(), SETTINGS, [corpus.documents] * 5, 1e-7)
    for m in (1, 4):
        alone = dual.fit_many(corpus.blocks, corpus.idf(), [SETTINGS[m]], [corpus.documents], 1e-7)
        assert np.allclose(together.weights[:, m], alone.weights[:, 0], atol=5e-3)
        assert together.primal[m] == pytest.approx(alone.primal[0], rel=1e-6)


def test_folds_are_left_out(spark, docs):
    """Each fold's model equals one fitted without its documents, on features of all."""
    found = {r.fold: r for r in linear.svm_fold_accuracies(docs, folds=3, alpha=0.02).collect()}
    placed = stratified_folds(docs, "doc_id", "label", 3, "folds").cache()
    rows = rows_of(docs)
    x, _ = plain_vectors(rows)
    fold = {r.doc_id: r.fold for r in placed.collect()}
    assert sum(r.rows for r in found.values()) == 93
    assert linear.svm_cross_validate(docs, folds=3, alpha=0.02) == pytest.approx(np.mean([r.accuracy for r in found.values()]))
    for f, r in found.items():
        outside = [i for i, d in enumerate(rows) if fold[d[0]] != f]
        inside = [i for i, d in enumerate(rows) if fold[d[0]] == f]
        y = np.array([1.0 if d[1] else -1.0 for d in rows])
        s = Setting("hinge", 0.02)
        w, t = np.zeros(x.shape[1]), 0
        for t in range(6000):
            z = y[outside] * (x[outside] @ w)
            w -= (1 / (0.02 * (t + 100))) * (-(x[outside].T @ (y[outside] * (z < 1))) / len(outside) + 0.02 * w)
        margins = x[inside] @ w
        close = np.abs(margins) < 0.05
        right = (margins > 0) == (y[inside] > 0)
        assert r.rows == len(inside) and r.is_converged == 1
        assert abs(r.correct - right.sum()) <= close.sum()
        assert plain_loss(w, x[outside], y[outside], s) > 0


def test_a_search_equals_fits_fold_by_fold(docs):
    """Vocabulary, frequencies and training documents of every fold are those outside it."""
    found = linear.svm_grid_search(docs, alphas=[0.3], min_dfs=[1.0, 0.2], folds=2, tolerance=1e-5)
    assert found.count() == 8
    assert found.filter("is_best = 1").count() == 1
    assert [tuple(r) for r in found.select("held_out", "is_converged").distinct().collect()] == [(93, 1)]
    rows = rows_of(docs)
    fold = {r.doc_id: r.fold for r in stratified_folds(docs, "doc_id", "label", 2, "folds").collect()}
    for r in found.collect():
        s, aucs = linear.sgd_setting(r.loss, r.penalty, r.alpha), []
        for f in range(2):
            outside = [d for d in rows if fold[d[0]] != f]
            inside = [d for d in rows if fold[d[0]] == f]
            x, _ = plain_vectors(outside, r.min_df)
            y = np.array([1.0 if d[1] else -1.0 for d in outside])
            w = plain_weights(x, y, s)
            margins = np.round(plain_vectors(inside, r.min_df, outside)[0] @ w, 3)
            up = [m for m, d in zip(margins, inside, strict=True) if d[1]]
            down = [m for m, d in zip(margins, inside, strict=True) if not d[1]]
            aucs.append(np.mean([(a > b) + (a == b) / 2 for a in up for b in down]))
        assert r.mean_auc == pytest.approx(np.mean(aucs), abs=0.02)


def plain_weights(x, y, s, steps=6000):
    w = np.zeros(x.shape[1])
    for t in range(steps):
        z = y * (x @ w)
        pull = 1 / (1 + np.exp(z)) if s.loss == "log" else (z < 1) * 1.0
        step = 1 / (s.l2 * (t + 50))
        w = w - step * (-(x.T @ (y * pull)) / len(y) + s.l2 * w)
        w = np.sign(w) * np.maximum(np.abs(w) - step * s.l1, 0)
    return w


def test_min_df_is_a_count_or_a_share(spark):
    docs = spark.range(40).select(
        F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"),
        F.array(F.lit("common"), F.concat(F.lit("t"), "id"), F.concat(F.lit("u"), F.floor(F.col("id") / 2))).alias("terms"),
    )
    corpus = linear.encode(docs, folds=4)
    assert [(corpus.idf(m) > 0).sum() for m in (1.0, 2.0, 0.5)] == [61, 21, 1]
    assert corpus.sizes.sum() == 40
    # Outside a fold, terms of its documents only are unknown.
    assert (corpus.idf(1.0, 0) > 0).sum() < 61
    numbers = corpus.terms.orderBy("term").select("id").toPandas()["id"].tolist()
    assert numbers == list(range(61))


@pytest.mark.parametrize("setting", [Setting("log", 1 / 93), Setting("hinge", 0.02)])
def test_several_blocks_close_the_gap(docs, monkeypatch, setting):
    """Rounds of blocks that do not see each other's changes had not closed the hinge model's gap in 4,000 epochs."""
    monkeypatch.setattr(dual, "BLOCK_ROWS", 25)
    corpus = linear.encode(docs)
    assert corpus.blocks.count() > 2
    passes, one = [], dual._pass
    monkeypatch.setattr(dual, "_pass", lambda *a: passes.append(a[2].shape[1]) or one(*a))
    model = linear._fit(corpus, setting)
    assert 0 < len(passes) < 200 and set(passes) == {1}
    assert linear.optimum(model, docs).first().is_optimal == 1


def test_the_driver_holds_few_models_at_once(docs, monkeypatch):
    """Models beyond the bound are fitted one group after the other and mean the same; a small vocabulary is numbered anew."""
    settings = [Setting("log", 0.05), Setting("hinge", 0.3, 0.05), Setting("hinge", 0.3), Setting("log", 0.05, held=1)]
    monkeypatch.setattr(dual, "BLOCK_ROWS", 35)
    corpus = linear.encode(docs, folds=3)
    known = [corpus.documents] * 3 + [int(corpus.documents - corpus.sizes[1])]
    idf = corpus.idf(0.3)
    whole = dual.fit_many(corpus.blocks, idf, settings, known, 1e-2)
    small, idf = dual.narrowed(corpus.blocks, idf), idf[idf > 0]
    assert 0 < len(idf) < len(corpus.df)
    monkeypatch.setattr(dual, "MOST_NUMBERS", 2 * (len(idf) + 1))
    widths, one = [], dual._pass
    monkeypatch.setattr(dual, "_pass", lambda *a: widths.append(a[2].shape) or one(*a))
    parted = dual.fit_many(small, idf, settings, known, 1e-2)
    # Three models without an L1 penalty, two of them at once.
    assert {w for _, w in widths} == {1, 2} and {terms for terms, _ in widths} == {len(idf) + 1}
    assert parted.converged.all() and whole.converged.all()
    assert np.allclose(parted.primal, whole.primal, rtol=2e-2)
    assert [parted.duals(m).count() for m in range(4)] == [93] * 4


def test_no_documents_and_one_class(spark):
    for rows in ([], [(1, 1, ["a"]), (2, 1, ["a", "b"]), (3, None, ["a"])]):
        docs = spark.createDataFrame(rows, DOCS)
        with warnings.catch_warnings():
            warnings.simplefilter("error", UserWarning)
            model = linear.logistic_fit(docs)
        assert linear.linear_predict(model, docs).count() == len(rows)
        assert linear.optimum(model, docs).first().is_optimal == 1


def test_a_round_is_one_scan_of_the_blocks(spark, docs, monkeypatch):
    """All models of a call share a round."""
    corpus = linear.encode(docs)
    rounds = []
    one = dual._rounds
    monkeypatch.setattr(dual, "_rounds", lambda *a: rounds.append(len(a[2].n)) or one(*a))
    dual.fit_many(corpus.blocks, corpus.idf(), SETTINGS, [corpus.documents] * 5, 1e-3)
    assert set(rounds) == {5} and len(rounds) < 12


@pytest.mark.parametrize("setting", [Setting("log", 1 / 93), Setting("hinge", 0.02), Setting("hinge", 0.02, held=1)])
def test_one_large_block_makes_its_steps_in_one_task(docs, monkeypatch, setting):
    """Every pass had been a job of its own beyond a block of 5,000 documents."""
    monkeypatch.setattr(dual, "EPOCH_ROWS", 10)
    corpus = linear.encode(docs, folds=3)
    assert corpus.blocks.count() == 1
    for name in ("_pass", "_rounds"):
        monkeypatch.setattr(dual, name, lambda *a: pytest.fail("a job for a step"))
    known = corpus.documents - (0 if setting.held is None else int(corpus.sizes[setting.held]))
    fit = dual.fit_many(corpus.blocks, corpus.idf(), [setting], [known])
    assert fit.converged.all() and -1e-12 < fit.gap[0] <= dual.TOLERANCE and fit.duals().count() == 93
    if setting.held is None:
        assert linear.optimum(linear._fit(corpus, setting), docs).first().is_optimal == 1


def no_jobs(monkeypatch):
    for name in ("_pass", "_rounds"):
        monkeypatch.setattr(dual, name, lambda *a: pytest.fail("a job for a step"))


@pytest.mark.parametrize("setting", [Setting("log", 0.02, 0.01), Setting("hinge", 0.02, 0.01), Setting("hinge", 0.002, 0.0004)])
def test_elastic_nets_make_their_steps_in_one_task(docs, monkeypatch, setting):
    """Models with an L1 penalty took epochs over single documents, which did not end on 15,000 of them."""
    monkeypatch.setattr(dual, "EPOCH_ROWS", 10)
    corpus = linear.encode(docs)
    no_jobs(monkeypatch)
    fit = dual.fit_many(corpus.blocks, corpus.idf(), [setting], [corpus.documents], 1e-6)
    assert fit.converged.all() and -1e-12 < fit.gap[0] <= 1e-6
    rows = rows_of(docs)
    x, _ = plain_vectors(rows)
    y = np.array([1.0 if label else -1.0 for _, label, _ in rows])
    assert fit.dual[0] - 1e-9 <= plain_fit(x, y, setting, 4000) and (fit.weights[:, 0] == 0).any()
    assert linear.optimum(linear._fit(corpus, setting), docs).first().is_optimal == 1


def test_documents_in_many_blocks_are_fitted_in_one_task(docs, monkeypatch):
    """Beyond one block every pass had been a job that sent a number per term to every task and back; blocks are small now."""
    for name, most in (("EPOCH_ROWS", 10), ("PIECE_ROWS", 20), ("FILE_PIECES", 1)):
        monkeypatch.setattr(dual, name, most)
    corpus = linear.encode(docs)
    assert corpus.blocks.count() > 3 and len(corpus.blocks.inputFiles()) == corpus.blocks.count()
    assert corpus.blocks.agg(F.sum("documents"), F.max("documents")).first()[0:2] <= (93, 20)
    no_jobs(monkeypatch)
    for setting in (Setting("log", 1 / 93), Setting("hinge", 0.02), Setting("hinge", 0.3, 0.05)):
        model = linear._fit(corpus, setting)
        assert model.duals.count() == 93 and linear.optimum(model, docs).first().is_optimal == 1


def test_documents_encoded_by_block_are_the_same(spark, docs, monkeypatch):
    """Documents' terms had been shuffled one by one; documents that share a key still share their terms."""

    def plain(corpus):
        terms = {r.id: r.term for r in corpus.terms.collect()}
        found = {}
        for r in corpus.blocks.collect():
            ends, ids, tfs = (np.frombuffer(r[c], k) for c, k in (("ends", "i8"), ("ids", "i4"), ("tfs", "f4")))
            own = zip(r.keys, np.frombuffer(r.labels, "i1"), np.frombuffer(r.folds, "i4"), np.r_[0, ends[:-1]], ends, strict=True)
            for key, label, fold, a, b in own:
                counts = sorted((terms[i], float(t)) for i, t in zip(ids[a:b], tfs[a:b], strict=True))
                found.setdefault(key, []).append((int(label), int(fold), counts))
            assert (r.documents, r.entries) == (len(r.keys), len(ids))
        frequencies = {terms[i]: (int(corpus.df[i]), corpus.held[:, i].tolist()) for i in terms}
        return found, frequencies, corpus.documents, corpus.sizes.tolist()

    by_row = linear.encode(docs, folds=3)
    monkeypatch.setattr(linear, "FEW_ROWS", 10)
    shared, one = [], linear._coded_by_row
    monkeypatch.setattr(linear, "_coded_by_row", lambda *a: shared.append(1) or one(*a))
    by_block = linear.encode(docs, folds=3)
    assert not shared and plain(by_block) == plain(by_row)
    assert plain(by_block)[0][90] == [(1, plain(by_row)[0][90][0][1], [])]
    for more in (docs.limit(3), docs.limit(1).withColumn("doc_id", F.lit(None).cast("long"))):
        linear.encode(docs.unionByName(more))
    assert len(shared) == 2


def test_searches_hold_no_weights_on_the_driver(docs, monkeypatch):
    """All models' weights had been collected to score the documents left out; tasks score them now."""
    usual = linear.svm_fold_accuracies(docs, folds=3, alpha=0.3).orderBy("fold").collect()
    searched = linear.svm_grid_search(docs, alphas=[0.3], min_dfs=[1.0], folds=2).orderBy("loss", "penalty").collect()
    monkeypatch.setattr(dual, "EPOCH_ROWS", 10)
    monkeypatch.setattr(dual, "fit_many", lambda *a: pytest.fail("weights on the driver"))
    found = linear.svm_fold_accuracies(docs, folds=3, alpha=0.3).orderBy("fold").collect()
    assert [(r.fold, r.rows, r.is_converged) for r in found] == [(r.fold, r.rows, 1) for r in usual]
    assert [r.accuracy for r in found] == pytest.approx([r.accuracy for r in usual], abs=0.07)
    again = linear.svm_grid_search(docs, alphas=[0.3], min_dfs=[1.0], folds=2).orderBy("loss", "penalty").collect()
    assert [tuple(r)[:4] + tuple(r)[5:7] for r in again] == [tuple(r)[:4] + tuple(r)[5:7] for r in searched]
    assert [r.mean_auc for r in again] == pytest.approx([r.mean_auc for r in searched], abs=0.03)
