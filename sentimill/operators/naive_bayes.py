"""Naive Bayes as counts: fitting is one grouping by term, scoring one by document.

Fitting runs its jobs at once and leaves the counts per term as a written
table; only class sizes and sums, a handful of numbers, come to the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import inf, log

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimill.operators.features import counted_terms, idf, known_terms, once, term_counts, tfidf, vocabulary, within_df
from sentimill.operators.metrics import auc_by_group
from sentimill.plans.cuts import stratified_folds
from sentimill.plans.skew import lookup
from sentimill.plans.staging import stage
from sentimill.plans.term_blocks import Blocks, Found, found_by_block, found_in, sums_by_term
from sentimill.plans.term_table import TermTable, fits_broadcast

# Functions that run inside tasks travel with them, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BERNOULLI, MULTINOMIAL = "bernoulli", "multinomial"


@dataclass(frozen=True)
class NaiveBayesModel:
    """A row per vocabulary term and the start score of each class.

    ``terms``: ``term, df, idf, log_p0, log_p1`` and, for the Bernoulli form,
    ``log_not0, log_not1``.  A start score is the log prior plus, for Bernoulli,
    what a document without any term adds.
    """

    kind: str
    terms: DataFrame
    start0: float
    start1: float

    def params(self) -> DataFrame:
        """Long form: ``class, term, log_prob``."""
        return self.terms.select(
            "term", F.expr("stack(2, 0, log_p0, 1, log_p1) AS (class, log_prob)")
        ).select("class", "term", "log_prob")


def _class_sizes(docs: DataFrame, label: str) -> tuple[int, int]:
    sizes = docs.agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    return sizes[0], sizes[1]


# Log odds of the class shares; a class that a training part lacks is ruled out.
_PRIOR_ODDS = """CASE WHEN n0 = 0 AND n1 = 0 THEN 0D WHEN n1 = 0 THEN double('-Infinity')
WHEN n0 = 0 THEN double('Infinity') ELSE ln(n1 / n0) END"""


def _log_prior(n: int, total: int) -> float:
    """Log of a class share; minus infinity for an absent class."""
    return log(n / total) if n else -inf


def bernoulli_nb_fit(
    docs: DataFrame,
    alpha: float = 1.0,
    min_df: int | float = 1,
    max_df: int | float = 1.0,
    key: str = "doc_id",
    label: str = "label",
) -> NaiveBayesModel:
    """Fit on term presence; ``docs`` has ``key``, ``label`` (0/1) and the array ``terms``."""
    n0, n1 = _class_sizes(docs, label)
    counted = (
        docs.select(label, F.explode(F.array_distinct("terms")).alias("term"))
        .groupBy("term")
        .agg(
            F.count("*").alias("df"),
            F.count_if(F.col(label) == 0).alias("n_t0"),
            F.count_if(F.col(label) == 1).alias("n_t1"),
        )
    )
    return _bernoulli_model(counted, n0, n1, alpha, min_df, max_df)


#: Key columns of blocks that ``bernoulli_nb_fit_blocks`` reads: how often a document is in the training part, and how often as either class.
TRAIN, TRAIN0, TRAIN1 = "train_n", "train_n0", "train_n1"


def bernoulli_nb_fit_blocks(
    blocks: Blocks, n0: int, n1: int, alpha: float = 1.0, min_df: int | float = 1, max_df: int | float = 1.0
) -> NaiveBayesModel:
    """``bernoulli_nb_fit`` of documents that are packed with ``TRAIN``, ``TRAIN0`` and ``TRAIN1``; ``n0`` and ``n1`` are the class sizes."""
    counted = sums_by_term(blocks, [TRAIN, TRAIN0, TRAIN1])
    return _bernoulli_model(counted.toDF("term", "df", "n_t0", "n_t1"), n0, n1, alpha, min_df, max_df)


def _bernoulli_model(counted: DataFrame, n0: int, n1: int, alpha: float, min_df: int | float, max_df: int | float) -> NaiveBayesModel:
    """The model of ``term, df, n_t0, n_t1``."""
    n = F.lit(n0 + n1)
    kept = stage(counted.filter(within_df(F.col("df"), n, min_df, max_df)), "term-counts")
    p0 = (F.col("n_t0") + alpha) / (n0 + 2 * alpha)
    p1 = (F.col("n_t1") + alpha) / (n1 + 2 * alpha)
    terms = kept.select(
        "term",
        "df",
        idf(F.col("df"), n).alias("idf"),
        F.log(p0).alias("log_p0"),
        F.log(p1).alias("log_p1"),
        F.log(1 - p0).alias("log_not0"),
        F.log(1 - p1).alias("log_not1"),
    )
    base = terms.agg(F.sum("log_not0"), F.sum("log_not1")).first()
    return NaiveBayesModel(
        BERNOULLI,
        terms,
        _log_prior(n0, n0 + n1) + (base[0] or 0.0),
        _log_prior(n1, n0 + n1) + (base[1] or 0.0),
    )


def multinomial_nb_fit(
    docs: DataFrame,
    alpha: float = 1.0,
    min_df: int | float = 2,
    max_df: int | float = 0.95,
    key: str = "doc_id",
    label: str = "label",
) -> NaiveBayesModel:
    """Fit on the TF-IDF weight each term has in each class."""
    n0, n1 = _class_sizes(docs, label)
    n = F.lit(n0 + n1)
    postings = term_counts(docs, key, [label])
    vocab = stage(vocabulary(postings, n, min_df, max_df), "vocabulary")

    def in_class(value: int) -> Column:
        return F.sum(F.when(F.col(label) == value, F.col("weight")).otherwise(0.0))

    summed = stage(
        tfidf(postings, vocab, n, key)
        .groupBy("term")
        .agg(F.count("*").alias("df"), in_class(0).alias("s_t0"), in_class(1).alias("s_t1")),
        "term-weights",
    )
    totals = summed.agg(F.sum("s_t0"), F.sum("s_t1"), F.count("*")).first()
    s0, s1, v = totals[0] or 0.0, totals[1] or 0.0, totals[2]
    terms = summed.select(
        "term",
        "df",
        idf(F.col("df"), n).alias("idf"),
        F.log((F.col("s_t0") + alpha) / (s0 + alpha * v)).alias("log_p0"),
        F.log((F.col("s_t1") + alpha) / (s1 + alpha * v)).alias("log_p1"),
    )
    return NaiveBayesModel(
        MULTINOMIAL, terms, _log_prior(n0, n0 + n1), _log_prior(n1, n0 + n1)
    )


def _added(block: Found) -> list[pa.Array]:
    """Key and evidence of the documents with a known term."""
    sums = [block.summed(block.values[name][block.cols]) for name in ("a0", "a1")]
    any_known = pa.array(np.unique(block.docs))
    return [block.keys[0].take(any_known), *(pa.array(a).take(any_known) for a in sums)]


def _evidence(model: NaiveBayesModel, docs: DataFrame, key: str, blocks: Blocks | None = None) -> DataFrame:
    """``key, e0, e1``: what the known terms of a document add to each class score.

    For the Bernoulli form the terms are looked up block by block of documents, so no document's terms are shuffled;
    ``blocks``, if given, are the documents packed with ``key`` as first key.
    """
    if model.kind == BERNOULLI:
        # A NULL adds nothing.
        values = [F.coalesce(F.col(f"log_p{c}") - F.col(f"log_not{c}"), F.lit(0.0)).alias(f"a{c}") for c in (0, 1)]
        schema = T.StructType([docs.schema[key], T.StructField("e0", T.DoubleType()), T.StructField("e1", T.DoubleType())])
        table = model.terms.select("term", *values)
        found = found_by_block(docs, [key], table, _added, schema) if blocks is None else found_in(blocks, table, _added, schema)
        return found.groupBy(key).agg(F.sum("e0").alias("e0"), F.sum("e1").alias("e1"))
    found = known_terms(term_counts(docs, key), model.terms, key)
    weight = F.col("tf") * F.col("idf")
    length = F.sqrt(F.sum(weight * weight))
    return found.groupBy(key).agg(
        (F.sum(weight * F.col("log_p0")) / length).alias("e0"),
        (F.sum(weight * F.col("log_p1")) / length).alias("e1"),
    )


def _evidence_in_row(model: NaiveBayesModel, docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns, e0, e1``, found inside each document's row: nothing is shuffled."""
    if model.kind == BERNOULLI:
        values = {"a0": F.col("log_p0") - F.col("log_not0"), "a1": F.col("log_p1") - F.col("log_not1")}
    else:
        values = {"a0": F.col("idf") * F.col("log_p0"), "a1": F.col("idf") * F.col("log_p1"), "idf": F.col("idf")}
    table = TermTable(model.terms, values)

    def added(found: Column, value: Callable[[Column], Column]) -> Column:
        return F.aggregate(found, F.lit(0.0), lambda so_far, x: so_far + value(x))

    def sums(found: Column) -> Column:
        if model.kind == BERNOULLI:
            return F.struct(added(found, lambda x: x["a0"]).alias("e0"), added(found, lambda x: x["a1"]).alias("e1"))
        length = F.sqrt(added(found, lambda x: x["tf"] * x["idf"] * x["tf"] * x["idf"]))
        weighed = [(added(found, lambda x, a=a: x["tf"] * x[a]) / length).alias(f"e{a[1]}") for a in ("a0", "a1")]
        return F.when(F.size(found) > 0, F.struct(*weighed))

    evidence = once(table.found(counted_terms(F.col("terms"))), sums)
    return docs.select(*columns, evidence.alias("_e")).select(*columns, "_e.e0", "_e.e1")


def nb_predict(
    model: NaiveBayesModel, docs: DataFrame, key: str = "doc_id", keep: Sequence[str] = (), blocks: Blocks | None = None
) -> DataFrame:
    """``key``, ``keep``, ``score0, score1, predicted, proba``; every document is scored.

    ``proba`` is the probability of class 1; equal scores give class 0.  A model that Spark's broadcast limit allows is
    looked up inside the documents' rows, a larger one is joined by term.  ``blocks``: the documents packed with
    ``key`` as first key, if they are; a Bernoulli model of any size is then looked up there, and ``docs`` needs no terms.
    """
    if blocks is None and fits_broadcast(model.terms):
        found = _evidence_in_row(model, docs, [key, *keep])
    else:
        # Two numbers a document, written: whatever reads the scores again does not work the terms out again.
        found = docs.select(key, *keep).join(stage(_evidence(model, docs, key, blocks), "evidence"), key, "left")
    scored = found.select(
        key,
        *keep,
        (F.lit(model.start0) + F.coalesce("e0", F.lit(0.0))).alias("score0"),
        (F.lit(model.start1) + F.coalesce("e1", F.lit(0.0))).alias("score1"),
    )
    return scored.withColumns(
        {
            "predicted": (F.col("score1") > F.col("score0")).cast("int"),
            "proba": 1 / (1 + F.exp(F.col("score0") - F.col("score1"))),
        }
    )


def nb_predict_proba(model: NaiveBayesModel, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Probability of both classes."""
    return nb_predict(model, docs, key).select(
        key, (1 - F.col("proba")).alias("proba0"), F.col("proba").alias("proba1")
    )


def score_reviews(
    model: NaiveBayesModel, reviews: DataFrame, key: str = "doc_id", text: str = "text", blocks: Blocks | None = None
) -> DataFrame:
    """The ``entries`` table: the reviews' columns with predicted score, sentiment and probability; ``blocks`` as in ``nb_predict``."""
    keep = [c for c in reviews.columns if c not in (key, "terms", "label")]
    return nb_predict(model, reviews, key, keep, blocks).select(
        key,
        *keep,
        F.col("predicted").alias("predicted_score"),
        F.when(F.col("predicted") == 1, 1).otherwise(-1).alias("predicted_sentiment"),
        F.col("proba").alias("predicted_proba"),
    )


def negative_reviews(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("predicted_score") == 0)


# Model selection -----------------------------------------------------------------------------


def _fold_counts(postings: DataFrame, label: str, folds: int) -> DataFrame:
    """Per term, documents of each class in each fold: ``df, c0, c1`` (arrays by fold)."""

    def by_fold(value: int) -> Column:
        return F.array(
            *[F.count_if((F.col(label) == value) & (F.col("fold") == f)) for f in range(folds)]
        )

    return postings.groupBy("term").agg(
        F.count("*").alias("df"), by_fold(0).alias("c0"), by_fold(1).alias("c1")
    )


def _held_out(counts: str, fold: str) -> Column:
    """Documents outside a fold."""
    return F.expr(f"aggregate({counts}, 0L, (acc, x) -> acc + x) - get({counts}, {fold})")


def _fold_sizes(docs: DataFrame, label: str, folds: int) -> DataFrame:
    """Training documents per class when a fold is held out: ``fold, n0, n1``; one row per fold."""
    inside = docs.groupBy("fold").agg(
        F.count_if(F.col(label) == 0).alias("i0"), F.count_if(F.col(label) == 1).alias("i1")
    )
    total = docs.agg(
        F.count_if(F.col(label) == 0).alias("a0"), F.count_if(F.col(label) == 1).alias("a1")
    )
    a0, a1 = total.select("a0").scalar(), total.select("a1").scalar()
    every = docs.sparkSession.range(folds).select(F.col("id").cast("int").alias("fold"))
    return every.join(F.broadcast(inside), "fold", "left").select(
        "fold",
        (a0 - F.coalesce("i0", F.lit(0))).alias("n0"),
        (a1 - F.coalesce("i1", F.lit(0))).alias("n1"),
    )


def _configurations(
    alphas: Sequence[float], min_dfs: Sequence[int | float], max_dfs: Sequence[int | float]
) -> list[tuple[float, int | float, int | float]]:
    return [(a, lo, hi) for a in alphas for lo in min_dfs for hi in max_dfs]


def _fold_scores(
    docs: DataFrame,
    configs: Sequence[tuple[float, int | float, int | float]],
    folds: int,
    key: str,
    label: str,
) -> DataFrame:
    """``config, fold, key, label, margin`` of every held-out document under every setting.

    All folds and settings come from one counting of the terms: the counts
    outside a fold are the totals less the counts in it.  The document side
    stays one row per term until it is grouped by document, and only then
    fans out into one value per setting.
    """
    postings = term_counts(docs, key, [label, "fold"])
    counts = stage(_fold_counts(postings, label, folds), "fold-counts")
    sizes = stage(_fold_sizes(docs, label, folds), "fold-sizes")  # one row per fold

    def kept(lo: int | float, hi: int | float) -> str:
        """Vocabulary of the training part; whole numbers are counts, fractions are shares."""
        low, high = (f"{b}" if isinstance(b, int) else f"{b!r}D * (n0 + n1)" for b in (lo, hi))
        return f"t0 + t1 > 0 AND t0 + t1 >= {low} AND t0 + t1 <= {high}"

    def log_odds(alpha: float) -> tuple[str, str]:
        """What a present and what an absent term add to the margin."""
        p0, p1 = (f"((t{c} + {alpha!r}D) / (n{c} + 2 * {alpha!r}D))" for c in (0, 1))
        return f"ln({p1}) - ln({p0})", f"ln(1 - {p1}) - ln(1 - {p0})"

    alphas = {a: i for i, a in enumerate(sorted({a for a, _, _ in configs}))}

    def config_sums(values: str) -> Column:
        """Per setting, the value of its alpha summed over the terms of its vocabulary."""
        sums = [
            f"coalesce(sum(CASE WHEN {kept(lo, hi)} THEN {values}{alphas[a]} END), 0D)"
            for a, lo, hi in configs
        ]
        return F.expr(f"array({', '.join(sums)})")

    # Vocabulary side: what absent terms add, per fold and setting.
    held_out = ["fold", _held_out("c0", "fold").alias("t0"), _held_out("c1", "fold").alias("t1")]
    per_fold = (
        counts.select("c0", "c1", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold"))
        .select(*held_out)
        .join(F.broadcast(sizes), "fold")
    )
    absent = [F.expr(f"{log_odds(a)[1]} AS b{i}") for a, i in alphas.items()]
    base = per_fold.select("*", *absent).groupBy("fold").agg(config_sums("b").alias("base"))
    offsets = sizes.join(F.broadcast(base), "fold", "left").select(
        "fold",
        F.expr(f"transform(base, b -> b + {_PRIOR_ODDS})").alias("start"),
    )

    # Document side: one narrow row per term travels to its document.
    found = (
        lookup(postings, counts, ["term"], "df", [key])
        .select(key, *held_out)
        .repartition(key)
        .join(F.broadcast(sizes), "fold")
    )
    gained = [
        F.expr(f"({log_odds(a)[0]}) - ({log_odds(a)[1]}) AS g{i}") for a, i in alphas.items()
    ]
    gains = found.select("*", *gained).groupBy(key).agg(config_sums("g").alias("gain"))
    scored = docs.select(key, label, "fold").join(gains, key, "left").join(
        F.broadcast(offsets), "fold"
    )
    margins = F.expr("transform(start, (s, i) -> s + coalesce(get(gain, i), 0D))")
    return scored.select("fold", key, label, F.posexplode(margins).alias("config", "margin"))


def cross_validate(
    docs: DataFrame,
    folds: int = 10,
    alpha: float = 1.0,
    key: str = "doc_id",
    label: str = "label",
    seed: str = "folds",
) -> DataFrame:
    """``fold, rows, correct, accuracy, mean_accuracy`` over stratified folds, all in one job.

    The vocabulary is the one of all the documents given, as when the features
    are made before the folds; terms absent from a training part count zero.
    """
    placed = stratified_folds(docs, key, label, folds, seed)
    scored = _cross_scores(placed, folds, alpha, key, label)
    per_fold = scored.groupBy("fold").agg(
        F.count("*").alias("rows"),
        F.count_if((F.col("margin") > 0) == (F.col(label) == 1)).alias("correct"),
    )
    accuracy = per_fold.withColumn("accuracy", F.col("correct") / F.col("rows"))
    mean = accuracy.agg(F.avg("accuracy")).scalar()
    return accuracy.withColumn("mean_accuracy", mean)


def _cross_scores(
    docs: DataFrame, folds: int, alpha: float, key: str, label: str
) -> DataFrame:
    """Held-out margin per document with the vocabulary of all documents."""
    postings = term_counts(docs, key, [label, "fold"])
    counts = stage(_fold_counts(postings, label, folds), "fold-counts")
    sizes = stage(_fold_sizes(docs, label, folds), "fold-sizes")

    def outside(rows: DataFrame) -> DataFrame:
        picked = rows.withColumns(
            {"t0": _held_out("c0", "fold"), "t1": _held_out("c1", "fold")}
        )
        joined = picked.drop("c0", "c1").join(F.broadcast(sizes), "fold")
        p0 = (F.col("t0") + alpha) / (F.col("n0") + 2 * alpha)
        p1 = (F.col("t1") + alpha) / (F.col("n1") + 2 * alpha)
        return joined.withColumns(
            {
                "seen": F.log(p1) - F.log(p0),
                "unseen": F.log(1 - p1) - F.log(1 - p0),
            }
        )

    every_fold = F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold")
    base = outside(counts.select("c0", "c1", every_fold)).groupBy("fold").agg(
        F.sum("unseen").alias("base")
    )
    offsets = sizes.join(F.broadcast(base), "fold").select(
        "fold", (F.expr(_PRIOR_ODDS) + F.col("base")).alias("start")
    )
    gains = (
        outside(lookup(postings, counts, ["term"], "df", [key]))
        .groupBy(key)
        .agg(F.sum(F.col("seen") - F.col("unseen")).alias("gain"))
    )
    return (
        docs.select(key, label, "fold")
        .join(gains, key, "left")
        .join(F.broadcast(offsets), "fold")
        .withColumn("margin", F.col("start") + F.coalesce("gain", F.lit(0.0)))
    )


# Settings searched by default (fixed values).
GRID_ALPHAS = (0.001, 0.1, 1.0, 0.9, 0.78, 0.5, 0.16, 0.4)
GRID_MIN_DF = (1, 0.05, 0.1)
GRID_MAX_DF = (1.0, 0.83, 0.95)


def nb_grid_search(
    docs: DataFrame,
    alphas: Sequence[float] = GRID_ALPHAS,
    min_dfs: Sequence[int | float] = GRID_MIN_DF,
    max_dfs: Sequence[int | float] = GRID_MAX_DF,
    folds: int = 5,
    key: str = "doc_id",
    label: str = "label",
    seed: str = "folds",
) -> DataFrame:
    """``alpha, min_df, max_df, mean_auc, is_best``: mean held-out ROC-AUC of every setting.

    Scores are rounded to 12 places before ranking, so that the order in which
    logs were added up never decides between two documents.
    """
    configs = _configurations(alphas, min_dfs, max_dfs)
    placed = stratified_folds(docs, key, label, folds, seed)
    scored = _fold_scores(placed, configs, folds, key, label).withColumn(
        "score", F.round(1 / (1 + F.exp(-F.col("margin"))), 12)
    )
    aucs = auc_by_group(scored, label, "score", ["config", "fold"])
    means = aucs.groupBy("config").agg(F.round(F.avg("auc"), 6).alias("mean_auc"))
    settings = docs.sparkSession.createDataFrame(
        [(i, float(a), float(lo), float(hi)) for i, (a, lo, hi) in enumerate(configs)],
        "config int, alpha double, min_df double, max_df double",
    )
    table = settings.join(means, "config")
    # One row per setting, so the best one is found by a plain aggregate.
    best = table.agg(
        F.min_by("config", F.struct(-F.col("mean_auc"), "alpha", "min_df", "max_df"))
    ).scalar()
    return table.select(
        "alpha", "min_df", "max_df", "mean_auc", (F.col("config") == best).alias("is_best")
    )
