"""Linear classifiers on TF-IDF vectors: fits to a closed duality gap, scoring, cross-validation and searches.

A fitted model is a table of terms, so scoring is the same join as for Naive Bayes and no vocabulary is needed in one place.  Fitting keeps one
number per term and model on the driver; ``min_df`` says which terms there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimill.operators import dual
from sentimill.operators.dual import HINGE, LOG, Setting
from sentimill.operators.features import dictionary, known_terms, term_counts
from sentimill.operators.metrics import auc_by_group
from sentimill.plans.cuts import stratified_folds
from sentimill.plans.skew import lookup
from sentimill.plans.staging import stage
from sentimill.plans.term_blocks import found_in, pack, sums_by_term

#: The relative gap of models that are only compared with each other.
SEARCH_TOLERANCE = 1e-3
#: The most epochs spent on them; ``is_converged`` and a warning tell when they did not do.
SEARCH_EPOCHS = 1000
SVM_ALPHA = 0.0001
#: Up to so many documents are encoded row by row.
FEW_ROWS = 5000


@dataclass(frozen=True)
class Corpus:
    """Labelled documents as blocks of coded rows, and their terms: term, id, df and held (documents of each fold that have it)."""

    blocks: DataFrame
    terms: DataFrame
    df: np.ndarray
    held: np.ndarray  # fold by term
    documents: int
    sizes: np.ndarray  # documents of each fold

    def idf(self, min_df: float = 1.0, fold: int | None = None) -> np.ndarray:
        """Smoothed inverse document frequencies outside a fold; 0 for a term that is not in the vocabulary.

        ``min_df``: 1 or more is a count, below 1 a share of the documents.
        """
        n = self.documents - (self.sizes[fold] if fold is not None else 0)
        df = self.df - (self.held[fold] if fold is not None else 0)
        least = min_df if min_df >= 1 else min_df * n
        return np.where((df >= least) & (df > 0), np.log((n + 1.0) / (df + 1.0)) + 1.0, 0.0)


def encode(docs: DataFrame, key: str = "doc_id", label: str = "label", folds: int = 0, seed: str = "folds") -> Corpus:
    """Number the terms and write the documents' counts as blocks; with ``folds``, documents are dealt to stratified folds."""
    placed = docs.select(key, F.col(label).alias("label"), "terms").filter(F.col("label").isin(0, 1))
    if folds:
        placed = stratified_folds(placed, key, "label", folds, seed)
    else:
        placed = placed.withColumn("fold", F.lit(0))
    placed = placed.withColumn("fold", F.col("fold").cast("int"))
    sizes = np.zeros(max(1, folds), dtype=np.int64)
    for row in placed.groupBy("fold").count().collect():
        sizes[row["fold"]] = row["count"]
    total = int(sizes.sum())
    by_block = total > FEW_ROWS and placed.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull()).isEmpty()
    terms, blocks = (_coded_by_block if by_block else _coded_by_row)(placed, key, max(1, folds), total)
    known = terms.select("id", "df", "held").toArrow()
    order = np.argsort(known.column("id").to_numpy())
    frequencies = np.array(known.column("held").combine_chunks().flatten()).reshape(len(order), max(1, folds))[order].T
    return Corpus(blocks, terms, known.column("df").to_numpy()[order], frequencies, total, sizes)


def _coded_by_row(placed: DataFrame, key: str, folds: int, total: int) -> tuple[DataFrame, DataFrame]:
    """The terms and the blocks of few documents, or of documents that share keys: these share their terms too."""
    placed = stage(placed, "documents")
    postings = term_counts(placed, key, ["fold"])
    held = F.array(*[F.count_if(F.col("fold") == f) for f in range(folds)]).alias("held")
    terms = stage(dictionary(postings.groupBy("term").agg(F.count("*").alias("df"), held)), "dictionary")
    coded = lookup(postings, terms.select("term", "df", "id"), ["term"], "df", [key])
    counted = coded.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("id", "tf"))).alias("_terms"))
    none = F.array().cast("array<struct<id:int,tf:bigint>>")
    rows = placed.select(key, "label", "fold").join(counted, key, "left").withColumn("_terms", F.coalesce("_terms", none))
    rows = rows.select(key, "label", "fold", F.col("_terms.id").alias("ids"), F.col("_terms.tf").alias("tfs"))
    return terms, dual.blocks(stage(rows, "coded"), key, total)


def _coded_by_block(placed: DataFrame, key: str, folds: int, total: int) -> tuple[DataFrame, DataFrame]:
    """The same by block: what is shuffled is a block's different terms, not its documents' terms."""
    inside = [f"_in{f}" for f in range(folds)]
    dealt = placed.withColumns({c: (F.col("fold") == f).cast("int") for f, c in enumerate(inside)})
    packed = pack(dealt, [key, "label", "fold", *inside], is_whole=True)
    counts = sums_by_term(packed, inside).select(
        "term", sum((F.col(c) for c in inside[1:]), F.col(inside[0])).alias("df"), F.array(*inside).alias("held")
    )
    terms = stage(dictionary(counts), "dictionary")
    schema = dual.block_schema(placed.schema[key].dataType.simpleString())
    shape = T.StructType(T._parse_datatype_string(schema).fields[1:])
    rows = found_in(packed.of([key, "label", "fold"]), terms.select("term", "id"), dual.coded, shape, is_whole=True)
    numbered = rows.select(F.monotonically_increasing_id().cast("string").alias("block"), "*")
    return terms, stage(numbered, "blocks", most_rows=dual.FILE_PIECES)


@dataclass(frozen=True)
class LinearModel:
    """``terms``: term, idf and weight; ``duals``: key and dual of the documents of the fit (see ``dual``)."""

    setting: Setting
    terms: DataFrame
    intercept: float
    duals: DataFrame


def logistic_setting(rows: int, c: float = 1.0) -> Setting:
    """L2 logistic regression where ``c`` weighs the summed loss of ``rows`` documents."""
    return Setting(LOG, 1.0 / (c * max(rows, 1)))


# Fixed value: the part of an elastic net that is L1.
ELASTIC_SHARE = 0.15


def sgd_setting(loss: str, penalty: str, alpha: float) -> Setting:
    """The model of a loss ('hinge' or 'log') and a penalty ('l2' or 'elasticnet') of weight ``alpha``."""
    if loss not in (HINGE, LOG) or penalty not in ("l2", "elasticnet"):
        raise ValueError(f"unknown loss or penalty: {loss}, {penalty}")
    share = ELASTIC_SHARE if penalty == "elasticnet" else 0.0
    return Setting(loss, alpha * (1.0 - share), alpha * share)


def _fit(corpus: Corpus, setting: Setting, min_df: float = 1.0, most_epochs: int = dual.MOST_EPOCHS) -> LinearModel:
    idf = corpus.idf(min_df)
    fit = dual.fit_many(corpus.blocks, idf, [setting], [corpus.documents], most_epochs=most_epochs)
    spark = corpus.terms.sparkSession
    used = np.flatnonzero(idf > 0)
    numbers = pa.table({"id": pa.array(used, pa.int32()), "idf": idf[used], "weight": fit.weights[used, 0]})
    weights = spark.createDataFrame(numbers)
    terms = stage(corpus.terms.select("term", "id").join(weights, "id").select("term", "idf", "weight"), "linear-terms")
    return LinearModel(setting, terms, float(fit.weights[-1, 0]), stage(fit.duals(), "linear-duals"))


def logistic_fit(
    docs: DataFrame, c: float = 1.0, key: str = "doc_id", label: str = "label", corpus: Corpus | None = None
) -> LinearModel:
    """Fit on ``terms`` and ``label``; ``corpus``: the documents where they are encoded already."""
    corpus = corpus or encode(docs, key, label)
    return _fit(corpus, logistic_setting(corpus.documents, c))


def svm_fit(
    docs: DataFrame, alpha: float = SVM_ALPHA, key: str = "doc_id", label: str = "label", corpus: Corpus | None = None
) -> LinearModel:
    """Hinge loss with L2 penalty ``alpha``."""
    return _fit(corpus or encode(docs, key, label), sgd_setting(HINGE, "l2", alpha))


def linear_predict(model: LinearModel, docs: DataFrame, keep: Sequence[str] = ("doc_id", "label"), key: str = "doc_id") -> DataFrame:
    """``keep``, the predicted class, the margin and, for a log loss, the probability of class 1; every document is scored."""
    weight = F.col("tf") * F.col("idf")
    sums = (
        known_terms(term_counts(docs, key), model.terms, key)
        .groupBy(key)
        .agg((F.sum(weight * F.col("weight")) / F.sqrt(F.sum(weight * weight))).alias("_sum"))
    )
    margin = F.lit(model.intercept) + F.coalesce("_sum", F.lit(0.0))
    columns = list(dict.fromkeys([key, *keep]))
    scored = docs.select(*columns).join(sums, key, "left").withColumn("margin", margin)
    found = scored.select(*keep, (F.col("margin") > 0).cast("int").alias("predicted"), "margin")
    return found.withColumn("proba", 1 / (1 + F.exp(-F.col("margin")))) if model.setting.loss == LOG else found


def optimum(
    model: LinearModel, docs: DataFrame, key: str = "doc_id", label: str = "label", tolerance: float = 2 * dual.TOLERANCE
) -> DataFrame:
    """``documents, terms, relative_gap, is_optimal``: the duality gap, worked out anew from the model's weights and dual values.

    Nothing of the solver is used: the primal value comes from scoring ``docs`` (those of the fit), the lower bound from their vectors summed
    with the dual values.  A model that was not trained has a gap of 1.
    """
    setting = model.setting
    sign = F.when(F.col(label) == 1, 1.0).otherwise(-1.0)
    scored = stage(
        linear_predict(model, docs, [key, label], key).join(model.duals.withColumnRenamed("key", key), key).select(
            key, (F.col("margin") * sign).alias("z"), (F.col("dual") * sign).alias("pull"), F.col("dual").alias("a")
        ),
        "margins",
    )
    n = F.count("*")
    z, a = F.col("z"), F.col("a")
    if setting.loss == LOG:
        loss = F.greatest(-z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        part = lambda x: F.when(x > 0, -x * F.log(x)).otherwise(0.0)
        gain = part(a) + part(1 - a)
    else:
        loss, gain = F.greatest(1 - z, F.lit(0.0)), a
    sums = scored.agg(
        n.alias("n"), F.avg(loss).alias("loss"), F.avg(gain).alias("gain"), F.avg("pull").alias("pull"),
        F.min(F.when((a >= 0) & (a <= 1), 1).otherwise(0)).alias("valid"),
    ).first()
    found = known_terms(term_counts(docs, key), model.terms, key).withColumn("x", F.col("tf") * F.col("idf"))
    lengths = found.groupBy(key).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    pulled = found.join(scored.select(key, "pull").join(lengths, key), key)
    v = pulled.groupBy("term").agg((F.sum(F.col("pull") * F.col("x") / F.col("length")) / F.lit(float(sums["n"] or 1))).alias("v"))
    bent = F.greatest(F.abs("v") - F.lit(setting.l1), F.lit(0.0))
    square = v.agg(F.sum(bent * bent)).first()[0] or 0.0
    square += max(abs(sums["pull"] or 0.0) - setting.l1, 0.0) ** 2
    own = model.terms.agg(F.sum(F.col("weight") * F.col("weight")), F.sum(F.abs("weight")), F.count("*")).first()
    size = (own[0] or 0.0) + model.intercept**2, (own[1] or 0.0) + abs(model.intercept)
    primal = (sums["loss"] or 0.0) + setting.l2 / 2 * size[0] + setting.l1 * size[1]
    bound = (sums["gain"] or 0.0) - square / (2 * setting.l2)
    gap = (primal - bound) / primal if primal else 0.0
    return docs.sparkSession.createDataFrame(
        [(sums["n"], own[2], float(gap), int(gap <= tolerance and sums["valid"] != 0))],
        "documents bigint, terms bigint, relative_gap double, is_optimal int",
    )


# Model selection -----------------------------------------------------------------------------


def svm_fold_accuracies(
    docs: DataFrame, folds: int = 10, alpha: float = SVM_ALPHA, key: str = "doc_id", label: str = "label", seed: str = "folds"
) -> DataFrame:
    """``fold, rows, correct, accuracy, is_converged``: features made before the folds, the models of all folds fitted in one pass."""
    corpus = encode(docs, key, label, folds, seed)
    setting = sgd_setting(HINGE, "l2", alpha)
    settings = [Setting(setting.loss, setting.l2, setting.l1, fold) for fold in range(folds)]
    tasks = docs.sparkSession.sparkContext.defaultParallelism
    margins, converged = dual.held_out(
        corpus.blocks, corpus.idf(), settings, corpus.documents - corpus.sizes, SEARCH_TOLERANCE, SEARCH_EPOCHS, tasks
    )
    right = F.count_if((F.col("margin") > 0) == (F.col("label") == 1))
    found = margins.groupBy(F.col("model").alias("fold")).agg(F.count("*").alias("rows"), right.alias("correct"))
    ends = docs.sparkSession.createDataFrame([(f, int(c)) for f, c in enumerate(converged)], "fold int, is_converged int")
    return found.join(ends, "fold").select(
        "fold", "rows", "correct", (F.col("correct") / F.col("rows")).alias("accuracy"), "is_converged"
    )


def svm_cross_validate(docs: DataFrame, folds: int = 10, alpha: float = SVM_ALPHA, **columns: str) -> float:
    """Mean held-out accuracy."""
    return svm_fold_accuracies(docs, folds, alpha, **columns).agg(F.avg("accuracy")).first()[0]


# Settings searched by default (fixed values).
SVM_ALPHAS = (0.0001, 0.001, 0.01, 0.05, 0.1)
SVM_MIN_DF = (1.0, 0.05, 0.1)
LR_C = (0.001, 1.0, 0.9, 0.1, 0.05)
SVM_LOSSES, SVM_PENALTIES = (HINGE, LOG), ("l2", "elasticnet")


def _search(
    corpus: Corpus, folds: int, min_dfs: Sequence[float], settings: Sequence, parallelism: int, tolerance: float
) -> list[tuple[int, float, float, int, bool]]:
    """(setting, min_df, mean AUC, held-out documents, whether all folds converged).

    A fold's vocabulary and frequencies are those of the documents outside it, so every (fold, min_df) has vectors of its own; all settings of one are
    fitted in one pass.  ``settings``: functions from the number of training documents to a ``Setting``.
    """
    spaces = [(fold, min_df) for min_df in min_dfs for fold in range(folds)]
    tasks = -(-2 * corpus.blocks.sparkSession.sparkContext.defaultParallelism // folds)
    in_tasks = dual.fits_task(corpus.blocks)

    def fitted(space: tuple[int, float]) -> tuple[DataFrame, np.ndarray]:
        fold, min_df = space
        n = int(corpus.documents - corpus.sizes[fold])
        own = [make(n) for make in settings]
        own = [Setting(s.loss, s.l2, s.l1, fold) for s in own]
        idf, blocks = corpus.idf(min_df, fold), corpus.blocks
        if 2 * (idf > 0).sum() < len(idf):
            idf, blocks = idf[idf > 0], dual.narrowed(blocks, idf)
        margins, converged = dual.held_out(blocks, idf, own, [n] * len(own), tolerance, SEARCH_EPOCHS, tasks)
        return stage(margins.select("*", F.lit(fold).alias("fold"), F.lit(float(min_df)).alias("min_df")), "held"), converged

    def at_once(min_df: float) -> int:
        """Spaces fitted side by side: unless tasks do, the driver holds a few numbers for every term and model of each."""
        if in_tasks:
            return parallelism
        most = max(int((corpus.idf(min_df, fold) > 0).sum()) for fold in range(folds)) * len(settings)
        return max(1, min(parallelism, 2 * dual.MOST_NUMBERS // max(1, most)))

    found = []
    for min_df in min_dfs:
        with ThreadPoolExecutor(at_once(min_df)) as pool:
            found += pool.map(fitted, [space for space in spaces if space[1] == min_df])
    scored = found[0][0]
    for more, _ in found[1:]:
        scored = scored.unionByName(more)
    # The solver's last digits must not decide between two documents.
    scored = scored.withColumn("score", F.round("margin", 9))
    aucs = auc_by_group(scored, "label", "score", ["model", "min_df", "fold"])
    rows = scored.groupBy("model", "min_df").agg(F.count("*").alias("n"))
    means = aucs.groupBy("model", "min_df").agg(F.avg("auc").alias("auc")).join(rows, ["model", "min_df"]).collect()
    ended = {(m, min_df): True for m in range(len(settings)) for min_df in min_dfs}
    for (_, min_df), (_, converged) in zip(spaces, found, strict=True):
        for m, closed in enumerate(converged):
            ended[m, min_df] &= bool(closed)
    return [(r["model"], r["min_df"], r["auc"], r["n"], ended[r["model"], r["min_df"]]) for r in means]


def _flag_best(found: DataFrame, *settings: str) -> DataFrame:
    """Add ``is_best``: the highest metric, then the smallest settings.  One row per setting."""
    best = found.agg(F.min_by(F.struct(*settings), F.struct(-F.round("mean_auc", 6), *settings))).scalar()
    return found.withColumn("is_best", (F.struct(*settings) == best).cast("int"))


def svm_grid_search(
    docs: DataFrame,
    alphas: Sequence[float] = SVM_ALPHAS,
    min_dfs: Sequence[float] = SVM_MIN_DF,
    folds: int = 5,
    key: str = "doc_id",
    label: str = "label",
    seed: str = "folds",
    parallelism: int = 8,
    tolerance: float = SEARCH_TOLERANCE,
) -> DataFrame:
    """``loss, penalty, alpha, min_df, mean_auc, held_out, is_converged, is_best`` of every setting."""
    names = [(loss, penalty, alpha) for loss in SVM_LOSSES for penalty in SVM_PENALTIES for alpha in alphas]
    make = [lambda n, name=name: sgd_setting(*name) for name in names]
    found = _search(encode(docs, key, label, folds, seed), folds, [float(m) for m in min_dfs], make, parallelism, tolerance)
    rows = [(*names[model], min_df, auc, n, int(closed)) for model, min_df, auc, n, closed in found]
    schema = "loss string, penalty string, alpha double, min_df double, mean_auc double, held_out bigint, is_converged int"
    return _flag_best(docs.sparkSession.createDataFrame(rows, schema), "loss", "penalty", "alpha", "min_df")


def lr_grid_search(
    docs: DataFrame,
    cs: Sequence[float] = LR_C,
    folds: int = 5,
    key: str = "doc_id",
    label: str = "label",
    seed: str = "folds",
    parallelism: int = 8,
    tolerance: float = SEARCH_TOLERANCE,
) -> DataFrame:
    """``c, mean_auc, held_out, is_converged, is_best``."""
    make = [lambda n, c=c: logistic_setting(n, c) for c in cs]
    found = _search(encode(docs, key, label, folds, seed), folds, [1.0], make, parallelism, tolerance)
    rows = [(float(cs[model]), auc, n, int(closed)) for model, _, auc, n, closed in found]
    return _flag_best(
        docs.sparkSession.createDataFrame(rows, "c double, mean_auc double, held_out bigint, is_converged int"), "c"
    )


def lr_refit(docs: DataFrame, searched: DataFrame) -> LinearModel:
    """Logistic regression on all of ``docs`` with the best setting of a search."""
    return logistic_fit(docs, searched.filter("is_best = 1").first()["c"])


def svm_refit(docs: DataFrame, searched: DataFrame) -> LinearModel:
    best = searched.filter("is_best = 1").first()
    return _fit(encode(docs), sgd_setting(best["loss"], best["penalty"], best["alpha"]), best["min_df"])


def save_linear(model: LinearModel, path: str) -> None:
    """Write the model as three tables below ``path``."""
    model.terms.write.parquet(f"{path}/terms")
    model.duals.write.parquet(f"{path}/duals")
    s = model.setting
    model.terms.sparkSession.createDataFrame(
        [(s.loss, s.l2, s.l1, model.intercept)], "loss string, l2 double, l1 double, intercept double"
    ).write.parquet(f"{path}/setting")


def load_linear(spark: SparkSession, path: str) -> LinearModel:
    row = spark.read.parquet(f"{path}/setting").first()
    tables = (spark.read.parquet(f"{path}/{name}") for name in ("terms", "duals"))
    terms, duals = tables
    return LinearModel(Setting(row["loss"], row["l2"], row["l1"]), terms, row["intercept"], duals)
