"""Severity of toxic language by cumulative-link ordinal regression on sparse word features.

Grades: a document labelled not toxic has grade 0.  Labels only say toxic or not, so the grade of a toxic document (1 to 3) is
the third it falls into by the sum of ln(1 + count) of its cues; cues are known terms whose share of toxic documents
is at least ``CUE_RATIO`` times their share of the others.

Model: P(grade > j) = logistic(w . x - threshold_j) with one weight vector for all thresholds, and thresholds in order.  x is
ln(1 + count) of the known terms, words and word beginnings.  Known are the terms of the sample whose log-likelihood ratio between toxic and
other documents is at least ``EVIDENCE``.  It is fitted by the likelihood of the grades, whose terms are differences of neighbouring P(grade > j),
with an L1 penalty, which leaves only words with evidence, on at most ``FIT_ROWS`` labelled rows (and five more a class at most; an equal share of each label),
outside the held-out third.  The equal share is undone in the thresholds' weights, so probabilities are those of the corpus.

Severity is the expected grade, the sum of P(grade > j), from 0 to 3; ``toxic`` is 1 if P(grade > 0) is at least 0.5.
The model sent to tasks holds the words of the sample only, so its size is bounded.

Null and empty texts have no words and get the severity of the thresholds alone.  Null labels, and labels of documents
without an id, are not learned from; without labels of both kinds every severity is 0.  A repeated label counts once, and of texts
with one id a single one is learned from; repeated rows have a severity each; a null doc_id is scored;
other columns are not read.
"""

from __future__ import annotations

import re
import warnings
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentimill.llm.common import is_held_out, map_batches
from sentimill.llm.text_features import labelled_sample, learnable

FIT_ROWS = 6000
BEGINNINGS = (4, 5)
EVIDENCE = 25.0
CUE_RATIO = 8.0
L1 = 1e-4
#: The fit ends when no slope of the penalised loss is above this, a tenth of the penalty, or with a warning after so many steps.
SLOPE = 1e-5
MOST_STEPS = 5000
GRADES = 3

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def terms(counts: Counter) -> Counter:
    """Words and word beginnings (``abcd~``) with their counts."""
    found = Counter(counts)
    for word, n in counts.items():
        for size in BEGINNINGS:
            if len(word) > size:
                found[word[:size] + "~"] += n
    return found


def _evidence(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int) -> np.ndarray:
    """Log-likelihood ratio of a term being in a of size_a and in b of size_b documents at different rates."""
    pooled = (a + b) / (size_a + size_b)
    total = np.zeros(len(a))
    for seen, expected in (
        (a, size_a * pooled), (size_a - a, size_a * (1 - pooled)), (b, size_b * pooled), (size_b - b, size_b * (1 - pooled)),
    ):
        total += np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)
    return 2 * total


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = (np.inf,) * GRADES

    def above(self, text: str) -> np.ndarray:
        """P(grade > j) for each threshold j."""
        known = self.weights
        counts = terms(Counter(words(text)))
        value = sum(known[w] * np.log1p(n) for w, n in counts.items() if w in known)
        with np.errstate(over="ignore"):
            return 1.0 / (1.0 + np.exp(np.array(self.thresholds) - value))


class _Sparse:
    """Rows of (column, value), with products both ways."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], columns: int) -> None:
        self.row = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows])
        self.column = np.concatenate([c for c, _ in rows]) if rows else np.zeros(0, np.int64)
        self.value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)
        self.shape = len(rows), columns

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], self.shape[0])

    def transposed_times(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * r[self.row], self.shape[1])


def _log1pexp(t: np.ndarray) -> np.ndarray:
    return np.maximum(t, 0.0) + np.log1p(np.exp(-np.abs(t)))


def _sigmoid(t: np.ndarray) -> np.ndarray:
    return np.exp(-_log1pexp(-t))


def thresholds_of(shape: np.ndarray) -> np.ndarray:
    """The first threshold, and the logarithms of the steps to the others."""
    return np.cumsum(np.r_[shape[:1], np.exp(shape[1:])])


def ordinal_loss(values: np.ndarray, theta: np.ndarray, grades: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The cumulative-link likelihood: mean of -ln P(grade), its slopes by value (a row each) and by threshold.

    P(grade = j) is the difference of neighbouring terms, P(grade > j - 1) - P(grade > j).
    """
    edges = np.r_[-np.inf, theta, np.inf]
    a, b = values - edges[grades], values - edges[grades + 1]
    upper, lower = _sigmoid(a), _sigmoid(b)
    step = edges[grades + 1] - edges[grades]
    # upper - lower, without the difference of near numbers
    apart = -np.expm1(-step)
    inner = np.isfinite(step)
    loss = _log1pexp(-a) + _log1pexp(b) - np.where(inner, np.log(np.where(inner, apart, 1.0)), 0.0)
    by_value = weight * (upper + lower - 1.0)
    share = np.where(inner, apart, 1.0)
    # Quotients of logistic terms; those beyond the first and the last threshold are 1.
    to_lower = weight * np.exp(_log1pexp(b) - _log1pexp(a)) / share
    to_upper = -weight * np.exp(_log1pexp(-a) - _log1pexp(-b)) / share
    slopes = np.bincount(grades, to_lower, len(edges))[1:-1] + np.bincount(grades + 1, to_upper, len(edges))[1:-1]
    return float((weight * loss).sum()), by_value, slopes


def _fit_ordinal(x: _Sparse, grades: np.ndarray, row_weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds of the largest penalised likelihood.

    Accelerated proximal gradient steps with backtracking, until no slope of the penalised loss is above ``SLOPE``.
    """
    weight = row_weights / row_weights.sum()
    over = np.array([(weight * (grades > j)).sum() for j in range(GRADES)])
    start = np.clip(over, 1e-6, 1 - 1e-6)
    theta = np.log((1 - start) / start)
    shape = np.r_[theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))]
    columns = x.shape[1]
    # Each place has a step of its own: a diagonal that dominates the curvature by value, which is 1/2 at most.
    reach = np.bincount(x.row, np.abs(x.value), x.shape[0]) + 1.0
    bent = np.bincount(x.column, np.abs(x.value) * (weight * reach)[x.row], columns)
    scale = np.r_[1.0 / (0.5 * np.maximum(bent, 1e-9)), np.full(GRADES, 1.0 / (0.5 * (weight * reach).sum()))]
    penalty = np.r_[np.full(columns, L1), np.zeros(GRADES)]

    def loss(at: np.ndarray) -> tuple[float, np.ndarray]:
        edges = thresholds_of(at[columns:])
        value, by_value, by_edge = ordinal_loss(x.times(at[:columns]), edges, grades, weight)
        # A threshold moves with every step before it.
        later = np.cumsum(by_edge[::-1])[::-1]
        return value, np.r_[x.transposed_times(by_value), later[0], later[1:] * np.exp(at[columns + 1 :])]

    now = np.r_[np.zeros(columns), shape]
    ahead, pace, length = now, 1.0, 1.0
    for _ in range(MOST_STEPS):
        value, slope = loss(ahead)
        while True:
            moved = ahead - length * scale * slope
            new = np.sign(moved) * np.maximum(np.abs(moved) - length * scale * penalty, 0.0)
            change = new - ahead
            bound = value + slope @ change + (change * change / scale).sum() / (2 * length)
            if length < 1e-9 or loss(new)[0] <= bound + 1e-12:
                break
            length /= 2
        steepest = np.abs(change / (length * scale)).max(initial=0.0)
        if steepest <= SLOPE:
            return new[:columns], thresholds_of(new[columns:])
        if change @ (new - now) < 0:
            pace = 1.0  # the last push went the wrong way
        new_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, now, pace, length = new + (pace - 1) / new_pace * (new - now), new, new_pace, length * 1.1
    warnings.warn(f"the steepest slope is {steepest:.1e} after {MOST_STEPS} steps", stacklevel=2)
    return now[:columns], thresholds_of(now[columns:])


def fit_texts(sample: list[tuple[int, str]], prior: float) -> Model:
    """A model from (toxic, text) rows; ``prior`` is the share of toxic documents in the corpus."""
    labels = np.array([label for label, _ in sample])
    if not len(sample) or labels.min() == labels.max():
        return Model()
    counted = [terms(Counter(words(text))) for _, text in sample]
    frequency: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for label, counts in zip(labels.tolist(), counted, strict=True):
        frequency[label].update(counts.keys())
    sizes = {label: int((labels == label).sum()) for label in (0, 1)}
    names = sorted(frequency[0].keys() | frequency[1].keys())
    clean, toxic = (np.array([frequency[label][w] for w in names], dtype=float) for label in (0, 1))
    telling = _evidence(toxic, clean, sizes[1], sizes[0]) >= EVIDENCE
    vocabulary = {names[i]: at for at, i in enumerate(np.flatnonzero(telling))}
    more_often = (toxic + 0.5) / sizes[1] >= CUE_RATIO * (clean + 0.5) / sizes[0]
    cues = {names[i] for i in np.flatnonzero(telling & more_often)}
    cued = np.array([sum(np.log1p(c[w]) for w in cues if w in c) for c in counted])
    cuts = np.quantile(cued[labels == 1], [1 / 3, 2 / 3])
    grades = np.where(labels == 1, 1 + (cued[:, None] > cuts[None, :]).sum(axis=1), 0)
    rows = []
    for counts in counted:
        known = [(vocabulary[w], n) for w, n in counts.items() if w in vocabulary]
        rows.append((np.array([i for i, _ in known], dtype=np.int64), np.log1p(np.array([n for _, n in known], dtype=float))))
    row_weights = np.where(labels == 1, prior / sizes[1], (1 - prior) / sizes[0])
    w, theta = _fit_ordinal(_Sparse(rows, len(vocabulary)), grades, row_weights)
    return Model({word: float(w[i]) for word, i in vocabulary.items() if w[i]}, tuple(theta.tolist()))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    marks = learnable(labels).filter(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("label"))
    shares = {row["label"]: row["count"] for row in marks.groupBy("label").count().collect()}
    if len(shares) < 2:
        return Model()
    return fit_texts(labelled_sample(docs, marks, "label", rows), shares[1] / sum(shares.values()))


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, severity (0 to 3), grade (the likeliest) and toxic of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**shared.value)
        for frame in frames:
            texts = frame.column("text").to_pylist()
            above = np.array([known.above(text or "") for text in texts]).reshape(len(texts), GRADES)
            each = -np.diff(np.c_[np.ones(len(texts)), above, np.zeros(len(texts))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    frame.column("doc_id"), frame.column("held_out"), pa.array(above.sum(axis=1)),
                    pa.array(each.argmax(axis=1).astype(np.int32)), pa.array((above[:, 0] >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "severity", "grade", "toxic"],
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out().alias("held_out"), "text")
    return map_batches(columns, batches, "doc_id long, held_out boolean, severity double, grade int, toxic int")
