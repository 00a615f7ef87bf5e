"""Language of a text by sparse multinomial logistic regression on TF-IDF character n-grams.

Features: letters in lower case, every run of anything else one space; grams of 1 to 3 of these are counted into
2**15 places, and a text is (1 + ln count) * idf of each place, scaled to length 1.  Document frequencies
cover all documents that may be learned from.

Model: fitted on at most ``FIT_ROWS`` labelled rows and five more for each language (small languages whole, equal shares of the
rest for the others; no language is left out), by follow-the-regularised-leader with elastic-net penalties, a place at a time with its own step; the L1
part keeps weights sparse.  A fifth of these rows is left out of the fit and sets the temperature, which makes the scores
probabilities.

Null texts and texts without a letter are ``und`` with score 0; if there is nothing to learn from, all are.
A null doc_id is predicted but not learned from; a null lang is not learned from; repeated rows count each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentimill.llm.common import is_held_out, map_batches
from sentimill.llm.text_features import CHUNK, class_sample, document_frequencies, gram_places, inverse, learnable

BITS = 15
PLACES = 1 << BITS
FIT_ROWS = 3000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
UNDETERMINED = "und"

_OTHER = re.compile(r"[\W\d_]+")


def has_letter(text: str) -> bool:
    """Letters only: superscripts, fractions and numerals of any kind are none."""
    return any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """Counts of the places of the text's grams."""
    counts = np.zeros(PLACES, dtype=np.int64)
    for at in range(0, len(text), CHUNK):
        plain = _OTHER.sub(" ", text[at : at + CHUNK].lower())
        codes = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for places in gram_places(codes, 3, BITS):
            counts += np.bincount(places, minlength=PLACES)
    return counts


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # places seen in training by language, the last row is the constant
    idf: np.ndarray
    temperature: float = 1.0
    rows: np.ndarray | None = None  # of each place its row of the weights; -1 for places not seen in training

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        counts = gram_counts(text)
        places = np.flatnonzero(counts)
        values = (1.0 + np.log(counts[places])) * self.idf[places]
        return places, (values / max(1e-12, np.sqrt(values @ values))).astype(np.float32)

    def scores(self, text: str) -> np.ndarray:
        return self.of_features(*self.features(text))

    def of_features(self, places: np.ndarray, values: np.ndarray) -> np.ndarray:
        rows = self.rows[places]
        return values[rows >= 0] @ self.weights[rows[rows >= 0]] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        p = _softmax(self.scores(text) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, size: int) -> np.ndarray:
    """Weights by follow-the-regularised-leader, a row at a time; the rows' places are numbers of seen ones, ``size`` in all."""
    z = np.zeros((size + 1, classes))
    n = np.zeros((size + 1, classes))

    def weights(places: np.ndarray) -> np.ndarray:
        zp, root = z[places], np.sqrt(n[places])
        shrunk = np.sign(zp) * np.maximum(np.abs(zp) - L1, 0)
        return -shrunk / ((BETA + root) / ALPHA + L2)

    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            places, values = rows[i]
            places, values = np.r_[places, size], np.r_[values, 1.0]
            w = weights(places)
            error = _softmax(values @ w)
            error[labels[i]] -= 1.0
            gradient = values[:, None] * error[None, :]
            before = n[places]
            n[places] = before + gradient * gradient
            step = (np.sqrt(n[places]) - np.sqrt(before)) / ALPHA
            z[places] += gradient - step * w
    return weights(np.arange(size + 1)).astype(np.float32)


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss."""
    choices = np.exp(np.linspace(np.log(0.05), np.log(20.0), 121))
    loss = [-np.log(_softmax(scores / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in choices]
    return float(choices[int(np.argmin(loss))])


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Learn from the text and lang of the documents outside the held-out third."""
    known = learnable(docs).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = known.select("doc_id", "lang", "text", F.xxhash64("text").alias("hash"))
    # Ids and hashes are drawn; the written draw is small or not by Spark's own check.
    drawn = class_sample(hashed.select("doc_id", "lang", "hash"), "lang", rows)
    met = hashed.join(drawn, ["doc_id", "lang", "hash"]).groupBy("doc_id", "lang", "hash").agg(F.min("text").alias("text"))
    sample = sorted((row["lang"], row["text"]) for row in met.select("lang", "text").collect() if has_letter(row["text"]))
    languages = sorted({lang for lang, _ in sample})
    total, frequencies = document_frequencies(known, gram_counts, PLACES)
    model = Model(languages, np.zeros((1, len(languages)), np.float32), inverse(total, frequencies), rows=np.full(PLACES, -1, np.int32))
    if not languages:
        return model
    labels = np.array([languages.index(lang) for lang, _ in sample])
    features = [model.features(text) for _, text in sample]
    kept = np.arange(len(sample)) % 5 == 4
    fitted = np.flatnonzero(~kept)
    seen = np.unique(np.concatenate([features[i][0] for i in fitted]))
    model.rows[seen] = np.arange(len(seen))
    model.weights = _ftrl([(model.rows[features[i][0]], features[i][1]) for i in fitted], labels[fitted], len(languages), len(seen))
    if kept.any():
        scores = np.array([model.of_features(*features[i]) for i in np.flatnonzero(kept)])
        model.temperature = _temperature(scores, labels[kept])
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            found = [model.predict(text) for text in frame.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    frame.column("doc_id"), frame.column("held_out"),
                    pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out().alias("held_out"), "text")
    return map_batches(columns, batches, "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents whose language is determined with a score of at least ``least``."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            found = [model.predict(text) for text in frame.column("text").to_pylist()]
            yield frame.filter(pa.array([lang != UNDETERMINED and score >= least for lang, score in found], pa.bool_()))

    return map_batches(docs, batches, docs.schema)
