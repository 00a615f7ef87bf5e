"""Quality of a text by votes of its nearest labelled texts in a latent-semantic space.

Terms: the outline of a text (small letters x, capitals X, digits d, other marks as they are, runs of letters one), in
grams of 1 to 4; and of its words, those equal to the word before, those seen before, and the rest, which count
``WORD_WEIGHT`` times.  Terms are
counted into a fixed number of places and weighed by TF-IDF with document frequencies of all documents that may be
learned from.  A singular value decomposition of at most ``FIT_ROWS`` labelled rows (and five more a class at most; an
equal share of each label) gives the latent space; the vectors of those rows are sent to all tasks, so the
broadcast is bounded by that number.

Score: the exact cosine of a document with every labelled vector, in blocks; the ``NEIGHBOURS`` nearest vote with their
cosine as weight.  A document none of them resembles has the share of label 1 among all labels.

Null texts count as empty.  Labels that are null, or of documents without an id or in the held-out third, are not learned
from; a label repeated for a document counts once in the vectors, and of texts with one id a single one does; without labels all scores are 0.5.  A null doc_id is scored; other columns are
not read.
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
from sentimill.llm.text_features import CHUNK, document_frequencies, gram_places, inverse, labelled_sample, learnable

BITS = 12
GRAMS = 1 << BITS
PLACES = GRAMS + 3
FIT_ROWS = 4000
RANK = 48
NEIGHBOURS = 25
WORD_WEIGHT = 4.0

_OUTLINE = bytes(
    ord("x") if chr(b).islower() else ord("X") if chr(b).isupper() else ord("d") if chr(b).isdigit() else b
    for b in range(128)
) + bytes(128)
_BEYOND = bytes(range(128, 256))
_RUN = re.compile(rb"x{2,}|X{2,}|d{2,}")


def term_counts(text: str) -> np.ndarray:
    counts = np.zeros(PLACES, dtype=np.int64)
    raw = text.encode("utf-8", "surrogatepass")
    for at in range(0, len(raw), CHUNK):
        outline = _RUN.sub(lambda m: m.group()[:1], raw[at : at + CHUNK].translate(_OUTLINE, _BEYOND))
        codes = np.frombuffer(outline, dtype=np.uint8).astype(np.uint32)
        for places in gram_places(codes, 4, BITS):
            counts[:GRAMS] += np.bincount(places, minlength=GRAMS)
    words = raw.split()
    same = sum(map(bytes.__eq__, words, words[1:]))
    again = len(words) - len(set(words)) - same
    counts[GRAMS:] = same, max(0, again), len(words) - same - max(0, again)
    return counts


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray  # place by rank
    vectors: np.ndarray  # labelled rows by rank, of length 1
    labels: np.ndarray
    prior: float

    def weighed(self, texts: list[str]) -> np.ndarray:
        rows = np.array([term_counts(text) for text in texts], dtype=np.float32).reshape(-1, PLACES)
        rows = np.log1p(rows) * self.idf
        rows[:, GRAMS:] *= WORD_WEIGHT
        return rows / np.maximum(1e-12, np.sqrt((rows * rows).sum(axis=1, keepdims=True)))

    def place(self, texts: list[str]) -> np.ndarray:
        latent = self.weighed(texts) @ self.axes
        return latent / np.maximum(1e-12, np.sqrt((latent * latent).sum(axis=1, keepdims=True)))

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), self.prior)
        cosines = self.place(texts) @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(0.0, np.take_along_axis(cosines, near, axis=1).astype(np.float64))
        total = weight.sum(axis=1)
        votes = (weight * self.labels[near]).sum(axis=1)
        return np.clip(np.where(total > 0, votes / np.maximum(total, 1e-300), self.prior), 0.0, 1.0)


def _axes(rows: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors by subspace iteration."""
    rank = min(rank, *rows.shape)
    basis = np.random.default_rng(0).standard_normal((rows.shape[1], min(rank + 16, *rows.shape))).astype(np.float32)
    for _ in range(5):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    _, _, turn = np.linalg.svd(rows @ basis, full_matrices=False)
    return np.ascontiguousarray((basis @ turn.T)[:, :rank])


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    texts = learnable(docs).select("doc_id", "text")
    marks = learnable(labels).filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("label"))
    shares = {row["label"]: row["count"] for row in marks.groupBy("label").count().collect()}
    prior = shares.get(1, 0) / sum(shares.values()) if shares else 0.5
    sample = labelled_sample(texts, marks, "label", rows) if shares else []
    n, frequencies = document_frequencies(texts, term_counts, PLACES)
    empty = np.zeros((0, RANK), np.float32)
    model = Model(inverse(n, frequencies), np.zeros((PLACES, RANK), np.float32), empty, np.zeros(0), prior)
    if sample:
        weighed = model.weighed([text for _, text in sample])
        model.axes = _axes(weighed, RANK)
        model.vectors = model.place([text for _, text in sample])
        model.labels = np.array([label for label, _ in sample], dtype=np.float64)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**shared.value)
        for frame in frames:
            scores = known.score([text or "" for text in frame.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    frame.column("doc_id"), frame.column("held_out"), pa.array(scores, pa.float64()),
                    pa.array((scores >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out().alias("held_out"), "text")
    return map_batches(columns, batches, "doc_id long, held_out boolean, score double, predicted int")
