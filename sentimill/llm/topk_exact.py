"""Exact top-k inner products by no-random-access aggregation.

Every component of the vectors is a sorted list (by value, read downwards for a positive query component and upwards
for a negative one).  First all lists are read in step to ``DEPTH``.  A candidate's score is then bounded: entries
read count as they are; an entry not read is at best the value the list stands at, at worst the list's last.
Then reading goes on list by list, those first whose unread rest can move a score most, a few lists at a time; entries of candidates whose upper
bound is below the k-th best lower bound are passed over, for those cannot qualify.  Reading stops for a query when few candidates are
left; only their scores are resolved.  When all lists are read the bounds are the scores themselves.

The bounds of a whole pack of queries at ``DEPTH`` are two products each: of the positive and of the negative query
components with the block's values clipped at the lists' positions.  The k-th best of earlier blocks is a
lower bound from the start, so later blocks are read less far.

Components become floor(256 * x).  Vectors that are null, empty or hold null or non-finite components take no part, nor do
rows with a null vec_id; vectors meet those of their own length only.  Ties go to the smaller vec_id; repeated rows are
candidates each, a row with the query's own id is never one.  Scores are whole numbers; beyond 2**53 they are
computed with Python integers, and beyond the range of a long they are its limit.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from sentimill.llm.vectors import Best, search, usable

K = 5
SCALE = 256
#: Share of all lists that is read in step, and lists that are then read together.
DEPTH = 1 / 2
LISTS = 4
#: So many candidates for each wanted result may be left when reading stops.
LEFT = 16
_EXACT = 2.0**53
_LONG = 2**63 - 1


def _scores_of_any_size(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    products = [[sum(int(a) * int(b) for a, b in zip(q, v, strict=True)) for v in vectors] for q in queries]
    return np.array([[max(-_LONG - 1, min(_LONG, p)) for p in row] for row in products], dtype=np.int64)


def _bounds(up: np.ndarray, down: np.ndarray, vectors: np.ndarray, lists: np.ndarray, depth: int) -> tuple:
    """Upper and lower bounds of all scores when ``depth`` entries of each list have been read."""
    n = len(lists)
    high, low = lists[n - 1 - depth], lists[depth]
    most = up @ np.maximum(vectors, high).T + down @ np.minimum(vectors, low).T
    least = up @ np.where(vectors > high, vectors, lists[0]).T + down @ np.where(vectors < low, vectors, lists[-1]).T
    return most, least


def aggregate(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, best: Best, work: dict[str, int] | None = None) -> None:
    """Add a block's best to ``best``; ``work`` counts entries read and passed over beyond ``DEPTH``, and scores resolved."""
    k = best.k
    if np.abs(queries).max() * np.abs(vectors).max() * vectors.shape[1] >= _EXACT:
        scores = _scores_of_any_size(queries, vectors)
        for q, own in enumerate(best.query_ids):
            best.add(q, scores[q][ids != own], ids[ids != own])
        return
    lists = np.sort(vectors, axis=0)
    depth = int(len(ids) * DEPTH)
    high, low = lists[len(ids) - 1 - depth], lists[depth]
    most, least = _bounds(np.maximum(queries, 0), np.minimum(queries, 0), vectors, lists, depth)
    by_list = np.ascontiguousarray(vectors.T)
    for q, query in enumerate(queries):
        some = np.flatnonzero(ids != best.query_ids[q])
        upper, lower, floor = most[q, some], least[q, some], best.floor(q)
        # The unread part of a list lies between its frontier and its last entry.
        rest = np.where(query > 0, query * (high - lists[0]), query * (low - lists[-1]))
        order, at = np.argsort(-rest, kind="stable"), 0
        while True:
            if len(lower) > k:
                floor = max(floor, np.partition(lower, len(lower) - k)[-k])
            left = upper >= floor
            some, upper, lower = some[left], upper[left], lower[left]
            if len(some) <= LEFT * k or at >= len(order):
                break
            for j in order[at : at + LISTS]:
                value, x = by_list[j][some], query[j]
                if x > 0:
                    upper += x * np.minimum(value - high[j], 0.0)
                    lower += np.where(value > high[j], 0.0, x * (value - lists[0, j]))
                elif x < 0:
                    upper += x * np.maximum(value - low[j], 0.0)
                    lower += np.where(value < low[j], 0.0, x * (value - lists[-1, j]))
            if work is not None:
                work["read"] += len(some) * len(order[at : at + LISTS])
            at += LISTS
        if work is not None:
            work["all"] += len(ids) * len(order)
            work["resolved"] += len(some)
            work["pairs"] += len(ids)
        scores = vectors[some] @ query
        best.add(q, scores.astype(np.int64), ids[some])


def _scaled(scale: int):
    def kernel(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, best: Best) -> None:
        aggregate(np.floor(scale * queries), ids, np.floor(scale * vectors), best)

    return kernel


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` best."""
    return search(usable(vectors), is_query, _scaled(scale), k, "long")
