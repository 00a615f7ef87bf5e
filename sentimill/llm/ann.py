"""Approximate nearest neighbours by collision counting over single projections.

Method: every vector is projected on ``PROJECTIONS`` random directions; each direction is a sorted array of its own.
A query opens a window around its own place in each array.  All windows have the half-width ``WIDTH`` times one radius.  The first radius is
taken from the sorted arrays: windows hold ``FIRST_SHARE`` of the vectors on average.  It grows by a factor (virtual rehashing: nothing is hashed
again, the windows take in what lies next to them).  A vector whose collisions, one for each window it is in, reach the threshold is verified: its
inner product is computed on the original vectors.  A query ends when its k-th best lies within the radius; a later block starts with the
distance of the k-th best of the earlier ones.

A vector at the radius falls into a window with probability 2 * Phi(WIDTH) - 1, so it is verified unless its count of
collisions stays below the threshold, which is set ``MARGIN`` standard deviations below the mean; nearer ones are missed less.  There is no cap on
the number of vectors verified.

Largest inner product becomes nearest point by one more component: with the largest norm M of all vectors, x has
sqrt(M**2 - |x|**2) there and queries have 0.  Vectors that are null, zero, empty or hold null or
non-finite components take no part, nor do rows with a null vec_id; vectors meet those of their own length
only.  Ties go to the smaller vec_id; repeated rows are candidates each, a row with the query's own id is never one; a query
id with several vectors asks with one of them (see ``vectors.search``).
"""

from __future__ import annotations

from math import erf, sqrt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimill.llm.vectors import Best, search, usable

K = 20
PROJECTIONS = 250  # at most 255
WIDTH = 1.6
MARGIN = 0.8
GROWTH = 1.12
FIRST_SHARE = 0.5
#: Arrays that are read at a time, after how many it is seen how many vectors are left, and the share of all that is few.
PART, LOOK, FEW = 10, 50, 4
#: Rows of a block, at most 65,535: the larger it is, the smaller is the share that has to be verified.
BLOCK_ROWS = 1 << 14
SEED = 42


def threshold(projections: int = PROJECTIONS, width: float = WIDTH, margin: float = MARGIN) -> int:
    p = erf(width / sqrt(2))
    return max(1, int(projections * p - margin * sqrt(projections * p * (1 - p))))


def _scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each summed the same way wherever its row stands."""
    return (vectors * query).sum(axis=1)


def sorted_projections(vectors: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """A block's sorted arrays, one for each direction, and where each vector stands in each."""
    n, dim = vectors.shape
    directions = _directions(dim)
    unit = vectors / longest
    last = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1)))
    placed = unit @ directions[:dim] + last[:, None] * directions[dim]
    arrays, stands = np.empty((PROJECTIONS, n)), np.empty((PROJECTIONS, n), dtype=np.uint16)
    for j, one in enumerate(np.ascontiguousarray(placed.T)):
        order = np.argsort(one)
        arrays[j] = one[order]
        # A vector is in a window if this lies between the window's ends.
        stands[j, order] = np.arange(n, dtype=np.uint16)
    return arrays, stands


def _directions(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim + 1, PROJECTIONS))


def count_collisions(
    queries: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    best: Best,
    longest: float,
    work: dict[str, int] | None = None,
    projected: tuple[np.ndarray, np.ndarray] | None = None,
) -> None:
    """Add a block's best to ``best``; ``longest`` is the largest norm of all vectors, ``work`` counts verified pairs and all.

    ``projected``: the block's ``sorted_projections``, if they are known.
    """
    n, dim = vectors.shape
    needed = threshold()
    arrays, stands = sorted_projections(vectors, longest) if projected is None else projected
    norms = np.sqrt((queries * queries).sum(axis=1))
    centres = (queries / norms[:, None]) @ _directions(dim)[:dim]
    scales = norms * longest
    # Nothing can enter the best from beyond what earlier blocks have found.
    known = np.array([np.isfinite(best.floor(q)) for q in range(len(queries))], dtype=bool)
    radii = np.array([_distance(best.floor(q), scales[q]) if known[q] else 0.0 for q in range(len(queries))])
    if not known.all():
        radii[~known] = _first_radii(arrays, centres[~known])
    verified = [ids == own for own in best.query_ids]
    others = [n - int(same.sum()) for same in verified]
    open_ = np.arange(len(queries))
    while len(open_):
        # Queries whose best may lie further off go on with wider windows.
        lower, upper = _windows(arrays, centres[open_], WIDTH * radii[open_])
        for at, q in enumerate(open_):
            found = _collided(stands, lower[:, at], upper[:, at], needed)
            found = found[~verified[q][found]]
            if len(found):
                verified[q][found] = True
                best.add(q, _scores(vectors[found], queries[q]), ids[found])
        # The farthest two vectors are is 2.
        open_ = np.array(
            [q for q in open_ if _distance(best.floor(q), scales[q]) > radii[q] and radii[q] <= 2.0 and not verified[q].all()], dtype=np.int64
        )
        radii[open_] *= GROWTH
    for q in range(len(queries)):
        if not np.isfinite(best.floor(q)):
            # Fewer than k so far: all candidates are results.
            rest = np.flatnonzero(~verified[q])
            verified[q][rest] = True
            best.add(q, _scores(vectors[rest], queries[q]), ids[rest])
        if work is not None:
            work["verified"] += int(verified[q].sum()) - (n - others[q])
            work["pairs"] += others[q]


def _first_radii(arrays: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Each query's radius whose windows hold ``FIRST_SHARE`` of the vectors in half of the sorted arrays."""
    n = arrays.shape[1]
    reach = int(n * FIRST_SHARE / 2)
    widths = np.empty(centres.T.shape)
    for j, (array, c) in enumerate(zip(arrays, centres.T, strict=True)):
        at = np.searchsorted(array, c)
        low, high = array[np.clip(at - reach, 0, n - 1)], array[np.minimum(n - 1, at + reach)]
        widths[j] = np.maximum(np.maximum(c - low, high - c), 0.0)
    return np.maximum(1e-6, np.median(widths, axis=0) / WIDTH)


def _windows(arrays: np.ndarray, centres: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Lower and upper ends of the queries' windows in each array: 2, arrays, queries."""
    found = np.empty((2, len(arrays), len(centres)), dtype=np.int64)
    for j, (array, c) in enumerate(zip(arrays, centres.T, strict=True)):
        found[0, j] = np.searchsorted(array, c - half, "left")
        found[1, j] = np.searchsorted(array, c + half, "right")
    return found


def _collided(stands: np.ndarray, lower: np.ndarray, upper: np.ndarray, needed: int) -> np.ndarray:
    """The vectors that are in ``needed`` of a query's windows or more.

    A few arrays are read at a time.  Once few vectors have not missed too many windows already, only these are looked up in the other arrays.
    """
    # A window of all 65,536 places would have a span of 0; blocks are smaller.
    low, span = lower.astype(np.uint16)[:, None], (upper - lower).astype(np.uint16)[:, None]
    n, spare = stands.shape[1], len(stands) - needed
    missed, space, flags = np.zeros(n, np.uint8), np.empty((PART, n), np.uint16), np.empty((PART, n), bool)
    for begin in range(0, len(stands), PART):
        end = min(begin + PART, len(stands))
        # Unsigned differences wrap round, so one comparison tests both ends.
        np.subtract(stands[begin:end], low[begin:end], out=space[: end - begin])
        np.greater_equal(space[: end - begin], span[begin:end], out=flags[: end - begin])
        missed += np.add.reduce(flags[: end - begin].view(np.uint8), axis=0, dtype=np.uint8)
        if end % LOOK == 0:
            left = np.flatnonzero(missed <= spare)
            if FEW * len(left) < n:
                rest = stands[end:].take(left, axis=1)
                outside = (rest - low[end:]) >= span[end:]
                return left[missed[left] + np.add.reduce(outside.view(np.uint8), axis=0, dtype=np.int64) <= spare]
    return np.flatnonzero(missed <= spare)


def _distance(score: float, scale: float) -> float:
    """The distance at which a vector has this score; so far that it takes in all if there is none."""
    return sqrt(max(0.0, 2 - 2 * score / scale)) * (1 + 1e-9) if np.isfinite(score) else 3.0


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` nearest found."""
    rows = usable(vectors, non_zero=True)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    longest = rows.agg(F.max(norm)).first()[0] or 1.0

    def kernel(
        queries: np.ndarray, ids: np.ndarray, block: np.ndarray, arrays: np.ndarray, stands: np.ndarray, best: Best
    ) -> None:
        count_collisions(queries, ids, block, best, longest, projected=(arrays, stands))

    def prepare(ids: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, ...]:
        return ids, block, *sorted_projections(block, longest)

    return search(rows, is_query, kernel, k, "double", BLOCK_ROWS, prepare)
