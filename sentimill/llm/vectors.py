"""Searches of a stated set of query vectors against all vectors, block by block.

Vectors are packed into blocks of bounded size where they are read; the queries are packed likewise.  Every task
holds a few candidate blocks and meets the query packs one after the other, so a kernel can carry what it
knows of a pack's best from block to block.  What moves is blocks and packs, and the best ``k`` of a pack in a task.
Blocks are dealt to the tasks one by one; where there are fewer blocks than tasks, several tasks hold a block and share the packs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentimill.llm.common import batch_rows
from sentimill.plans.staging import stage

#: Most rows and bytes of a block of candidates, and rows of a pack of queries.
BLOCK_ROWS = 4096
BLOCK_BYTES = 1 << 24
PACK_ROWS = 1024


def usable(vectors: DataFrame, non_zero: bool = False) -> DataFrame:
    """vec_id and vector (doubles) of the rows whose vector is whole and finite."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    wanted = F.col("vector").isNotNull() & (F.size("vector") > 0) & finite
    if non_zero:
        wanted = wanted & F.exists("vector", lambda x: x != 0)
    named = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    return named.filter(F.col("vec_id").isNotNull() & wanted)


def packed(rows: DataFrame, most: int) -> DataFrame:
    """dim, ids and vectors (raw int64 and float64) of up to ``most`` rows and ``BLOCK_BYTES`` of one length each, packed where they lie."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            parts = waiting.pop(dim)
            ids, matrix = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([ids.tobytes()]), pa.array([matrix.tobytes()])],
                names=["dim", "ids", "vectors"],
            )

        for frame in frames:
            ids = frame.column("vec_id").to_numpy()
            lists = frame.column("vector")
            values = lists.flatten().to_numpy()
            ends = np.cumsum(lists.value_lengths().to_numpy())
            lengths = np.diff(np.r_[0, ends])
            for dim in np.unique(lengths):
                own = np.flatnonzero(lengths == dim)
                matrix = values[(ends[own] - dim)[:, None] + np.arange(dim)].astype(np.float64)
                size = min(most, max(1, BLOCK_BYTES // (8 * int(dim))))
                for at in range(0, len(own), size):
                    have = sum(len(p[0]) for p in waiting.get(int(dim), []))
                    if have + len(own[at : at + size]) > size:
                        yield block(int(dim))
                    part = (ids[own[at : at + size]].astype(np.int64), matrix[at : at + size])
                    waiting.setdefault(int(dim), []).append(part)
        for dim in list(waiting):
            yield block(dim)

    return rows.mapInArrow(batches, "dim int, ids binary, vectors binary")


class Best:
    """The ``k`` best (score, id) of each query of a pack: highest score, then smallest id."""

    def __init__(self, query_ids: np.ndarray, k: int, score_type: type) -> None:
        self.query_ids, self.k = query_ids, k
        self.found: list[tuple[np.ndarray, np.ndarray]] = [
            (np.empty(0, score_type), np.empty(0, np.int64)) for _ in query_ids
        ]

    def floor(self, query: int) -> float:
        """The score of the last of the ``k``; -inf while there are fewer."""
        scores = self.found[query][0]
        return float(scores[-1]) if len(scores) == self.k else -np.inf

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        old_scores, old_ids = self.found[query]
        scores, ids = np.concatenate([old_scores, scores]), np.concatenate([old_ids, ids])
        if len(scores) > 4 * self.k:
            edge = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            near = scores >= edge
            scores, ids = scores[near], ids[near]
        order = np.lexsort((ids, -scores))[: self.k]
        self.found[query] = (scores[order], ids[order])

    def rows(self) -> pa.RecordBatch:
        counts = [len(s) for s, _ in self.found]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(self.query_ids, counts), pa.int64()),
                pa.array(np.concatenate([i for _, i in self.found]), pa.int64()),
                pa.array(np.concatenate([s for s, _ in self.found])),
            ],
            names=["query_id", "vec_id", "score"],
        )


Kernel = Callable[..., None]

#: Most blocks that a task holds, unless there are fewer tasks than cores.
TASK_BLOCKS = 8


def _as_it_is(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, ...]:
    return ids, vectors


def _placed(rows: DataFrame, key: str) -> DataFrame:
    """Add ``_place``: the few rows numbered from 0 in the order of ``key``; only the keys meet."""
    numbers = rows.select(key).withColumn("_place", (F.row_number().over(Window.orderBy(key)) - 1).cast("int"))
    return rows.join(F.broadcast(numbers), key)


def search(
    rows: DataFrame,
    is_query: Column,
    kernel: Kernel,
    k: int,
    score_type: str,
    block_rows: int = BLOCK_ROWS,
    prepare: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, ...]] = _as_it_is,
) -> DataFrame:
    """query_id, rank, vec_id and score of the best ``k`` candidates of every query.

    ``kernel(queries, *prepare(ids, vectors), best)`` adds to ``best`` what a block of candidates can contribute; a task prepares a block once.
    The kernel must leave out the rows that have the query's own id.  Of several query rows with one id, the one with the least hash of its vector asks.
    """
    spark = rows.sparkSession
    asking = rows.filter(is_query).groupBy("vec_id").agg(F.min(F.struct(F.xxhash64("vector"), "vector")).alias("one"))
    asking = asking.select("vec_id", "one.vector")
    blocks = stage(packed(rows, block_rows).withColumn("_at", F.monotonically_increasing_id()), "blocks")
    packs = stage(packed(asking, PACK_ROWS).withColumn("pack", F.monotonically_increasing_id()), "packs")
    n, tasks = blocks.count(), 2 * spark.sparkContext.defaultParallelism
    groups = max(1, min(n, max(tasks, -(-n // TASK_BLOCKS))))
    copies = max(1, min(packs.count(), -(-tasks // groups)))
    numbers = lambda most: F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    dealt = _placed(blocks, "_at").withColumn("c", numbers(copies)).select(
        (F.col("_place") % groups * copies + F.col("c")).alias("g"), F.lit(None).cast("long").alias("pack"), "_place", "dim", "ids", "vectors"
    )
    asked = _placed(packs, "pack").withColumn("c", numbers(groups)).select(
        (F.col("c") * copies + F.col("_place") % copies).alias("g"), "pack", "_place", "dim", "ids", "vectors"
    )
    # The blocks of a task come before its packs.
    order = [F.col("pack").asc_nulls_first(), "_place"]
    pairs = dealt.unionByName(asked).repartitionById(groups * copies, "g").sortWithinPartitions(*order)
    dtype = np.int64 if score_type == "long" else np.float64

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for frame in frames:
            for row in frame.to_pylist():
                ids, vectors = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
                if row["pack"] is None:
                    held.setdefault(row["dim"], []).append(prepare(ids, vectors))
                elif row["dim"] in held:
                    best = Best(ids, k, dtype)
                    for block in held[row["dim"]]:
                        kernel(vectors, *block, best)
                    yield best.rows()

    # A row is megabytes, so a batch has few.
    with batch_rows(spark, 8):
        found = stage(pairs.mapInArrow(batches, f"query_id long, vec_id long, score {score_type}"), "found")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        found.withColumn("rank", place.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
