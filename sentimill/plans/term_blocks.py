"""Documents packed into blocks, so that a table of terms is joined with each block's different terms and not with every document's.

A task packs the documents it reads: their terms are numbered, and a document is a list of numbers.  The blocks are written down bucketed
by block and read in place; what is shuffled is a block's different terms on their way to the table, and their values on the way back.
A term has at most one row per block, so no term is hot.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimill.plans.staging import fresh_path

# Functions that run inside tasks travel with them, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Terms of a block with repeats, about: a document is never cut.
BLOCK_TERMS = 1 << 23


def _squeezed(numbers: np.ndarray) -> bytes:
    """Small whole numbers byte by byte, the high bytes of all together, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<i4")).view("u1").reshape(-1, 4).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True)


def _unsqueezed(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), "u1")
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").ravel()


def _block(number: int, keys: Sequence[pa.RecordBatch], sizes: Sequence[np.ndarray], coded: Sequence[pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    """The documents of some batches as one row."""
    chunks = pa.chunked_array(coded).unify_dictionaries().chunks
    terms, codes = chunks[0].dictionary, np.concatenate([c.indices.to_numpy() for c in chunks])
    lengths = np.concatenate(sizes)
    docs = np.repeat(np.arange(len(lengths)), lengths)
    pairs, tf = np.unique(docs * len(terms) + codes, return_counts=True)
    held = np.bincount(pairs // len(terms), minlength=len(lengths))
    row = [pa.array([number], pa.int64()), pa.array([len(pairs)], pa.int32())]
    row += [pa.array([_squeezed(a)], pa.binary()) for a in (held, pairs % len(terms), tf)]
    lists = [pa.concat_arrays([batch.column(c) for batch in keys]) for c in range(keys[0].num_columns)]
    row += [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in (*lists, terms)]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(row, schema, strict=True)], schema=schema)


def _pack(batches: Iterator[pa.RecordBatch], most: int, schema: pa.Schema, is_whole: bool) -> Iterator[pa.RecordBatch]:
    number, count, kept = TaskContext.get().partitionId() << 32, 0, ([], [], [])
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        lengths = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
        terms = lists.flatten()
        if terms.null_count:
            known = terms.is_valid().to_numpy(zero_copy_only=False)
            lengths = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[known], minlength=len(lengths))
            terms = terms.drop_null()
        if not len(terms) and not is_whole:
            continue
        parts = batch.select(list(range(batch.num_columns - 1))), lengths, terms.dictionary_encode()
        for so_far, part in zip(kept, parts, strict=True):
            so_far.append(part)
        count += len(terms)
        if count >= most:
            yield _block(number, *kept, schema)
            number, count, kept = number + 1, 0, ([], [], [])
    if kept[0]:
        yield _block(number, *kept, schema)


@dataclass(frozen=True)
class Found:
    """A block's entries whose term the table knows: document, term (places in ``keys`` and ``terms``), occurrences, and the terms' values."""

    keys: list[pa.Array]
    terms: pa.Array
    docs: np.ndarray
    cols: np.ndarray
    tf: np.ndarray
    values: dict[str, np.ndarray]

    def summed(self, values: np.ndarray) -> np.ndarray:
        """A number per entry added up by document."""
        return np.bincount(self.docs, values, len(self.keys[0]))


@dataclass(frozen=True)
class Blocks:
    """Documents that are packed and written: a row per block with the documents' ``keys`` and its different terms."""

    rows: DataFrame
    keys: tuple[str, ...]

    def of(self, keys: Sequence[str]) -> Blocks:
        """The same blocks with some of the keys."""
        kept = {f"key{i}": f"key{self.keys.index(c)}" for i, c in enumerate(keys)}
        return Blocks(self.rows.select("block", "n", "sizes", "cols", "tf", *[F.col(c).alias(k) for k, c in kept.items()], "terms"), tuple(keys))


def pack(docs: DataFrame, keys: Sequence[str], terms: str = "terms", block_terms: int = BLOCK_TERMS, is_whole: bool = False) -> Blocks:
    """The blocks of ``docs`` (``keys`` and the array ``terms``), written at once; documents' texts are read here only.

    ``is_whole``: every document is in a block, whether it has terms or not.
    """
    spark = docs.sparkSession
    numbers = [T.StructField("block", T.LongType()), T.StructField("n", T.IntegerType())]
    numbers += [T.StructField(c, T.BinaryType()) for c in ("sizes", "cols", "tf")]
    fields = [T.StructField(f"key{i}", T.ArrayType(docs.schema[c].dataType)) for i, c in enumerate(keys)]
    shape = T.StructType([*numbers, *fields, T.StructField("terms", T.ArrayType(T.StringType()))])
    arrow = docs.limit(0).select(*keys).toArrow().schema
    arrow = pa.schema(
        [
            ("block", pa.int64()), ("n", pa.int32()), *((c, pa.binary()) for c in ("sizes", "cols", "tf")),
            *((f"key{i}", pa.list_(arrow.field(i).type)) for i in range(len(keys))), ("terms", pa.list_(pa.string())),
        ]
    )
    name, buckets = f"terms_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.select(*keys, terms).mapInArrow(partial(_pack, most=block_terms, schema=arrow, is_whole=is_whole), shape)
    # Written without an exchange: a block is a row of the task that packed it, and tasks have few.
    written = packed.write.bucketBy(buckets, "block").option("compression", "zstd")
    written.option("path", fresh_path(spark, "term-blocks")).saveAsTable(name)
    blocks = spark.table(name)
    # The files stay, and so does what the rows know of them.
    spark.sql(f"DROP TABLE {name}")
    return Blocks(blocks, tuple(keys))


def _sums_by_term(batches: Iterator[pa.RecordBatch], weights: Sequence[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            block = batch.slice(row, 1)
            terms, n = block.column("terms").flatten(), block.column("n")[0].as_py()
            own = [block.column(c).flatten().to_numpy() for c in weights]
            counts = _unsqueezed(block.column("sizes")[0].as_py(), len(own[0]))
            cols = _unsqueezed(block.column("cols")[0].as_py(), n)
            # Whole numbers below 2^53 add up exactly.
            sums = [np.bincount(cols, np.repeat(w, counts), len(terms)).astype(np.int64) for w in own]
            some = np.flatnonzero(np.any(sums, axis=0))
            yield pa.RecordBatch.from_arrays([terms.take(pa.array(some)), *(pa.array(x[some]) for x in sums)], schema=schema)


def sums_by_term(blocks: Blocks, weights: Sequence[str]) -> DataFrame:
    """``term`` and the sums of the whole numbers ``weights``, keys of the blocks without NULL, over the documents that hold it.

    A term whose sums are all zero has no row.  What is shuffled is a row per block and different term.
    """
    at = {c: f"key{blocks.keys.index(c)}" for c in weights}
    arrow = pa.schema([("term", pa.string()), *((c, pa.int64()) for c in weights)])
    shape = T.StructType([T.StructField("term", T.StringType()), *(T.StructField(c, T.LongType()) for c in weights)])
    rows = blocks.rows.select("n", "sizes", "cols", "terms", *at.values())
    parts = rows.mapInArrow(partial(_sums_by_term, weights=list(at.values()), schema=arrow), shape)
    return parts.groupBy("term").agg(*[F.sum(c).alias(c) for c in weights])


def found_by_block(
    docs: DataFrame,
    keys: Sequence[str],
    table: DataFrame,
    work: Callable[[Found], list[pa.Array]],
    schema: T.StructType,
    terms: str = "terms",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``found_in`` the blocks of ``docs`` (``keys`` and the array ``terms``), which are packed and written at once."""
    return found_in(pack(docs, keys, terms, block_terms), table, work, schema)


def found_in(
    blocks: Blocks, table: DataFrame, work: Callable[[Found], list[pa.Array]], schema: T.StructType, is_whole: bool = False
) -> DataFrame:
    """What ``work`` makes of each block, columns as in ``schema``; ``is_whole``: also of a block without a known term.

    ``table`` has one row per term: ``term`` and numbers without NULL, the values.
    """
    rows, values = blocks.rows, [c for c in table.columns if c != "term"]
    keys = [f"key{i}" for i in range(len(blocks.keys))]
    routes = rows.select(F.col("block").alias("of"), F.posexplode("terms").alias("at", "term"))
    back = routes.join(table, "term").select("of", "at", *values)

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not (right.num_rows or is_whole):
            return pa.Table.from_batches([], made)
        listed = {c: left.column(c).combine_chunks().flatten() for c in (*keys, "terms")}
        size = len(listed["terms"])
        at, known = right.column("at").to_numpy(), np.zeros(size, bool)
        known[at] = True
        found = {}
        for c in values:
            found[c] = np.zeros(size)
            found[c][at] = right.column(c).to_numpy()
        n = left.column("n")[0].as_py()
        own = [listed[c] for c in keys]
        counts = _unsqueezed(left.column("sizes")[0].as_py(), len(own[0]))
        cols, tf = (_unsqueezed(left.column(c)[0].as_py(), n) for c in ("cols", "tf"))
        kept = known[cols]
        told = work(Found(own, listed["terms"], np.repeat(np.arange(len(counts)), counts)[kept], cols[kept], tf[kept], found))
        return pa.Table.from_arrays([a.cast(f.type) for a, f in zip(told, made, strict=True)], schema=made)

    made = table.sparkSession.createDataFrame([], schema).toArrow().schema
    return rows.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(one, schema)
