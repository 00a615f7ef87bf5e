"""CSV with line breaks inside quotes, read by many tasks even when it is one file.

A line break ends a record if an even number of quotes comes before it in the file.  Spark deals a file out in
blocks of whole lines.  The quotes of each block are counted first (one row a block), running sums say which blocks
start inside quotes, and then every block is put together into records on its own.  A record that lies across blocks
is in pieces, at most two a block; only the pieces are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimill.plans.staging import stage

#: Blocks of one read at most: a number and three flags of each are broadcast (a block is 128 MB by default).
MAX_BLOCKS = 4_000_000

PIECES = "block bigint, text string, begins boolean, ends boolean, in_front boolean"
_PIECES = pa.schema(
    [
        ("block", pa.int64()),
        ("text", pa.string()),
        ("begins", pa.bool_()),  # holds the start of its record
        ("ends", pa.bool_()),  # holds the end of its record
        ("in_front", pa.bool_()),  # no text stands before it in its file
    ]
)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines and the block they lie in; the lines of a block stay in their order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.xxhash64("_metadata.file_path", "_metadata.file_block_start", "_metadata.file_block_length").alias("block"),
        "value",
    )


def blocks(lines: DataFrame) -> DataFrame:
    """``block, path, start, inside, returns``, one row a block.

    ``inside``: the block starts inside quotes; ``returns``: its file's first line, so all its lines, end with CR and LF.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = (
        lines.withColumn("line", F.monotonically_increasing_id())
        .groupBy("block", "path", "start")
        .agg(F.sum(quotes).alias("quotes"), F.min_by(F.endswith("value", F.lit("\r")), "line").alias("returns"))
    )
    in_file = Window.partitionBy("path").orderBy("start")
    before = F.sum("quotes").over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    return counted.select(
        "block",
        "path",
        "start",
        (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"),
        F.first("returns").over(in_file).alias("returns"),
    )


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces of records from the lines of a task."""
    block = None  # that is being read
    inside = begins = in_front = False  # state after the last line; of the record being read
    waiting: list[str] = []  # lines of the record being read

    def rows(texts: list[str], begin: list[bool], ends: bool, front: list[bool]) -> pa.RecordBatch:
        columns = [[block] * len(texts), texts, begin, [ends] * len(texts), front]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("block").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            part = batch.slice(low, high - low)
            if keys[low] != block:
                if waiting:
                    yield rows(["\n".join(waiting)], [begins], False, [in_front])
                block, waiting = int(keys[low]), []
                inside, in_front = part.column("inside")[0].as_py(), part.column("in_front")[0].as_py()
                if inside is None:
                    raise ValueError(
                        "the files or their blocks changed while they were read; spark.sql.files.minPartitionNum "
                        "keeps the blocks the same when executors come and go"
                    )
                begins = not inside
            values = part.column("value")
            odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) & 1
            after = (np.cumsum(odd) + inside) & 1
            inside = bool(after[-1])
            lines = values.to_pylist()
            texts, begin, front, at = [], [], [], 0
            for end in np.flatnonzero(after == 0).tolist():
                texts.append("\n".join([*waiting, *lines[at : end + 1]]))
                begin.append(begins)
                front.append(in_front)
                in_front = in_front and not texts[-1]
                waiting, begins, at = [], True, end + 1
            waiting.extend(lines[at:])
            if texts:
                yield rows(texts, begin, True, front)
    if waiting:
        yield rows(["\n".join(waiting)], [begins], False, [in_front])


def records(spark: SparkSession, path: str) -> DataFrame:
    """``text, is_header``: the records of all files; the first one of each file is its header.

    Three readings of the files: quotes, pieces, records; the first two are done at once.
    """
    lines = _lines(spark, path)
    found = stage(blocks(lines), "csv-blocks")
    if found.count() > MAX_BLOCKS:
        raise ValueError("too many blocks: raise spark.sql.files.maxPartitionBytes or read fewer files at once")
    # At most MAX_BLOCKS rows of a number and three flags.  A join by shuffling would lose the order of the lines.
    states = F.broadcast(found.select("block", "inside", (F.col("start") == 0).alias("in_front"), "returns"))
    line = F.when(F.col("returns") & F.endswith("value", F.lit("\r")), F.expr("left(value, length(value) - 1)"))
    placed = (
        lines.select("block", "value")
        .join(states, "block", "left")
        .select("block", line.otherwise(F.col("value")).alias("value"), "inside", "in_front")
    )
    parts = placed.mapInArrow(_put_together, PIECES)
    is_whole = F.col("begins") & F.col("ends")
    pieces = stage(parts.filter(~is_whole), "csv-pieces").join(found.select("block", "path", "start"), "block")
    # The end of the record before stands in front of the start of the next one in the same block.
    place = Window.partitionBy("path").orderBy("start", "begins")
    numbered = pieces.withColumn("record", F.sum(F.col("begins").cast("int")).over(place))
    joined = numbered.groupBy("path", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "begins", "text"))).alias("parts"),
        F.bool_or("in_front").alias("is_header"),
    )
    broken = joined.select(F.array_join(F.col("parts.text"), "\n").alias("text"), "is_header")
    every = parts.filter(is_whole).select("text", F.col("in_front").alias("is_header")).unionByName(broken)
    return every.filter("text != ''")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The rows of CSV files with a header, parsed from their records."""
    row = F.from_csv("text", schema.toDDL(), {**options, "multiLine": "true"})
    return records(spark, path).filter(~F.col("is_header")).select(row.alias("row")).select("row.*")
