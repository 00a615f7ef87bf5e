"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows in one Arrow batch: whole texts may be very long, so a batch stays small.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    rows: int = BATCH_ROWS,
) -> DataFrame:
    """``mapInArrow`` with batches that stay small when rows are large: of ``rows`` rows at most when ``function`` gets them."""

    def small(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return function(frame.slice(at, rows) for frame in frames for at in range(0, frame.num_rows, rows))

    return df.mapInArrow(small, schema)


@contextmanager
def batch_rows(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs that run inside; the session is left as it was."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; false without an id."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))
