"""Joins against a table with unique keys when one key may own a third of the rows.

A key is hot when it owns more than ``1/slots`` of all rows, so there are fewer
than ``slots`` hot keys whatever the data: that list may be broadcast.  A hot key
is split into as many parts as it owns slots, which leaves every join key with
about ``total/slots`` rows and adds at most ``2*slots`` copies to the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 4096


def parts(table: DataFrame, rows: str, slots: int = SLOTS) -> Column:
    """How many parts the key in a row of ``table`` is split into; 1 unless it is hot."""
    total = table.agg(F.sum(rows)).scalar()
    is_hot = F.col(rows) * slots > total
    return F.when(is_hot, F.ceil(F.col(rows) * slots / total)).otherwise(F.lit(1)).cast("int")


def add_part(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    count: str,
    name: str,
) -> DataFrame:
    """Add to each row its part of the key; column ``count`` of ``table`` says how many there are.

    The hash makes the part the same on every retry of a task.  Fewer than
    ``slots`` keys have more than one part, so the broadcast is bounded.
    """
    hot = table.filter(F.col(count) > 1).select(*on, F.col(count).alias("_split"))
    part = F.pmod(F.xxhash64(*spread_by), F.coalesce(F.col("_split"), F.lit(1)))
    return (
        rows.join(F.broadcast(hot), list(on), "left")
        .withColumn(name, part.cast("int"))
        .drop("_split")
    )


def copy_parts(table: DataFrame, count: str, name: str) -> DataFrame:
    """One copy of each row of ``table`` per part of its key."""
    return table.withColumn(name, F.explode(F.sequence(F.lit(0), F.col(count) - 1)))


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    weight: str,
    spread_by: Sequence[str],
    slots: int = SLOTS,
) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (unique on ``on``).

    ``weight`` is the column of ``table`` that says how many rows its key has.
    """
    sized = table.withColumn("_parts", parts(table, weight, slots))
    left = add_part(rows, sized, on, spread_by, "_parts", "_part")
    right = copy_parts(sized, "_parts", "_part").drop("_parts")
    return left.join(right, [*on, "_part"]).drop("_part")
