"""Connected components of a link table by alternating large-star and small-star steps.

Each step is a grouping and a join, written down in the shared folder; only counts of the links come
to the driver.  Hubs are grouped by a minimum, which Spark combines before the shuffle, and joined
back by a plain equi-join, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentimill.plans.staging import stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v")


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and root (the least node of its component) of every node of ``links`` that is not a root.

    Null ends are dropped, loops and repeated links change nothing, no links give no rows.
    """
    edges = stage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links"
    )
    state = _state(edges)
    if state[0] == 0:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    while True:
        edges = stage(_small_star(_large_star(edges).distinct()).distinct(), "stars")
        after = _state(edges)
        if after == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = after
