"""Running totals over a whole ordering without sending it to one task.

Rows are range-partitioned by the ordering, each slice is summed on its own and
the totals of the slices before it are added.  The slice totals number at most
one per slice and group, so only they pass through one window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentimill.plans.staging import stage

# A slice is sorted by one task, so their number follows the rows.
ROWS_PER_SLICE = 1_000_000


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    sums: Mapping[str, str],
    within: Sequence[str] = (),
    peek: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Add ``sums`` (output name -> column) as inclusive running totals.

    ``order`` (ascending) must be unique inside a ``within`` group.  Each name in
    ``peek`` adds ``next_<name>``: that column's value in the following row.
    """
    if slices is None:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slices = max(least, -(-df.count() // ROWS_PER_SLICE))
    within = list(within)
    # The slice numbers come from sampled bounds, so they are written down once:
    # both uses below must see the same ones.
    sliced = stage(
        df.repartitionByRange(slices, *within, *order).withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    first = F.min_by(F.struct(*peek), F.struct(*order)) if peek else F.lit(None)
    totals = sliced.groupBy(*within, "_slice").agg(
        *[F.sum(column).alias(f"_of_{name}") for name, column in sums.items()], first.alias("_first")
    )
    slice_order = Window.partitionBy(*within).orderBy("_slice")
    earlier = slice_order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *within,
        "_slice",
        *[F.coalesce(F.sum(f"_of_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums],
        F.lead("_first").over(slice_order).alias("_next_first"),
    )
    row_order = Window.partitionBy(*within, "_slice").orderBy(*order)
    so_far = row_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = sliced.select(
        "*",
        *[F.sum(column).over(so_far).alias(f"_in_{name}") for name, column in sums.items()],
        *[F.lead(F.struct(p)).over(row_order).alias(f"_lead_{p}") for p in peek],
    )
    # The few slice totals are joined on the keys the window has grouped by already.
    joined = inside.join(offsets, [*within, "_slice"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_in_{n}") + F.col(f"_before_{n}")).alias(n) for n in sums],
        *[
            F.when(F.col(f"_lead_{p}").isNotNull(), F.col(f"_lead_{p}.{p}"))
            .otherwise(F.col(f"_next_first.{p}"))
            .alias(f"next_{p}")
            for p in peek
        ],
    )
