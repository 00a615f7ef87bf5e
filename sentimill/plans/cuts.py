"""Exact per-class splits by hash rank, without sorting a class and without the driver.

Only the hash values at the cut ranks are searched for: rows are counted per class and hash bucket, and
just the buckets a cut falls into are ordered.  Buckets grow with the square root of the rows, so neither the buckets of a
class nor the rows of a bucket are more than that.  The cut values are a table with one row per class, joined back under
Spark's own size check: any number of classes will do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentimill.functions.hashing import digest
from sentimill.plans.staging import stage


def _with_passed(df: DataFrame, key: str, label: str, seed: str, ranks: Column, name: str) -> DataFrame:
    """Add how many of its class's cut ranks a row lies beyond.

    ``ranks``: the class's cut ranks (an array, in order, repeats and zeros allowed), an expression over
    ``_n`` (rows of the class), ``_total`` (all rows) and ``_place`` windows of the class table.
    """
    known = df.filter(F.col(label).isNotNull())
    # Narrow and read several times.
    keys = stage(known.select(F.col(label).alias("_label"), digest(key, seed).alias("_hash")), "cut-keys")
    classes = keys.groupBy("_label").agg(F.count("*").alias("_n")).withColumn(
        "_total", F.sum("_n").over(Window.partitionBy())
    )
    wanted = stage(classes.select("_label", ranks.alias("_ranks")), "cut-ranks")
    digits = keys.agg(F.greatest(F.lit(2), F.round(F.log2(F.count("*")) / 8)).cast("int")).scalar()
    bucket = F.left(F.col("_hash"), digits)
    counted = keys.groupBy("_label", bucket.alias("_bucket")).agg(F.count("*").alias("_rows"))
    spans = counted.withColumn(
        "_last", F.sum("_rows").over(Window.partitionBy("_label").orderBy("_bucket"))
    ).withColumn("_before", F.col("_last") - F.col("_rows"))
    hit = F.filter("_ranks", lambda r: (r > F.col("_before")) & (r <= F.col("_last")))
    cut_buckets = (
        spans.join(wanted, "_label")
        .select("_label", "_bucket", "_before", hit.alias("_hit"))
        .filter(F.size("_hit") > 0)
    )
    place = F.row_number().over(Window.partitionBy("_label", "_bucket").orderBy("_hash"))
    found = (
        keys.withColumn("_bucket", bucket)
        .join(cut_buckets, ["_label", "_bucket"])
        .withColumn("_rank", F.col("_before") + place)
        .filter(F.array_contains("_hit", F.col("_rank")))
        .select("_label", "_rank", "_hash")
    )
    at_ranks = (
        wanted.select("_label", F.explode("_ranks").alias("_rank"))
        .join(found, ["_label", "_rank"], "left")
        .groupBy("_label")
        # A cut at rank 0 lies before every row.
        .agg(F.count_if(F.col("_rank") <= 0).alias("_first"), F.collect_list("_hash").alias("_cuts"))
    )
    cuts = stage(at_ranks, "cuts").withColumnRenamed("_label", label)
    beyond = F.size(F.filter("_cuts", lambda cut: digest(key, seed) > cut))
    passed = (F.coalesce("_first", F.lit(0)) + F.coalesce(beyond, F.lit(0))).cast("int")
    return known.join(cuts, label, "left").select(*[F.col(c) for c in df.columns], passed.alias(name))


def _quota(share: float) -> Column:
    """``floor(share*n)`` rows allotted to the classes by largest remainder."""
    take = F.floor(F.col("_total") * F.lit(share)).cast("bigint")
    exact = F.col("_n") * take / F.col("_total")
    by_remainder = Window.orderBy(F.desc(F.round(exact - F.floor(exact), 9)), "_label")
    left = take - F.sum(F.floor(exact)).over(Window.partitionBy())
    return (F.floor(exact) + (F.row_number().over(by_remainder) <= left).cast("bigint")).cast("bigint")


def stratified_share(df: DataFrame, key: str, label: str, share: float, seed: str) -> DataFrame:
    """Add ``is_train``: ``floor(share*n)`` rows in all, the classes in proportion.

    ``key`` must be unique; rows without a label are left out.
    """
    placed = _with_passed(df, key, label, seed, F.array(_quota(share)), "_passed")
    return placed.withColumn("is_train", F.col("_passed") == 0).drop("_passed")


def stratified_folds(df: DataFrame, key: str, label: str, folds: int, seed: str) -> DataFrame:
    """Add ``fold`` (0-based); inside each class the fold sizes differ by at most one."""
    ends = [F.floor(F.lit(j) * F.col("_n") / F.lit(folds)).cast("bigint") for j in range(1, folds)]
    return _with_passed(df, key, label, seed, F.array(*ends).cast("array<bigint>"), "fold")
