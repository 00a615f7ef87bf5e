"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets: sources by code point, null last, weigh 5, 2, 1, repeating, and share ``share`` times all words;
no source takes more than ``most`` times its own words, the excess is shared again by weight until none
does.  That is a water level: a source takes the smaller of its cap and weight times level.

Blocks: the words wanted are counted in blocks of ``BLOCK_WORDS``.  Blocks go to sources by the highest
quotients target / (2k + 1), then from each source to groups of its shards, and from each group to its shards
by the same rule, so every shard has an integer quota.  The highest quotients are found without listing all
blocks: seats lie between the rounded shares for slightly fewer and slightly more blocks, and only
the quotients between those bounds (a few per child) are ranked.

Selection: a shard's documents stand in a seeded order, end to end, cut into blocks.  Full rounds take every block;
the rest is a run of blocks from a seeded start.  A document takes the words of it that lie in chosen blocks.

A shard has about ``SHARD_WORDS`` words or ``SHARD_ROWS`` rows, whatever its source has, so a hot source is many
shards.  Everything is built of DataFrame functions.

Null texts have size zero and take nothing; a null source is a source of its own; rows with one doc_id or none are ordered by
their texts; repeated rows each take their share; an empty table gives no rows; other columns are carried but not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentimill.functions.hashing import digest, unit
from sentimill.plans.staging import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 64
SHARD_WORDS = 1 << 17
SHARD_ROWS = 512
GROUP_SHARDS = 1024
SEED = "mix"

WORD = "[^\\x20\\x09-\\x0D]+"


def _source_key() -> Column:
    """Sources by code point, null last."""
    return F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))


def _with_targets(sources: DataFrame) -> DataFrame:
    """Add weight and target to (key, words, rows)."""
    place = F.row_number().over(Window.orderBy("key")) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    weighed = sources.withColumn("weight", weight).withColumn("cap", MOST * F.col("words"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    everyone = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    level = (SHARE * F.sum("words").over(everyone) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    levels = weighed.select((F.col("cap") / F.col("weight")).alias("full"), level.alias("level"))
    # The level if the sources filled before this one are full; the first that is not filled has the true one.
    true_level = levels.filter("full >= level").agg(F.min_by("level", "full"))
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.coalesce(true_level.scalar(), F.lit(0.0)))
    return weighed.withColumn("target", target.cast("double")).drop("cap", "weight")


def apportion(children: DataFrame, parent: Sequence[str], child: str, votes: str, seats: str) -> DataFrame:
    """Share each parent's ``seats`` among its children by the highest quotients votes / (2k + 1).

    Children with no votes get none.  Equal quotients go to the smaller child.  Adds ``quota``.
    """
    of_parent = Window.partitionBy(*parent)
    n = F.count("*").over(of_parent)
    total = F.sum(votes).over(of_parent)
    share = lambda slack: F.when(
        F.col("_total") > 0,
        F.round(F.col(votes) / F.col("_total") * F.greatest(F.col(seats) + slack * F.col("_n"), F.lit(0))),
    ).otherwise(0)
    bounded = children.withColumns({"_n": n, "_total": total}).withColumns(
        {"_sure": share(-1).cast("long"), "_most": share(1).cast("long")}
    )
    open_seats = bounded.withColumn("_rest", F.col(seats) - F.sum("_sure").over(of_parent))
    quotients = open_seats.filter("_most > _sure").select(
        *parent, child, "_rest", votes, F.explode(F.sequence("_sure", F.col("_most") - 1)).alias("_seat")
    )
    best = Window.partitionBy(*parent).orderBy(F.desc(F.col(votes) / (2 * F.col("_seat") + 1)), child)
    won = (
        quotients.withColumn("_place", F.row_number().over(best))
        .filter("_place <= _rest")
        .groupBy(*parent, child)
        .agg(F.count("*").alias("_won"))
    )
    return (
        bounded.join(won, [*parent, child], "left")
        .withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0)))
        .drop("_n", "_total", "_sure", "_most", "_won")
    )


def _overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(b, d) - F.greatest(a, c))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words) of every row."""
    return _mixed(docs, ["doc_id"]).select("_row.*", "size", "source_size", "target", "taken")


def _mixed(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The columns ``carry`` as one column ``_row``, with size, source_size, target and taken."""
    # Rows without a doc_id, or with one id, are told apart by their texts.
    draw = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))))
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row"),
        _source_key().alias("key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        draw.alias("_id"),
    ).select("_row", "key", "size", digest("_id", SEED).alias("_draw"), unit("_id", SEED + " shard").alias("_unit"))
    slim = stage(sized.select("key", "size", "_draw", "_unit"), "sized")
    if list(carry) == ["doc_id"]:
        sized = slim = stage(sized, "sized")
    sources = stage(
        _with_targets(slim.groupBy("key").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))), "sources"
    )
    return _place(sized, slim, sources)


def _place(sized: DataFrame, slim: DataFrame, sources: DataFrame) -> DataFrame:
    shards_of = F.greatest(
        F.lit(1), F.ceil(F.col("words") / SHARD_WORDS), F.ceil(F.col("rows") / SHARD_ROWS)
    ).cast("long")
    split = sources.select("key", shards_of.alias("shards"))
    shard = F.floor(F.col("_unit") * F.col("shards")).cast("long")
    shards = stage(
        slim.join(split, "key")
        .groupBy("key", shard.alias("shard"))
        .agg(F.sum("size").alias("shard_words"))
        .withColumn("group", F.floor(F.col("shard") / GROUP_SHARDS)),
        "shards",
    )
    blocks = F.round(F.sum("target").over(Window.partitionBy("all")) / BLOCK_WORDS).cast("long")
    by_source = apportion(
        sources.withColumn("all", F.lit(0)).withColumn("blocks", blocks), ["all"], "key", "target", "blocks"
    ).select("key", F.col("words").alias("source_size"), "target", F.col("quota").alias("source_blocks"))
    groups = shards.groupBy("key", "group").agg(F.sum("shard_words").alias("group_words"))
    by_group = apportion(
        groups.join(by_source.select("key", "source_blocks"), "key"), ["key"], "group", "group_words", "source_blocks"
    ).select("key", "group", F.col("quota").alias("group_blocks"))
    by_shard = apportion(
        shards.join(by_group, ["key", "group"]), ["key", "group"], "shard", "shard_words", "group_blocks"
    ).select("key", "shard", "shard_words", "quota")
    quotas = by_shard.join(by_source.select("key", "source_size", "target"), "key")
    n = F.ceil(F.col("shard_words") / BLOCK_WORDS)
    start = F.floor(unit(F.concat_ws(":", "key", F.col("shard").cast("string")), SEED + " start") * n)
    quotas = stage(
        quotas.withColumns(
            {
                "rounds": F.when(n > 0, F.floor(F.col("quota") / n)).otherwise(0).cast("long"),
                "run": F.when(n > 0, F.col("quota") % n).otherwise(0).cast("long"),
                "run_start": F.when(n > 0, start).otherwise(0).cast("long"),
                "n": n.cast("long"),
            }
        ),
        "quotas",
    )
    order = Window.partitionBy("key", "shard").orderBy("_draw", "size")
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (
        sized.join(split, "key")
        .withColumn("shard", shard)
        .drop("shards", "_unit")
        .withColumn("_end", end)
        .join(quotas, ["key", "shard"])
    )
    a, b = F.col("_end") - F.col("size"), F.col("_end")
    first, last = F.col("run_start") * BLOCK_WORDS, (F.col("run_start") + F.col("run")) * BLOCK_WORDS
    wrapped = (F.col("run_start") + F.col("run") - F.col("n")) * BLOCK_WORDS
    chosen = _overlap(a, b, first, last) + _overlap(a, b, F.lit(0).cast("long"), wrapped)
    taken = F.least(F.col("rounds") * F.col("size") + chosen, MOST * F.col("size"))
    return placed.select("_row", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, to the nearest whole copy."""
    taken = _mixed(docs, docs.columns)
    copies = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    return taken.select("_row", F.explode(F.array_repeat(F.lit(0), copies))).select("_row.*")
