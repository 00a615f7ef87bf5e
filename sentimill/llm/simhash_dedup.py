"""Near-duplicate documents by SimHash fingerprints that differ in at most two bits.

Method: deletion-variant signatures.  A 64-bit fingerprint is cut into two halves, one fewer than
two differing bits could touch with one each in every part: of two linked fingerprints one half
differs in at most one bit.  Each half is indexed under its 32 variants with one bit wild; linked
fingerprints meet under an equal variant and are then verified.

Copies share a fingerprint, so only different fingerprints are indexed.  A variant that two
fingerprints share is verified as a pair.  Fingerprints of a variant shared by more are indexed once
more, by the whole fingerprint with one bit flipped: two of them differ in at most two bits exactly if
they have such a neighbour (or each other) in common, and at most 65 fingerprints can share one.  So
no group is ever paired with itself, however many members a variant has.

Null, empty and blank texts have the fingerprint zero, and link like any other.  Rows with a null
doc_id take part; they never name a component unless no row of it has an id (then it is null).
Repeated rows are copies.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentimill.llm.common import map_batches
from sentimill.llm.components import connected_components
from sentimill.plans.staging import stage

WORDS = 3
SEED = 42
MAX_BITS = 2
_CHUNK = 1 << 16


def fingerprint_of(text: str | None) -> int:
    """The SimHash of one text, as an unsigned number."""
    if not text:
        return 0
    # bytes.lower() and bytes.split() know ASCII only, which is the contract.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = ends[WORDS - 1 :] if len(words) >= WORDS else ends[-1:]
    first = starts[: len(last)]
    of = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(last), _CHUNK):
        hashes = np.array(
            [
                of(joined[a:b], SEED)
                for a, b in zip(first[at : at + _CHUNK].tolist(), last[at : at + _CHUNK].tolist(), strict=True)
            ],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = (2 * ones > len(last)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: str = "doc_id long") -> DataFrame:
    """The columns ``keep`` (names and types) and fp, the fingerprint as a signed long."""
    names = [column.split()[0] for column in keep.split(", ")]

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            values = [fingerprint_of(t) for t in frame.column("text").to_pylist()]
            signed = np.array(values, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[frame.column(n) for n in names], pa.array(signed)], names=[*names, "fp"])

    kinds = [F.col(column.split()[0]).cast(column.split()[1]) for column in keep.split(", ")]
    return map_batches(docs.select(*kinds, "text"), batches, f"{keep}, fp long")


def _variants(fps: DataFrame) -> DataFrame:
    """Each fingerprint under the 64 keys (half, wild bit, the half without that bit)."""
    exploded = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("_k"))
    return exploded.select(
        "fp",
        F.expr(
            "shiftleft(cast(_k as bigint), 32) | "
            "(shiftrightunsigned(fp, 32 * (_k div 32)) & 4294967295L & ~shiftleft(1L, cast(_k % 32 as int)))"
        ).alias("key"),
    )


def _within_two_bits(fps: DataFrame) -> DataFrame:
    """Links that connect every two fingerprints with a common one-bit neighbour."""
    flips = F.concat(
        F.array(F.col("fp")),
        F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))),
    )
    near = fps.select("fp", F.explode(flips).alias("neighbour"))
    # At most 65 different fingerprints lie within one bit of a neighbour.
    groups = near.groupBy("neighbour").agg(F.collect_set("fp").alias("members")).filter(F.size("members") > 1)
    least = groups.select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
    return least.filter("a < b").distinct()


def links(fps: DataFrame) -> DataFrame:
    """Pairs (a, b) of different fingerprints at most two bits apart that connect all such pairs."""
    # The index is dealt out by key once; what stays of it is the keys that fingerprints share.
    sharing = F.count("*").over(Window.partitionBy("key"))
    met = stage(
        _variants(fps).repartition("key").withColumn("n", sharing).filter("n > 1").select("key", "fp", "n"), "variants"
    )
    two = met.filter("n = 2").groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
    pairs = two.filter(f"bit_count(a ^ b) <= {MAX_BITS}").select("a", "b").distinct()
    crowded = met.filter("n > 2").select("fp").distinct()
    return pairs.union(_within_two_bits(crowded)).distinct()


def rooted(nodes: DataFrame) -> DataFrame:
    """fp, first_doc (its smallest doc_id) and root (a fingerprint that names its component) of all fingerprints, written."""
    different = stage(nodes.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "different")
    roots = connected_components(links(different.select("fp")), "a", "b")
    return stage(
        different.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first_doc", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable."""
    nodes = stage(fingerprints(docs), "fingerprints")
    linked = rooted(nodes)
    names = linked.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    by_fp = linked.select("fp", "root").join(names, "root").select("fp", "component_id")
    return nodes.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component of near duplicates.

    The row with the smallest doc_id is kept (rows without one come last), then the one with the smallest hash of its text, and any one of repeated
    rows.  Rows that share a doc_id and belong to different components are kept each.
    """
    # The rows travel as one column, so names and types of the others do not matter.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").isNull().alias("nameless"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.md5(F.coalesce("text", F.lit(""))).alias("hash"), "text",
    )
    nodes = stage(fingerprints(rows, "nameless boolean, doc_id long, hash string"), "fingerprints")
    least = F.min(F.struct("nameless", "doc_id", "hash")).alias("one")
    firsts = nodes.groupBy("fp").agg(least)
    won = firsts.join(rooted(nodes).select("fp", "root"), "fp").groupBy("root").agg(F.min("one").alias("one")).select("one.*")
    key = ["nameless", "doc_id", "hash"]
    return rows.select("row", *key).join(won, key).groupBy(*key).agg(F.first("row").alias("row")).select("row.*")
