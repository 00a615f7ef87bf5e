"""Packing of tokenised documents into sequences, by exact complements and then by best fit.

A document is its token ids followed by the end id.  Only documents longer than a sequence are cut, into
pieces of the full length; the first piece takes what is left over.

Method: exact-complement hashing.  How pieces are combined depends only on how many pieces of each
length there are, and there are at most ``capacity`` lengths, so the combinations are found on that
histogram, whose size does not grow with the data.  For each length, from long to short, single lengths,
then pair sums, then triple sums that fill the gap exactly are looked up in an index of the sums that the
counts still allow, and used as often as the counts allow.  What is left goes, longest first, to the
open sequence with the smallest gap that takes it.  A plan is a list of (lengths, how many sequences).

Carrying it out is a lookup: pieces are ranked within their length (range-partitioned by length and hash, so a
hot length is spread over tasks), and the plan says which sequence and offset each rank has.

Null and empty texts give one piece holding the end id only.  Special-token strings in a text are
their own ids, as the tokenizer has them.  Repeated rows are packed each.  Columns other than doc_id and text are not read; a null
doc_id is kept.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentimill.llm.common import map_batches
from sentimill.plans.staging import stage

CAPACITY = 2048
END_ID = 0
# How the byte-level vocabulary cuts a text before merging; a fixed value.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """The byte that each printable stand-in character of a byte-level vocabulary file means."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids by a byte-level vocabulary file of the tokenizers library.

    The ids are those of ``tokenizers``, strings of special tokens included; the merging itself is left to tiktoken,
    which applies the same ranks several times faster.
    """

    def __init__(self, vocabulary: str) -> None:
        import tiktoken

        with open(vocabulary, encoding="utf-8") as file:
            content = json.load(file)
        special = {token["content"]: token["id"] for token in content["added_tokens"]}
        of = _byte_of_char()
        ranks = {
            bytes(of[c] for c in token): rank for token, rank in content["model"]["vocab"].items() if token not in special
        }
        self._encoding = tiktoken.Encoding("bytes", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return self._encoding.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be short."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, length, capacity)]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """One row per piece; ``keep_ids`` adds the ids themselves (little-endian unsigned 32-bit)."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        end = int(end_id).to_bytes(4, "little")
        for frame in frames:
            doc, piece, start, size, crc, kept = [], [], [], [], [], []
            for name, text in zip(frame.column("doc_id").to_pylist(), frame.column("text").to_pylist(), strict=True):
                ids = encoder.ids(text or "") + end
                for number, (at, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * at : 4 * (at + length)]
                    doc.append(name)
                    piece.append(number)
                    start.append(at)
                    size.append(length)
                    crc.append(zlib.crc32(own))
                    if keep_ids:
                        kept.append(own)
            columns = [
                pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(size, pa.int64()), pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(kept, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(columns, batches, PIECES + (", ids binary" if keep_ids else ""))


class _Sums:
    """The counts still to be used, and for each sum how many pairs of lengths make it."""

    def __init__(self, counts: np.ndarray) -> None:
        self.left = counts.copy()
        self.size = len(counts)
        self.pairs = np.zeros(self.size, dtype=np.int64)
        for a in np.flatnonzero(self.left):
            self._index(int(a), 1)

    def _index(self, a: int, by: int) -> None:
        """Add or take away the pairs of ``a`` with available lengths up to it."""
        smaller = np.flatnonzero(self.left[: min(a + 1, self.size - a)])
        self.pairs[a + smaller] += by

    def use(self, lengths: tuple[int, ...], times: int) -> None:
        for a in lengths:
            self.left[a] -= times
            if self.left[a] == 0:
                available = np.flatnonzero(self.left[: self.size - a])
                self.pairs[a + available] -= 1
                if 2 * a < self.size:
                    self.pairs[2 * a] -= 1

    def times(self, lengths: tuple[int, ...]) -> int:
        return min(int(self.left[a]) // lengths.count(a) for a in lengths)

    def pair(self, total: int) -> Iterator[tuple[int, int]]:
        if total < 2 or self.pairs[total] <= 0:
            return
        large = np.arange((total + 1) // 2, total)
        for a in large[(self.left[large] > 0) & (self.left[total - large] > 0)][::-1]:
            yield int(a), total - int(a)

    def complements(self, longest: int, gap: int) -> Iterator[tuple[int, ...]]:
        """Combinations of one, two, then three available lengths that fill the gap exactly."""
        if self.left[gap] > 0:
            yield (gap,)
        yield from self.pair(gap)
        large = np.arange(1, gap - 1)
        for a in large[(self.left[large] > 0) & (self.pairs[gap - large] > 0)][::-1]:
            for b, c in self.pair(gap - int(a)):
                if b <= a:
                    yield int(a), b, c


def combine(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """The plan: (lengths of a sequence, number of such sequences), for a histogram of lengths."""
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        histogram[length] += n
    plan: list[tuple[tuple[int, ...], int]] = []
    if histogram[capacity]:
        plan.append(((capacity,), int(histogram[capacity])))
        histogram[capacity] = 0
    sums = _Sums(histogram)
    for longest in range(capacity - 1, 0, -1):
        while sums.left[longest] > 0:
            for others in sums.complements(longest, capacity - longest):
                lengths = (longest, *others)
                if times := sums.times(lengths):
                    break
            else:
                break
            sums.use(lengths, times)
            plan.append((lengths, times))
    return plan + _best_fit(sums.left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each piece to the open sequence with the smallest gap that takes it.

    Sequences filled alike are one group, so a step moves as many pieces as a group has sequences.
    """
    groups: dict[int, list[list]] = {}
    open_gaps = np.zeros(capacity + 1, dtype=bool)

    def put(gap: int, lengths: tuple[int, ...], n: int) -> None:
        groups.setdefault(gap, []).append([lengths, n])
        open_gaps[gap] = True

    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            fitting = np.flatnonzero(open_gaps[length:])
            if len(fitting) == 0:
                each = capacity // length
                full, rest = divmod(n, each)
                if full:
                    put(capacity - each * length, (length,) * each, full)
                if rest:
                    put(capacity - rest * length, (length,) * rest, 1)
                break
            gap = length + int(fitting[0])
            lengths, bins = groups[gap][-1]
            moved = min(n, bins)
            groups[gap][-1][1] -= moved
            if moved == bins:
                groups[gap].pop()
                open_gaps[gap] = bool(groups[gap])
            put(gap - length, (*lengths, length), moved)
            n -= moved
    return [(lengths, n) for found in groups.values() for lengths, n in found]


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the ranks of a length go: key (length and first rank), first sequence, offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, n in plan:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            rows.append((length << 48 | rank, sequence, offset))
            used[length] = rank + n
            offset += length
        sequence += n
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 3)
    return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()


def _ranked(table: DataFrame) -> DataFrame:
    """Number the pieces of each length inside range slices; the slices follow the data."""
    schema = table.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    slices = max(1, int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["length", "_hash", "doc_id", "piece"]
    dealt = (
        table.withColumn("_hash", F.xxhash64("doc_id", "piece"))
        .repartitionByRange(slices, *order)
        .sortWithinPartitions(*order)
        .withColumn("slice", F.spark_partition_id())
        .drop("_hash")
    )

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen = -1, 0
        for frame in frames:
            lengths = frame.column("length").to_numpy()
            if not len(lengths):
                continue
            begins = np.flatnonzero(np.r_[True, lengths[1:] != lengths[:-1]])
            runs = np.diff(np.r_[begins, len(lengths)])
            ranks = np.arange(len(lengths)) - np.repeat(begins, runs)
            if lengths[0] == current:
                ranks[: runs[0]] += seen
            current, seen = lengths[-1], int(ranks[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*frame.columns, pa.array(ranks, pa.int64())], names=[*frame.schema.names, "rank"]
            )

    return dealt.mapInArrow(batches, f"{schema}, slice int, rank long")


def pack(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to ``pieces``; a sequence holds at most ``capacity`` tokens."""
    ranked = stage(_ranked(table), "ranked")
    sizes = stage(ranked.groupBy("slice", "length").agg(F.count("*").alias("n")), "sizes")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    keys, sequences, offsets = _slots(combine(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("slice", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = ranked.join(before, ["slice", "length"]).select(
        *table.columns, (F.col("rank") + F.col("before")).alias("rank")
    )
    schema = table.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            lengths, ranks = frame.column("length").to_numpy(), frame.column("rank").to_numpy()
            key = (lengths.astype(np.int64) << 48) | ranks
            slot = np.searchsorted(keys, key, side="right") - 1
            sequence = sequences[slot] + (key - keys[slot])
            kept = [c for c, name in zip(frame.columns, frame.schema.names, strict=True) if name != "rank"]
            names = [name for name in frame.schema.names if name != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offsets[slot])], names=[*names, "sequence_id", "offset"]
            )

    return numbered.mapInArrow(batches, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """The place of every piece of every document."""
    # Written down first: range partitioning reads its input twice.
    return pack(stage(pieces(docs, vocabulary, capacity), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids, from pieces made with ``keep_ids``.

    A sequence has at most ``capacity`` tokens, so its group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id",
        F.aggregate("_parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"])).alias("ids"),
    )
