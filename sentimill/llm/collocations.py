"""Phrase collocations of each language by Misra-Gries summaries and an exact second pass.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words at spaces and tabs.  f(phrase) counts all
contiguous occurrences within pieces, overlaps included, for each lang (null: ``und``).  Candidates are phrases of 2 to ``LONGEST`` words
with a = f(phrase) of at least ``LEAST``.  Cut after its first k words, a candidate has l = f(first part), r = f(rest) and
the score floor(2000000 a / (l + r)); the lowest-scoring cut counts (equal ones: smallest k).  Candidates inside a longer one with
100 f(longer) >= 80 a are dropped.  Returned are the first ``FIRST`` of each language by score, then a, descending, then phrase.

First pass: the phrases of 1 to ``LONGEST`` words that a task has read are counted by a short key within one of many hash partitions, and
each partition's counts are merged into a Misra-Gries summary.  Its capacity exceeds the partition's mass divided by ``LEAST``, so what merging
takes off a counter is less than ``LEAST``, and every phrase that occurs ``LEAST`` times survives.  Partitions grow in number with the text, not in size;
only beyond ``PARTITIONS`` of them (some 4 TB of text) do summaries grow.
Second pass: phrases whose key may have survived are counted exactly, as texts.  The keys reach the tasks as a Bloom filter of at most
``FILTER_BITS`` bits; what it or a shared key lets through besides is counted as well and falls below ``LEAST``.

Hot phrases are counted in the tasks before anything is shuffled.  Parts of a candidate occur as often as the candidate at
least, so they survive too.  Counts are longs, products are decimals of 38 digits.

Null and empty texts have no words; repeated rows count each; an empty table gives no rows.  Columns other than text and lang are not read.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentimill.llm.common import batch_rows, map_batches
from sentimill.plans.staging import stage

LONGEST = 4
LEAST = 30
FIRST = 2000
#: Words that a task gathers before it counts them.
GATHERED = 1 << 18
#: Occurrences in a hash partition, by the most words the texts can have.
PARTITION_MASS = 1 << 25
PARTITIONS = 1 << 16
#: Most bits of the filter (32 MB), bits for each survivor, and places of a key in it.
FILTER_BITS = 1 << 28
BITS_EACH = 16
PROBES = 3
#: Parts that a language's candidates are ranked in.
RANK_PARTS = 64

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_TO_STOP = bytes.maketrans(_SEPARATORS, b"." * len(_SEPARATORS))
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(numbers: np.ndarray) -> np.ndarray:
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return numbers ^ (numbers >> np.uint64(32))


class Gathered:
    """Words of texts one after the other, as numbers; 0 stands between pieces and after each text."""

    def __init__(self) -> None:
        self.numbers = array("i")
        self.known: dict[str, defaultdict] = {}
        self._next = count(1)

    def add(self, text: str, lang: str) -> None:
        if lang not in self.known:
            self.known[lang] = defaultdict(self._next.__next__, {b".": 0})
        # A separator is never inside a word, so a stop of its own can stand for the end of a piece.
        words = text.encode("utf-8", "surrogatepass").lower().translate(_TO_STOP).replace(b".", b" . ").split()
        self.numbers.extend(map(self.known[lang].__getitem__, words))
        self.numbers.append(0)

    def table(self) -> tuple[list[bytes], list[str]]:
        """The word and the language of every number."""
        size = 1 + sum(len(words) - 1 for words in self.known.values())
        words, langs = [b""] * size, [""] * size
        for lang, numbered in self.known.items():
            for word, number in numbered.items():
                if number:
                    words[number], langs[number] = word, lang
        return words, langs

    def phrases(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length: the starts of all phrases of it and their hashes."""
        numbers = np.array(self.numbers)
        words, langs = self.table()
        seeds = {lang: xxhash.xxh32_intdigest(lang.encode("utf-8", "surrogatepass")) for lang in self.known}
        of = xxhash.xxh64_intdigest
        hashes = np.array([of(w, seeds.get(lang, 0)) for w, lang in zip(words, langs, strict=True)], dtype=np.uint64)[numbers]
        inside = numbers > 0
        here, whole = inside, _mixed(hashes)
        for size in range(1, LONGEST + 1):
            if size > 1:
                here = here[:-1] & inside[size - 1 :]
                whole = _mixed(whole[:-1] * _FOLD + hashes[size - 1 :])
            starts = np.flatnonzero(here)
            yield size, starts, whole[starts]


def _gathered(frames: Iterator[pa.RecordBatch]) -> Iterator[Gathered]:
    now = Gathered()
    for frame in frames:
        for text, lang in zip(frame.column("text").to_pylist(), frame.column("lang").to_pylist(), strict=True):
            now.add(text, lang)
            if len(now.numbers) >= GATHERED:
                yield now
                now = Gathered()
    if now.numbers:
        yield now


@dataclass(frozen=True)
class Layout:
    """How hashes are dealt out: the number of partitions, and the bits of a key inside one.

    Twice as many keys as a partition has occurrences, so that few share one by chance.
    """

    partitions: int
    bits: int

    @classmethod
    def of(cls, mass: int) -> Layout:
        partitions = max(1, min(PARTITIONS, -(-mass // PARTITION_MASS)))
        return cls(partitions, min(32, 1 + (mass // partitions).bit_length()))

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """Partition and key of each hash, as one number."""
        part = (hashes >> np.uint64(32)) % np.uint64(self.partitions)
        return (part << np.uint64(32)) | (hashes & np.uint64((1 << self.bits) - 1))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"), F.coalesce("lang", F.lit("und")).alias("lang")).filter(
        F.length("text") > 0
    )


def _packed(keys: np.ndarray) -> bytes:
    """Sorted different keys as compressed gaps, the bytes of one weight together."""
    gaps = np.diff(keys, prepend=np.uint32(0))
    return pa.compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(4, n).T).view(np.uint32)[:, 0], dtype=np.uint32)


_RUN = "part int, mass long, n_once int, once binary, n_more int, more binary, counts binary"


def counted_keys(texts: DataFrame, layout: Layout) -> DataFrame:
    """part, mass, and the keys of what a task has gathered: those that occur once, and the others with their counts."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gathered in _gathered(frames):
            every = np.concatenate([layout.keys(hashes) for _, _, hashes in gathered.phrases()])
            if not len(every):
                continue
            every.sort()
            first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
            keys, counts = every[first], np.diff(first, append=len(every))
            part, low = (keys >> np.uint64(32)).astype(np.int32), keys.astype(np.uint32)
            edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
            rows = []
            for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                n, own = counts[begin:end], low[begin:end]
                more = n > 1
                once, several, sizes = own[~more], own[more], n[more].astype(np.uint32)
                rows.append((int(part[begin]), int(n.sum()), len(once), _packed(once), len(several), _packed(several), sizes.tobytes()))
            types = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary())
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[field.split()[0] for field in _RUN.split(", ")])

    return map_batches(texts, batches, _RUN)


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters that takes in other ones.

    The sums of both are lowered by the largest counter beyond the capacity, so every counter is too low by ``taken`` at most, and
    ``taken * (capacity + 1)`` is no more than the mass taken in.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._size += len(keys)
        # Merging costs the size of the summary, so as much is gathered first.
        if self._size > max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self._waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self._waiting]])
        self._waiting, self._size = [], 0
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first)
        if len(self.keys) > self.capacity:
            at = len(self.keys) - 1 - self.capacity
            off = int(np.partition(self.counts, at)[at])
            self.taken += off
            left = self.counts > off
            self.keys, self.counts = self.keys[left], self.counts[left] - off

    def survivors(self, least: int) -> np.ndarray:
        """The keys that may have a count of ``least``."""
        self.merge()
        return self.keys[self.counts + self.taken >= least]


def survivors(counted: DataFrame, layout: Layout, least: int = LEAST) -> DataFrame:
    """part and key of everything that may occur ``least`` times."""
    # A partition's mass comes before its runs, as a row of its own: one shuffle carries both.
    masses = counted.groupBy("part").agg(F.sum("mass").alias("mass")).withColumn("is_run", F.lit(False))
    dealt = (
        counted.withColumn("is_run", F.lit(True))
        .unionByName(masses, allowMissingColumns=True)
        .repartition(layout.partitions, "part")
        .sortWithinPartitions("part", "is_run")
    )

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, summary = None, None

        def done() -> pa.RecordBatch:
            keys = summary.survivors(least).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), part, np.int32)), pa.array(keys)], names=["part", "key"])

        for frame in frames:
            for row in frame.to_pylist():
                if not row["is_run"]:
                    if summary is not None:
                        yield done()
                    part, summary = row["part"], Summary(row["mass"] // least + 1)
                    continue
                summary.add(_unpacked(row["once"], row["n_once"]), np.ones(row["n_once"], np.int64))
                summary.add(_unpacked(row["more"], row["n_more"]), np.frombuffer(row["counts"], np.uint32).astype(np.int64))
        if summary is not None:
            yield done()

    return map_batches(dealt, batches, "part int, key long", rows=8)


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """The places of keys (with their partition) in a filter of ``bits`` bits, a power of two."""
    one = _mixed(keys * _FOLD)
    two = _mixed(one + _FOLD) | np.uint64(1)
    return [(one + np.uint64(i) * two) & np.uint64(bits - 1) for i in range(PROBES)]


def key_filter(found: DataFrame) -> np.ndarray:
    """The filter of all survivors, as words of 64 bits.  Its size, and so what is collected, is bounded by ``FILTER_BITS``."""
    wanted = max(1 << 16, found.count() * BITS_EACH)
    bits = min(FILTER_BITS, 1 << (wanted - 1).bit_length())

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            keys = frame.column("part").to_numpy().astype(np.uint64) << np.uint64(32) | frame.column("key").to_numpy().astype(np.uint64)
            places = np.unique(np.concatenate(_places(keys, bits)))
            word = (places >> np.uint64(6)).astype(np.int64)
            mask = (np.uint64(1) << (places & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask)], names=["word", "mask"])

    words = found.mapInArrow(batches, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    result = np.zeros(bits // 64, dtype=np.uint64)
    result[words.column("word").to_numpy()] = words.column("mask").to_numpy().view(np.uint64)
    return result


def _has(kept: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each key."""
    found = np.arange(len(keys))
    for places in zip(*[iter(_places(keys, len(kept) * 64))], strict=True):
        at = places[0][found]
        found = found[(kept[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0]
    result = np.zeros(len(keys), dtype=bool)
    result[found] = True
    return result


def phrase_counts(texts: DataFrame, kept: np.ndarray, layout: Layout, least: int = LEAST) -> DataFrame:
    """lang, size, phrase and f of every phrase that occurs ``least`` times."""
    shared = texts.sparkSession.sparkContext.broadcast(kept)

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gathered in _gathered(frames):
            numbers = np.array(gathered.numbers, dtype=np.int64)
            words, langs = gathered.table()
            for size, starts, hashes in gathered.phrases():
                starts = starts[_has(shared.value, layout.keys(hashes))]
                if not len(starts):
                    continue
                # Phrases of a size are told apart by their words' numbers, two at a time.
                code = numbers[starts]
                for i in range(1, size):
                    code = np.unique(code, return_inverse=True)[1] * np.int64(len(words)) + numbers[starts + i]
                _, first, n = np.unique(code, return_index=True, return_counts=True)
                at = starts[first].tolist()
                phrases = [b" ".join([words[w] for w in gathered.numbers[a : a + size]]).decode("utf-8", "surrogatepass") for a in at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([langs[gathered.numbers[a]] for a in at], pa.string()), pa.array(np.full(len(at), size, np.int32)),
                        pa.array(phrases, pa.string()), pa.array(n.astype(np.int64)),
                    ],
                    names=["lang", "size", "phrase", "n"],
                )

    counted = map_batches(texts, batches, "lang string, size int, phrase string, n long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, size, phrase and f of all phrases of 1 to ``LONGEST`` words that occur ``least`` times in a language."""
    texts, spark = _texts(docs), docs.sparkSession
    # Every word but a piece's last is followed by a separator.
    most = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    layout = Layout.of(most * LONGEST // 2)
    with batch_rows(spark):
        counted = stage(counted_keys(texts, layout), "counted-keys")
    with batch_rows(spark, 64):
        found = stage(survivors(counted, layout, least), "survivors")
    kept = key_filter(found)
    with batch_rows(spark):
        return stage(phrase_counts(texts, kept, layout, least), "phrases")


def _head(phrase: Column, k: Column) -> Column:
    return F.call_function("substring_index", phrase, F.lit(" "), k)


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score."""
    phrases = frequent_phrases(docs, least)
    every = phrases.select("lang", "phrase", "f")
    candidates = phrases.filter("size > 1").withColumnRenamed("f", "a")
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    parts = cut.withColumns(
        {"head": _head(F.col("phrase"), F.col("k")), "tail": _head(F.col("phrase"), F.col("k") - F.col("size"))}
    )
    heads = every.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = every.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    score = F.expr("cast((2000000 * cast(a AS decimal(20, 0))) div (cast(l AS decimal(20, 0)) + r) AS bigint)")
    scored = (
        parts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .withColumn("score", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    # The parts of longer candidates, with the most frequent of those that hold them.
    longer = candidates.filter("size > 2").select(
        "lang", F.col("a").alias("f"), "size", F.split("phrase", " ").alias("words"),
        F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length"),
    )
    inside = longer.select(
        "lang", "f", "words", "length", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("begin")
    ).select("lang", "f", F.array_join(F.slice("words", F.col("begin"), F.col("length")), " ").alias("phrase"))
    most = inside.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = (
        scored.join(most, ["lang", "phrase"], "left")
        .filter("most IS NULL OR 100 * cast(most AS decimal(20, 0)) < 80 * cast(a AS decimal(20, 0))")
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    # A language's candidates are ranked in parts first; only the first of each part meet.
    in_part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    best = kept.withColumn("part", part).withColumn("place", in_part).filter(F.col("place") <= first).drop("part", "place")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= first)
    return ranked.join(word_totals(docs), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def word_totals(docs: DataFrame) -> DataFrame:
    """lang and n, all its word occurrences."""
    words = F.regexp_count("text", F.lit(r"[^\x20\x09.,;:!?\x0A-\x0D]+"))
    return _texts(docs).groupBy("lang").agg(F.sum(words.cast("long")).alias("n"))
