"""Features of texts counted into a fixed number of places, and statistics of them over a corpus."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentimill.llm.common import is_held_out, map_batches
from sentimill.plans.staging import stage

#: Longest stretch of a text that is turned into numbers at once.
CHUNK = 1 << 20


def gram_places(codes: np.ndarray, longest: int, bits: int) -> list[np.ndarray]:
    """The place in a table of 2**bits of every gram of 1 to ``longest`` codes."""
    places, mixed = [], np.zeros(len(codes), dtype=np.uint32)
    for n in range(1, longest + 1):
        if len(codes) < n:
            break
        # Multiplicative hashing; the gram's length is part of it.
        mixed = mixed[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(n)
        spread = mixed * np.uint32(0x9E3779B1)
        places.append((spread ^ (spread >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - bits))
    return places


def document_frequencies(docs: DataFrame, counts: Callable[[str], np.ndarray], places: int) -> tuple[int, np.ndarray]:
    """How many documents there are, and how many have each place; from whole texts of all rows of ``docs``.

    A partition sends one sum for each place it has, so what reaches the driver is ``places`` numbers.
    """

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(places, dtype=np.int64)
        for frame in frames:
            for text in frame.column("text").to_pylist():
                n += 1
                total += counts(text or "") > 0
        used = np.flatnonzero(total)
        place = np.r_[-1, used].astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.r_[n, total[used]])], names=["place", "n"])

    rows = (
        map_batches(docs.select("text"), batches, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    )
    found = {row["place"]: row["n"] for row in rows}
    result = np.zeros(places, dtype=np.int64)
    for place, n in found.items():
        if place >= 0:
            result[place] = n
    return found.get(-1, 0), result


def inverse(n: int, frequencies: np.ndarray) -> np.ndarray:
    """Smoothed inverse document frequencies."""
    return (np.log((1.0 + n) / (1.0 + frequencies)) + 1.0).astype(np.float32)


def learnable(docs: DataFrame) -> DataFrame:
    """The documents a model may learn from: with an id, outside the held-out third."""
    return docs.filter(F.col("doc_id").isNotNull() & ~is_held_out())


#: Rows every class may have in a sample, however many classes there are.
CLASS_ROWS = 5


def water_level(counts: list[tuple[int, int]], size: int) -> int:
    """The most rows of a class such that classes cut to it have about ``size`` rows; what small classes leave goes to the others.

    ``counts``: (rows, number of classes with so many).
    """
    left, classes = size, sum(n for _, n in counts)
    for rows, n in sorted(counts):
        share = left // classes
        if rows > share:
            return max(CLASS_ROWS, share)
        left -= rows * n
        classes -= n
    return max([CLASS_ROWS, *[rows for rows, _ in counts]])


def class_sample(rows: DataFrame, label: str, size: int) -> DataFrame:
    """At most ``size`` different rows and ``CLASS_ROWS`` more for each value of ``label``, written; every value has rows in it.

    ``rows`` are narrow: keys and labels, no texts.  Small classes are taken whole, the others have equal shares of what is left.  Rows are drawn by
    their hash, the same in every run.  Only rows whose hash is below a cut, about twice a class's quota, are ranked.
    """
    sizes = stage(rows.groupBy(label).agg(F.count("*").alias("_n")), "class-sizes")
    # Larger classes are alike for the level, so few different sizes come to the driver.
    alike = sizes.groupBy(F.least("_n", F.lit(size)).alias("rows")).agg(F.count("*").alias("classes")).collect()
    each = water_level([(r["rows"], r["classes"]) for r in alike], size)
    cut = sizes.select(label, (F.lit(float(2 * each + 20)) / F.col("_n")).alias("_cut"))
    draw = F.xxhash64(*[F.col(c) for c in rows.columns], F.lit("sample"))
    drawn = rows.join(cut, label).withColumn("_draw", draw).filter(F.col("_draw") / 2.0**64 + 0.5 < F.col("_cut"))
    place = F.row_number().over(Window.partitionBy(label).orderBy("_draw", *[c for c in rows.columns if c != label]))
    ranked = drawn.distinct().withColumn("_place", place).filter(F.col("_place") <= each)
    return stage(ranked.select(*rows.columns), "drawn")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int) -> list[tuple[int, str]]:
    """(label, text) of documents drawn from ``labels`` (doc_id and a label of few values).

    The draw is bounded by ``size`` and ``CLASS_ROWS`` a value, so it is broadcast and no text is shuffled but those drawn.  Each drawn id has
    one text: of repeated ids the one with the least hash.
    """
    drawn = class_sample(labels.select("doc_id", label), label, size)
    met = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    rows = met.groupBy("doc_id", label).agg(least).select(label, "one.text").collect()
    return sorted((row[label], row["text"] or "") for row in rows)
