"""A small table of terms as one value, looked up inside the rows that hold the terms.

The table is a hash table of built-in types, an array of slots that each hold a few entries.  It is a constant of the
query (Spark allows no subquery inside ``transform``), travels to the executors once with it and is read in place, so no
row is shuffled or exploded.  It passes through the driver as JSON, which is why it must be within the broadcast limit.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def broadcast_limit(df: DataFrame) -> int:
    """Bytes Spark broadcasts at most by its own choice; negative: it never does."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").lower()).groups()
    return int(number) * _UNITS[unit]


def fits_broadcast(terms: DataFrame) -> bool:
    """Whether the table, measured, is within Spark's broadcast limit."""
    fixed = 8 * (len(terms.columns) + 2)
    size = terms.agg(F.coalesce(F.sum(F.octet_length("term") + F.lit(fixed)), F.lit(0))).first()[0]
    return size <= broadcast_limit(terms)


class TermTable:
    """``terms`` (one row a term) with the numbers ``values``, by name, as one value.

    Only for tables within ``fits_broadcast``.
    """

    def __init__(self, terms: DataFrame, values: Mapping[str, Column]):
        self.names = list(values)
        # Two entries a slot on average.
        self.slots = max(1, terms.count() // 2)
        entry = F.struct("term", *[c.alias(name) for name, c in values.items()])
        filled = terms.groupBy(self._slot(F.col("term")).alias("slot")).agg(F.collect_list(entry).alias("entries"))
        every = terms.sparkSession.range(self.slots).select(F.col("id").cast("int").alias("slot"))
        whole = every.join(filled, "slot", "left").agg(F.array_sort(F.collect_list(F.struct("slot", "entries"))).alias("all"))
        entries = whole.select(F.col("all.entries").alias("entries"))
        # Folded to a constant when the query is planned.
        self.table = F.from_json(F.lit(entries.select(F.to_json("entries")).first()[0]), entries.schema["entries"].dataType)

    def _slot(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.slots)).cast("int")

    def found(self, counts: Column) -> Column:
        """The entries of ``counts`` (term, tf) that the table knows, with their values."""

        def known(one: Column) -> Column:
            same = F.filter(F.get(self.table, self._slot(one["term"])), lambda entry: entry["term"] == one["term"])
            return F.transform(same, lambda entry: F.struct(one["tf"].alias("tf"), *[entry[n].alias(n) for n in self.names]))

        matches = F.transform(counts, known)
        return F.flatten(F.filter(matches, lambda m: F.size(m) > 0))
