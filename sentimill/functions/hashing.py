"""Repeatable pseudo-random values from row keys.

Each use has its own seed: two draws on one key must not be correlated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key


def digest(key: str | Column, seed: str) -> Column:
    """Hex md5 of the seeded key."""
    return F.md5(F.concat_ws(":", F.lit(seed), _column(key).cast("string")))


def unit(key: str | Column, seed: str) -> Column:
    """A value in [0, 1) fixed by the seeded key."""
    leading = F.substring(digest(key, seed), 1, 8)
    return F.conv(leading, 16, 10).cast("bigint") / F.lit(float(2**32))
