"""Seeded choices as plain columns: the same seed and key always draw the same."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 hex digits are 60 bits, which fit a BIGINT.
_HEX_DIGITS = 15


def seed_hash(seed: int, *keys: Column) -> Column:
    """md5 of ``seed:key:key...``, the sort key of every seeded order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[key.cast("string") for key in keys]))


def hash_number(hashed: Column) -> Column:
    """A non-negative BIGINT from the leading digits of an md5."""
    return F.conv(F.substring(hashed, 1, _HEX_DIGITS), 16, 10).cast("bigint")


def pick(items: Column, seed: int, *keys: Column) -> Column:
    """One element of an array, drawn by seed and key; NULL from an empty array."""
    drawn = F.pmod(hash_number(seed_hash(seed, *keys)), F.size(items).cast("bigint"))
    return F.when(F.size(items) > 0, F.get(items, drawn.cast("int")))
