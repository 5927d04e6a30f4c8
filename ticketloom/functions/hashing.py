"""Keyed hashes that stand in for random draws.

``md5(seed|a|b...)`` gives the same value in any partitioning and in any SQL engine, so
every sampling result can be reproduced row by row elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_DIGITS = 8
WIDE_DIGITS = 15


def keyed_hash(seed: int | str, *parts: Column) -> Column:
    """Hex md5 over the seed and the parts, joined by ``|``."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hash_unit(digest: Column) -> Column:
    """A number in [0, 1) from the first 8 hex digits."""
    return F.conv(F.substring(digest, 1, UNIT_DIGITS), 16, 10).cast("bigint") / F.lit(float(16**UNIT_DIGITS))


def hash_below(digest: Column, bound: Column) -> Column:
    """A whole number in [0, bound) from the first 15 hex digits."""
    return F.pmod(F.conv(F.substring(digest, 1, WIDE_DIGITS), 16, 10).cast("bigint"), bound)
