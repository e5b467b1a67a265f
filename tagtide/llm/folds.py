"""Held-out documents: a fifth of them, by the check sum of their id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is divisible by 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def hashed_share(bound: int, count: int, *columns: str) -> Column:
    """Picks about ``bound`` of ``count`` rows by a hash, all if there are no more."""
    if count <= bound:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.lit("sample"), *columns), F.lit(1_000_000)) < (1_000_000 * bound) // count
