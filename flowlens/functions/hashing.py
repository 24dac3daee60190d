"""Repeatable pseudo-random choices from an md5 of (seed, key): same answer in any engine or run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hex(seed: int | str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit(""))))


def share_threshold(share: float) -> str:
    """First eight hex digits below this text make up `share` of all hashes (0 < share < 1)."""
    return format(int(share * 2**32), "08x")


def in_share(seed: int | str, key: Column, share: float) -> Column:
    share = max(0.0, min(1.0, float(share)))
    if share in (0.0, 1.0):
        return F.lit(share == 1.0)
    return F.substring(seeded_hex(seed, key), 1, 8) < F.lit(share_threshold(share))
