"""Joins with a few heavy keys.

A shuffled join sends all rows of a key to one task.  Here a mergeable frequent-items sketch finds the keys that hold more than a share
of all rows (there are fewer than 1 / share of them); their rows stay where they are and meet the few matching rows of the other side
by a broadcast, the remaining rows go through the shuffled join, where no key is heavy any more.  It does not rely on adaptive
splitting, and the result is that of the plain join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 0.01


def heavy_keys(rows: DataFrame, key: str, share: float = SHARE) -> list:
    """Keys that hold at least ``share`` of the rows (a few lighter ones may be among them); fewer than 2 / share + 1 values.

    One pass; every task sends a sketch of bounded size.  The sketch's counts are off by less than ``share`` / 2 of the rows.
    """
    most = math.ceil(2 / share)
    tracked = max(64, 1 << math.ceil(math.log2(4 * most)))
    found = rows.filter(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top"), F.count("*").alias("n")).first()
    return [r["item"] for r in found.top or [] if r["count"] >= share / 2 * found.n]


def join_heavy(rows: DataFrame, dim: DataFrame, key: str, share: float = SHARE, heavy: list | None = None, on: list[str] | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``dim`` (one row per ``key``) that no heavy key gathers in one task.

    ``on`` names the columns of a composite key; ``key`` is then the one of them that tells nearly all values apart, such as a hash.
    """
    on = on or [key]
    heavy = heavy_keys(rows, key, share) if heavy is None else heavy
    if not heavy:
        return rows.join(dim, on)
    hit = F.coalesce(F.col(key).isin(heavy), F.lit(False))
    few = F.broadcast(dim.filter(F.col(key).isin(heavy)))  # at most one row per heavy key
    return rows.filter(~hit).join(dim, on).unionByName(rows.filter(hit).join(few, on))
