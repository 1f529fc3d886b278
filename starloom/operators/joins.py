"""Broadcast only behind a proof of size.

Dimensions that grow with the data (customers, products) are never forced into a
broadcast; AQE converts a join to a broadcast only from measured sizes. A side is
broadcast explicitly only when its row count is known from how it was built.

``joined_by_key`` takes the keys that hold a large share of the rows out of a join's shuffle: they are
few by arithmetic, so their rows of the other side can be broadcast, and the rows that have them stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_bounded_by_construction(df: DataFrame, row_bound: int, max_rows: int) -> DataFrame:
    """Broadcast a side whose row count is known from how it was built.

    ``row_bound`` is a proof computed from parameters (e.g. the number of days in
    a calendar range), not an estimate; no extra job is run.
    """
    return F.broadcast(df) if row_bound <= max_rows else df


# A key is heavy if it holds more than this share of the rows, so at most 1 / HEAVY_SHARE keys are.
HEAVY_SHARE = 0.005
# Keys that the frequent-items sketch keeps count of: enough that none above the share is missed.
TRACKED = 10_000


def heavy_keys(df: DataFrame, key: str) -> list:
    """The keys that hold more than ``HEAVY_SHARE`` of the rows, by a sketch over that column alone."""
    most = int(1 / HEAVY_SHARE)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {TRACKED})").alias("top")).first()
    return [t["item"] for t in row.top or [] if t["item"] is not None and t["count"] > HEAVY_SHARE * row.n]


def joined_by_key(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """``df`` left-joined with ``dim`` (unique ``key``) such that no key's rows gather in one task.

    Heavy keys meet the at most 1 / HEAVY_SHARE rows that ``dim`` has of them by broadcast, together with the rows
    without a key; the rest is joined as usual. It does not rely on skew handling at run time.
    """
    heavy = heavy_keys(df, key)
    if not heavy:
        return df.join(dim, key, "left")
    held = F.col(key).isin(heavy)
    few = F.broadcast(dim.where(held))   # one row a key
    common = df.where(held | F.col(key).isNull()).join(few, key, "left")
    return common.unionByName(df.where(~held).join(dim, key, "left"))
