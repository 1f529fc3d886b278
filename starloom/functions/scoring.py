"""RFM scoring expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed segment names, in rule order (first match wins).
CHAMPIONS, LOYAL, AT_RISK, LOST = "Champions", "Loyal", "At Risk", "Lost"


def quartile_cuts(n: int) -> list[int]:
    """The last 1-based rank of the scores 1, 2 and 3 among ``n`` rows.

    Equal to cutting the ranks into four bins at the interpolated quartile
    edges ``1 + k(n−1)/4``; a single row scores 1.
    """
    return [1 + k * (n - 1) // 4 for k in (1, 2, 3)] if n else []


def quartile_score(beyond: list[Column]) -> Column:
    """Score 1–4: one more for each cut that the row lies beyond."""
    total = F.lit(1)
    for b in beyond:
        total = total + b.cast("int")
    return total.cast("smallint")


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    return (F.when((r >= 3) & (f >= 3) & (m >= 3), F.lit(CHAMPIONS))
             .when(((f >= 3) & (m >= 3)) | ((r >= 3) & (f >= 2)), F.lit(LOYAL))
             .when((r <= 2) & (f >= 2), F.lit(AT_RISK))
             .otherwise(F.lit(LOST)))
