"""Money arithmetic and report metrics.

Amounts stay DECIMAL end to end, so sums are exact and rounding is HALF_UP as in a
SQL NUMERIC column; rounded metrics are DECIMAL too. Only unrounded ratios and
averages are DOUBLE, computed from exact sums.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources import schemas as S


def _cent() -> Column:
    return F.lit(0.01).cast("decimal(3,2)")


def discount_amount(unit_price: Column, discount_pct: Column) -> Column:
    """``round(unit_price × discount_pct / 100, 2)``; ×0.01 keeps it exact."""
    return F.round(unit_price * discount_pct * _cent(), 2).cast(S.MONEY)


def line_metrics(unit_price: Column, unit_cost: Column, discount_pct: Column,
                 quantity: Column) -> dict[str, Column]:
    """The five derived line amounts, in dependency order (use with ``withColumns``
    one after another, or through :func:`with_line_metrics`)."""
    return {
        "discount_amt": discount_amount(unit_price, discount_pct),
        "net_price": (unit_price - F.col("discount_amt")).cast(S.MONEY),
        "revenue": F.round(F.col("net_price") * quantity, 2).cast(S.AMOUNT),
        "cogs": F.round(unit_cost * quantity, 2).cast(S.AMOUNT),
        "gross_profit": (F.col("revenue") - F.col("cogs")).cast(S.AMOUNT),
    }


def unit_cost_from_ratio(unit_price: Column, cost_ratio: Column) -> Column:
    """``round(unit_price × cost_ratio, 2)``."""
    return F.round(unit_price * cost_ratio, 2).cast(S.MONEY)


def margin_pct(unit_price: Column, unit_cost: Column) -> Column:
    """``round((price − cost) / price × 100, 1)``; NULL for a zero price."""
    return F.round(F.try_divide((unit_price - unit_cost) * F.lit(100), unit_price), 1).cast(S.MARGIN)


# Margin tiers: right-closed bins on margin_pct; anything outside (or NULL) is 'nan'.
MARGIN_TIERS = [(0, 30, "Low"), (30, 50, "Medium"), (50, 70, "High"), (70, 100, "Premium")]
MARGIN_TIER_OUTSIDE = "nan"


def margin_tier(m: Column) -> Column:
    expr = None
    for lo, hi, label in MARGIN_TIERS:
        cond = (m > F.lit(lo)) & (m <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(MARGIN_TIER_OUTSIDE))


# ── aggregate metrics ─────────────────────────────────────────────────────────

def money_sum(c: Column | str, scale: int = 2) -> Column:
    """``ROUND(SUM(c), scale)``, exact."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(F.sum(c), scale)


def exact_avg(c: Column | str, scale: int, integral: bool = False) -> Column:
    """``ROUND(AVG(c), scale)`` computed as decimal SUM ÷ COUNT, rounded once, HALF_UP.

    ``avg`` on a decimal would round to 4 extra digits first and then round again;
    dividing the exact sum keeps 18 fractional digits, so the single HALF_UP
    rounding decides. ``integral`` marks an integer column (its sum is widened
    to DECIMAL(20,0) so the quotient is decimal, not double).
    """
    c = F.col(c) if isinstance(c, str) else c
    s = F.sum(c)
    if integral:
        s = s.cast("decimal(20,0)")
    return F.round(s / F.count(c), scale)


def exact_avg_from(total: Column, count: Column, scale: int) -> Column:
    """``ROUND(total / count, scale)`` for an exact (decimal or integer) total and a
    row count — the average rebuilt from partial sums and counts."""
    return F.round(total.cast("decimal(32,4)") / F.nullif(count, F.lit(0)).cast("decimal(20,0)"), scale)


def exact_ratio_pct(num: Column, den: Column, scale: int = 1) -> Column:
    """``ROUND(num / NULLIF(den, 0) * 100, scale)`` in decimal.

    ``num`` and ``den`` are exact aggregates (decimal or integer).
    """
    return F.round((num * F.lit(100)) / F.nullif(den, F.lit(0)), scale)


def float_ratio(num: Column, den: Column, factor: float | None = None) -> Column:
    """Unrounded ``num / NULLIF(den, 0) [* factor]`` in DOUBLE."""
    r = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return r * F.lit(float(factor)) if factor is not None else r


def float_avg(c: Column | str, factor: float | None = None) -> Column:
    """Unrounded ``AVG(c) [* factor]`` in DOUBLE (SUM cast to double ÷ COUNT)."""
    c = F.col(c) if isinstance(c, str) else c
    r = F.sum(c).cast("double") / F.count(c)
    return r * F.lit(float(factor)) if factor is not None else r
