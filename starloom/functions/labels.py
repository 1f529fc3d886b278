"""Display labels: compact money / number strings, bands and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed label values.
DISCOUNT_BANDS = [
    (0.0, "0  No Discount"),   # discount_pct = 0
    (0.10, "1  1–10%"),        # <= 0.10
    (0.20, "2  11–20%"),       # <= 0.20
    (0.30, "3  21–30%"),       # <= 0.30
]
DISCOUNT_BAND_TOP = "4  30%+"
PREMIUM_LABEL = "Premium"
STANDARD_LABEL = "Standard"


def _fixed(c: Column, digits: int) -> Column:
    # Round half-even first so the Java formatter has nothing left to round.
    return F.format_string(f"%.{digits}f", F.bround(c, digits))


def _grouped0(c: Column) -> Column:
    return F.format_number(F.bround(c, 0), 0)


def money_label(v: Column) -> Column:
    """``$1.25M`` / ``$1.0K`` / ``$999`` (negative values take the last form)."""
    v = v.cast("double")
    return (F.when(v >= 1_000_000, F.concat(F.lit("$"), _fixed(v / 1_000_000, 2), F.lit("M")))
             .when(v >= 1_000, F.concat(F.lit("$"), _fixed(v / 1_000, 1), F.lit("K")))
             .otherwise(F.concat(F.lit("$"), _grouped0(v))))


def number_label(v: Column) -> Column:
    """``1.2M`` / ``3.4K`` / ``999``."""
    v = v.cast("double")
    return (F.when(v >= 1_000_000, F.concat(_fixed(v / 1_000_000, 1), F.lit("M")))
             .when(v >= 1_000, F.concat(_fixed(v / 1_000, 1), F.lit("K")))
             .otherwise(_grouped0(v)))


def pct_label(v: Column) -> Column:
    """``12.3%``."""
    return F.concat(_fixed(v.cast("double"), 1), F.lit("%"))


def discount_band(discount: Column) -> Column:
    """Sort-prefixed band label; the first band is an equality test."""
    def dec(v: float) -> Column:
        return F.lit(f"{v:.2f}").cast("decimal(10,2)")

    first_val, first_label = DISCOUNT_BANDS[0]
    expr = F.when(discount == dec(first_val), F.lit(first_label))
    for upper, label in DISCOUNT_BANDS[1:]:
        expr = expr.when(discount <= dec(upper), F.lit(label))
    return expr.otherwise(F.lit(DISCOUNT_BAND_TOP))


def premium_label(flag: Column) -> Column:
    """``Premium`` for true, ``Standard`` for false or NULL."""
    return F.when(flag, F.lit(PREMIUM_LABEL)).otherwise(F.lit(STANDARD_LABEL))
