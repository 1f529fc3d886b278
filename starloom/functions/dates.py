"""Calendar expressions (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """``YYYYMMDD`` as an integer."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week(d: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(d)


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5


def is_month_start(d: Column) -> Column:
    return F.dayofmonth(d) == 1


def is_month_end(d: Column) -> Column:
    return F.last_day(d) == d


def is_quarter_end(d: Column) -> Column:
    return (F.last_day(d) == d) & (F.month(d) % 3 == 0)


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def iso_week(d: Column) -> Column:
    return F.weekofyear(d)


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def month_label(d: Column) -> Column:
    """``YYYY-MM`` of the month containing ``d``."""
    return F.date_format(F.trunc(d, "MM"), "yyyy-MM")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)
