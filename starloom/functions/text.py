"""String expressions used by the dimensions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode-aware whitespace at either end; ``trim`` would only strip blanks.
_OUTER_WS = r"(?U)^\s+|\s+$"


def strip_all(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (tabs, newlines, …)."""
    return F.regexp_replace(c, _OUTER_WS, "")


def normalize_email(c: Column) -> Column:
    """Lower-case, then strip surrounding whitespace."""
    return strip_all(F.lower(c))


def singular(c: Column) -> Column:
    """Drop one trailing ``s`` (``Laptops`` → ``Laptop``)."""
    return F.when(c.endswith("s"), c.substr(F.lit(1), F.length(c) - 1)).otherwise(c)


def capitalize(c: Column) -> Column:
    """First character upper case, the rest lower case (``initcap`` works per word)."""
    return F.concat(F.upper(c.substr(1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def first_token(c: Column) -> Column:
    """First whitespace-separated word."""
    return F.split(strip_all(c), r"\s+").getItem(0)


def product_name(word: Column, subcategory: Column) -> Column:
    """Display name built from a word and the singular sub-category."""
    return F.concat(capitalize(word), F.lit(" "), singular(subcategory))


def full_name(first: Column, last: Column) -> Column:
    """``first || ' ' || last``; NULL when either side is NULL (unlike concat_ws)."""
    return F.concat(first, F.lit(" "), last)


def strip_sort_prefix(c: Column, prefix_len: int = 3) -> Column:
    """Drop a fixed-width sort prefix such as ``'1  '``."""
    return c.substr(F.lit(prefix_len + 1), F.length(c))
