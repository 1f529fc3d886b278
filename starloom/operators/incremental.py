"""Key checks that look only at what a load changes.

A summary holds one row for each range of ``KEYS`` key values: rows, different keys, keys that occur more
than once, least and largest key; or, for a foreign key, the rows without a parent. It is stored beside its
table. A load recounts the ranges that its own keys lie in, over the stored rows of these ranges and the load, and
leaves all other ranges as they are. Stored rows are read behind bounds on the key, which row-group statistics
serve where the table follows it; new surrogate keys lie behind all stored ones, so their load reads next to nothing.

Keys are whole numbers. NULL is a range of its own (for unique keys it counts as one value, and a foreign key that is
NULL is no orphan). Results are those of ``quality.unique_violations`` and ``foreign_key_violations`` on the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = 1 << 16  # key values of a range


def _bucket(key: str) -> Column:
    return F.floor(F.col(key) / F.lit(KEYS)).cast("long")


def _in_buckets(rows: DataFrame, key: str, buckets: DataFrame) -> DataFrame:
    """The ``key`` values of ``rows`` that lie in ``buckets`` (bucket), read behind bounds on the key."""
    ends = buckets.agg(F.min("bucket").alias("low"), F.max("bucket").alias("high"), F.count_if(F.col("bucket").isNull()).alias("none")).first()
    near = F.col(key).between(ends.low * KEYS, (ends.high + 1) * KEYS - 1) if ends.low is not None else F.lit(False)
    near = near | F.col(key).isNull() if ends.none else near
    here = rows.where(near).select(key, _bucket(key).alias("_bucket"))
    return here.join(buckets, F.col("_bucket").eqNullSafe(F.col("bucket")), "left_semi").select(key)


def _without(summary: DataFrame, buckets: DataFrame) -> DataFrame:
    other = buckets.select(F.col("bucket").alias("_other"))
    return summary.join(other, F.col("bucket").eqNullSafe(F.col("_other")), "left_anti")


# ── unique keys ───────────────────────────────────────────────────────────────

def key_summary(rows: DataFrame, key: str) -> DataFrame:
    """(bucket, rows, keys, duplicates, low, high) of a table's key column."""
    each = rows.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy(_bucket("key").alias("bucket")).agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 1).alias("duplicates"), F.min("key").alias("low"), F.max("key").alias("high"))


def key_summary_after(summary: DataFrame, stored: DataFrame, batch: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The summary after ``batch`` joins the ``stored`` rows, and the stored keys that are read for it."""
    buckets = batch.select(_bucket(key).alias("bucket")).distinct()
    read = _in_buckets(stored, key, buckets)
    return _without(summary, buckets).unionByName(key_summary(read.unionByName(batch.select(key)), key)), read


def duplicates(summary: DataFrame) -> DataFrame:
    return summary.agg(F.coalesce(F.sum("duplicates"), F.lit(0)).cast("long").alias("violations"))


# ── foreign keys ──────────────────────────────────────────────────────────────

def orphan_summary(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(bucket, orphans): rows of ``child`` whose key has no parent, where there are any."""
    counts = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias("key")).distinct()
    return counts.join(known, "key", "left_anti").groupBy(_bucket("key").alias("bucket")).agg(F.sum("n").alias("orphans"))


def orphans_after_child(summary: DataFrame, batch: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """After rows of the child: only the batch and the parents in its ranges are read."""
    buckets = batch.where(F.col(key).isNotNull()).select(_bucket(key).alias("bucket")).distinct()
    more = orphan_summary(batch, key, _in_buckets(parent, parent_key, buckets), parent_key)
    return summary.unionByName(more).groupBy("bucket").agg(F.sum("orphans").alias("orphans"))


def orphans_after_parent(summary: DataFrame, child: DataFrame, key: str, parent: DataFrame, new_parents: DataFrame, parent_key: str) -> tuple[DataFrame, DataFrame]:
    """After rows of the parent (``parent`` has them already): ranges with orphans that got new parents are recounted.
    Also the child keys that are read for it."""
    buckets = new_parents.select(_bucket(parent_key).alias("bucket")).distinct().join(summary.where("orphans > 0").select("bucket"), "bucket")
    read = _in_buckets(child, key, buckets)
    return _without(summary, buckets).unionByName(orphan_summary(read, key, _in_buckets(parent, parent_key, buckets), parent_key)), read


def orphans(summary: DataFrame) -> DataFrame:
    return summary.agg(F.coalesce(F.sum("orphans"), F.lit(0)).cast("long").alias("violations"))
