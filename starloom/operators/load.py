"""Write operators: create-if-absent, append, insert-if-absent and upsert.

Each merge is a pure DataFrame function (target, source) → new table contents,
so it can be planned, tested and checked like any query. The writers persist the
result for plain Parquet tables (no transactional table format is assumed):

* ``append_to`` appends files — like the warehouse's fact load it is not
  idempotent; a second run of the same batch duplicates the rows;
* ``replace_with`` writes the merged contents to a new version folder; the caller
  repoints the table to it (the pipeline uses ``ALTER TABLE … SET LOCATION``), so a
  path that is still being read is never overwritten.

Merges reject a source without a key, upserts also one that holds a key twice (a
database upsert fails on "cannot affect row a second time"); the checks read only
the source.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import files
from .ranking import global_rank, keep_first
from .stage import materialize


class DuplicateSourceKey(ValueError):
    pass


class NullSourceKey(ValueError):
    pass


# ── identifiers ───────────────────────────────────────────────────────────────

def next_id(target: DataFrame, id_col: str) -> int:
    """1 + the largest id in ``target`` (1 for an empty table)."""
    top = target.agg(F.max(id_col)).first()[0]
    return 1 if top is None else int(top) + 1


def with_sequence_ids(df: DataFrame, id_col: str, start: int) -> DataFrame:
    """Add a unique, increasing 64-bit id ≥ ``start`` (a sequence: unique, not gap-free).

    Computed per write task without any shuffle or global sort; a retried task
    re-assigns the same range to its own rows only.
    """
    return df.select((F.monotonically_increasing_id() + F.lit(start)).alias(id_col), *df.columns)


# ── merges ────────────────────────────────────────────────────────────────────

def appended(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target followed by every batch row (no de-duplication)."""
    return target.unionByName(batch.select(*target.columns))


def inserted_if_absent(target: DataFrame, source: DataFrame, key: str, order_col: str) -> DataFrame:
    """Insert source rows whose ``key`` is not in the target; existing rows stay as
    they are. Within the source the first row per key wins: the one with the lowest
    ``order_col``, which must be unique among the rows of a key. A NULL key raises."""
    assert_no_null_key(source, key)
    src = keep_first(source.select(*target.columns), key, order_col)
    return target.unionByName(src.join(target.select(key), key, "left_anti"))


def replaced_dates(target: DataFrame, batch: DataFrame, date_col: str) -> DataFrame:
    """The repeat-safe append: target rows of the batch's dates make way for the batch, so that
    loading a batch again changes nothing."""
    dates = batch.select(date_col).where(F.col(date_col).isNotNull()).distinct()
    return target.join(dates, date_col, "left_anti").select(*target.columns).unionByName(batch.select(*target.columns))


def assert_no_null_key(df: DataFrame, key: str | Sequence[str]) -> None:
    keys = [key] if isinstance(key, str) else list(key)
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    if not df.where(missing).isEmpty():
        raise NullSourceKey(f"source holds a row without {', '.join(keys)}")


def assert_unique_key(df: DataFrame, key: str | Sequence[str]) -> None:
    keys = [key] if isinstance(key, str) else list(key)
    assert_no_null_key(df, keys)
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).limit(1).collect()
    if dup:
        raise DuplicateSourceKey(f"source holds key {tuple(dup[0][k] for k in keys)} more than once")


def upserted(target: DataFrame, source: DataFrame, key: str, update_cols: Sequence[str],
             new_key: tuple[str, str] | None = None, check_unique: bool = True, start: int | None = None) -> DataFrame:
    """Insert-or-update on ``key``.

    Matched rows take ``update_cols`` from the source and keep every other column
    of the target; unmatched source rows are inserted whole; target rows absent
    from the source stay unchanged. ``new_key=(key_col, order_col)`` gives inserted
    rows a surrogate key after the largest stored one, numbered by ``order_col``
    (instead of trusting a key computed against another snapshot); ``start`` is the first such key
    where the caller knows it, so that the target is not read for it.
    One full outer join on the key; no per-row lookups.
    """
    if check_unique:
        assert_unique_key(source, key)
    cols = target.columns
    update = set(update_cols)
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in cols if c in source.columns], F.lit(True).alias("_s"))
    j = t.join(s, F.col(f"t_{key}") == F.col(f"s_{key}"), "full_outer")
    hit_s, hit_t = F.col("_s").isNotNull(), F.col("_t").isNotNull()

    def pick(c: str) -> Column:
        sc = F.col(f"s_{c}") if c in source.columns else F.lit(None).cast(target.schema[c].dataType)
        if c == key:
            return F.coalesce(F.col(f"t_{c}"), sc).alias(c)
        if c in update:
            return F.when(hit_s, sc).otherwise(F.col(f"t_{c}")).alias(c)
        return F.when(hit_t, F.col(f"t_{c}")).otherwise(sc).alias(c)

    merged = j.select(*[pick(c) for c in cols], hit_t.alias("_old"))
    if new_key is None:
        return merged.drop("_old")
    # materialised once: both the kept rows and the newly keyed rows come from it
    merged = materialize(merged, "upsert-merged")
    key_col, order_col = new_key
    start = (next_id(target, key_col) if start is None else start) - 1
    old = merged.filter(F.col("_old")).drop("_old")
    new = merged.filter(~F.col("_old")).drop("_old", key_col)
    ranked, _ = global_rank(new, [(order_col, True)], out="_n")
    new = ranked.withColumn(key_col, (F.col("_n") + F.lit(start)).cast(target.schema[key_col].dataType)).drop("_n")
    return old.unionByName(new.select(*cols))


# ── table storage ─────────────────────────────────────────────────────────────

def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Create an empty Parquet table with ``schema`` unless ``path`` holds one."""
    if not files.exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def append_to(path: str, batch: DataFrame, id_col: str | None = None) -> int:
    """Append ``batch`` to the table at ``path``; with ``id_col``, assign sequence ids
    after the largest stored one. Returns the number of rows written. A table that
    exists and cannot be read raises; only an absent one starts at 1."""
    spark = batch.sparkSession
    if id_col:
        start = next_id(spark.read.parquet(path), id_col) if files.exists(spark, path) else 1
        batch = with_sequence_ids(batch, id_col, start)
    obs = Observation(f"append_to_{uuid.uuid4().hex}")
    batch.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return int(obs.get["rows"])


def replace_with(table_root: str, merged: DataFrame) -> str:
    """Write ``merged`` as a new version under ``table_root`` and return its path.

    Readers of the previous version are unaffected; the caller re-reads the
    returned path (the version folder is the commit point).
    """
    path = f"{table_root.rstrip('/')}/v-{uuid.uuid4().hex}"
    merged.write.mode("errorifexists").parquet(path)
    return path
