"""Parquet tables whose loads rewrite only the files they change.

A table is a folder of data files and a folder of manifests. The newest manifest names the files that
make up the table and the next free id; a load writes new files beside the old ones and then one new
manifest, so it happens whole or not at all, and readers of the version before are undisturbed.

* ``append`` adds files. Ids continue at the manifest's mark, which moves with the same commit: stored
  ids are never read, and a load that died half way has used none.
* ``replace`` is the repeat-safe append: rows with the batch's values (of its dates, say) make way for it.
* ``upsert`` and ``insert_absent`` merge on a key.

``replace`` and ``upsert`` find the files that hold a value of the batch by a scan of that column alone,
bounded by the batch's smallest and largest value, which row-group statistics and the partition folders serve. Only
those files are read whole and written again. That pays where the files are clustered by the column: files are
written by partition and in the table's order.

One writer at a time: of two loads that start from one version the second to commit raises
:class:`ConcurrentLoad` and changes nothing. The driver holds file names, never rows.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import files
from ..sources import schemas as S
from . import load as LD

_BATCH = "load"  # the folder of a load's files is a partition folder, so all of a table's files have one base
_FILE = f"{_BATCH}=[0-9a-f]{{32}}/.*$"
# Folders that a task writes side by side; it sorts the rows of further ones by folder.
OPEN_FOLDERS = 64
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextlib.contextmanager
def _side_by_side(spark: SparkSession):
    """Within, tasks keep a file open for each partition folder instead of sorting their rows by folder."""
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, str(OPEN_FOLDERS))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


class ConcurrentLoad(RuntimeError):
    pass


@dataclass(frozen=True)
class Version:
    """What a manifest says: number, data files (relative), and the next free id."""

    number: int = 0
    files: tuple[str, ...] = ()
    next_id: int = 1


@dataclass
class FileTable:
    """``partition`` is the name and SQL expression of a column to write folders by, ``order`` sorts the rows of a file."""

    spark: SparkSession
    root: str
    schema: T.StructType
    partition: tuple[str, str] | None = None
    order: Sequence[str | Column] = ()
    rows_per_file: int | None = None
    loaded: dict = field(default_factory=dict)  # of the last load: files written and files left as they were

    def _folder(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    # ── versions ──────────────────────────────────────────────────────────────

    def version(self) -> Version:
        """The newest version; an empty one for a new table."""
        names = [n for n in files.folders(self.spark, self._folder("manifests")) if not n.startswith((".", "_"))]
        return self._manifest(names[-1]) if names else Version()

    def _manifest(self, name: str) -> Version:
        text = json.loads(files.read_text(self.spark, f"{self._folder('manifests')}/{name}"))
        return Version(int(name.split(".")[0]), tuple(text["files"]), text["next_id"])

    def _commit(self, base: Version, removed: Iterable[str], added: Sequence[str], next_id: int) -> Version:
        gone = set(removed)
        kept = [f for f in base.files if f not in gone]
        new = Version(base.number + 1, (*kept, *added), next_id)
        try:
            files.write_new(self.spark, f"{self._folder('manifests')}/{new.number:012d}.json", json.dumps({"next_id": new.next_id, "files": new.files}))
        except FileExistsError:
            raise ConcurrentLoad(f"{self.root} has a newer version than {base.number}") from None
        self.loaded = {"written": len(added), "rewritten": len(gone), "kept": len(kept)}
        return new

    def mark(self, next_id: int) -> Version:
        """Move the mark, for a table whose rows came with ids of their own."""
        base = self.version()
        return self._commit(base, (), (), max(base.next_id, next_id))

    def forget(self, keep: int = 1) -> int:
        """Remove all but the newest ``keep`` versions and the files that only they name; returns the number of these files."""
        folder = self._folder("manifests")
        names = [n for n in files.folders(self.spark, folder) if not n.startswith((".", "_"))]
        old, stay = names[:-keep], names[-keep:]
        used = {f for n in stay for f in self._manifest(n).files}
        gone = {f for n in old for f in self._manifest(n).files} - used
        for f in sorted(gone):
            files.remove(self.spark, f"{self._folder('data')}/{f}")
        for n in old:
            files.remove(self.spark, f"{folder}/{n}")
        return len(gone)

    # ── reading ───────────────────────────────────────────────────────────────

    def _scan(self, names: Sequence[str]) -> DataFrame:
        """The given files with the partition column, if there is one."""
        extra = [T.StructField(_BATCH, T.StringType())] + ([T.StructField(self.partition[0], T.StringType())] if self.partition else [])
        schema = T.StructType([*self.schema.fields, *extra])
        if not names:
            return self.spark.createDataFrame([], schema)
        data = self._folder("data")
        return self.spark.read.schema(schema).option("basePath", data).parquet(*[f"{data}/{f}" for f in names])

    def read(self, version: Version | None = None) -> DataFrame:
        """The table; a filter on the partition column's expression goes to :meth:`where_partition`."""
        return self._scan((version or self.version()).files).select(*self.schema.names)

    def where_partition(self, low: str, high: str) -> DataFrame:
        """The rows of the partitions from ``low`` to ``high``: only their folders are read."""
        return self._scan(self.version().files).where(F.col(self.partition[0]).between(low, high)).select(*self.schema.names)

    def touched(self, version: Version, values: DataFrame, column: str) -> list[str]:
        """The files with a row whose ``column`` is one of ``values`` (a one-column frame)."""
        bounds = [F.min(column).alias("low"), F.max(column).alias("high")]
        if self._follows(column):
            bounds += [F.min(F.expr(self.partition[1])).alias("first"), F.max(F.expr(self.partition[1])).alias("last")]
        at = values.agg(*bounds).first()
        if at.low is None or not version.files:
            return []
        scan = self._scan(version.files).where(F.col(column).between(F.lit(at.low), F.lit(at.high)))
        if self._follows(column):
            scan = scan.where(F.col(self.partition[0]).between(at.first, at.last))
        name = F.regexp_extract(F.col("_metadata.file_path"), _FILE, 0).alias("file")
        return sorted(r.file for r in scan.select(column, name).join(values.distinct(), column, "left_semi").select("file").distinct().collect())

    def _follows(self, column: str) -> bool:
        """Whether the partition column is made of ``column`` alone, and rises with it."""
        return bool(self.partition) and self.partition[1].replace(" ", "") in (f"date_format({column},'yyyy-MM')", column)

    # ── writing ───────────────────────────────────────────────────────────────

    def _write(self, rows: DataFrame) -> list[str]:
        """New files with ``rows``, by partition and in order; not part of the table until they are committed.

        Rows are sorted by the order alone and then dealt to their partitions' files, which stay open: a partition
        name, equal for most rows of a task, as the first sort key would cost a comparison of whole rows each time.
        """
        out = S.conform(rows, self.schema)
        keys = [c if isinstance(c, Column) else F.col(c) for c in self.order]
        if self.partition:
            name, expression = self.partition
            out = out.withColumn(name, F.expr(expression)).hint("rebalance", name)
            out = out.sortWithinPartitions(*keys) if keys else out
        elif keys:
            out = out.repartitionByRange(*keys).sortWithinPartitions(*keys)
        folder = f"{_BATCH}={uuid.uuid4().hex}"
        writer = out.write.option("maxRecordsPerFile", self.rows_per_file or 0)
        if self.partition:
            with _side_by_side(self.spark):
                writer.partitionBy(self.partition[0]).parquet(f"{self._folder('data')}/{folder}")
        else:
            writer.parquet(f"{self._folder('data')}/{folder}")
        return [f"{folder}/{f}" for f in files.data_files(self.spark, f"{self._folder('data')}/{folder}")]

    def _write_numbered(self, kept: DataFrame | None, batch: DataFrame, base: Version, id_col: str | None) -> tuple[list[str], int]:
        """``batch`` with new ids and what is kept as it is; the files, and the mark after them."""
        if id_col is None:
            return self._write(batch if kept is None else kept.unionByName(batch.select(*kept.columns))), base.next_id
        if batch.isEmpty():  # a plan that is known to be empty runs no observation
            return self._write(kept) if kept is not None else [], base.next_id
        top = Observation(f"ids_{uuid.uuid4().hex}")
        numbered = LD.with_sequence_ids(batch, id_col, base.next_id).select(*self.schema.names).observe(top, F.max(id_col).alias("top"))
        added = self._write(numbered if kept is None else kept.unionByName(numbered))
        last = top.get["top"]
        return added, base.next_id if last is None else int(last) + 1

    def append(self, batch: DataFrame, id_col: str | None = None, next_id: int | None = None) -> Version:
        """Add rows. Those that come with ids of their own move the mark to ``next_id``, in the same commit."""
        base = self.version()
        added, mark = self._write_numbered(None, batch, base, id_col)
        return self._commit(base, (), added, max(mark, next_id or mark))

    def overwrite(self, rows: DataFrame) -> Version:
        """The table with ``rows`` alone, which may read it."""
        base = self.version()
        return self._commit(base, base.files, self._write(rows), base.next_id)

    def replace(self, batch: DataFrame, column: str, id_col: str | None = None) -> Version:
        """Rows of the table whose ``column`` is one of the batch's make way for the batch: loading it again changes
        nothing but ids. Rows without a value stay."""
        base = self.version()
        values = batch.select(column).where(F.col(column).isNotNull()).distinct()
        old = self.touched(base, values, column)
        kept = self._scan(old).select(*self.schema.names).join(values, column, "left_anti").select(*self.schema.names) if old else None
        added, mark = self._write_numbered(kept, batch, base, id_col)
        return self._commit(base, old, added, mark)

    def upsert(self, source: DataFrame, key: str, update_cols: Sequence[str], new_key: tuple[str, str] | None = None) -> Version:
        """As :func:`load.upserted`, on the files that hold one of the source's keys. With ``new_key`` inserted rows
        are numbered from the mark on."""
        base = self.version()
        LD.assert_unique_key(source, key)
        if source.isEmpty():
            return self._commit(base, (), (), base.next_id)
        old = self.touched(base, source.select(key), key)
        merged = LD.upserted(self._scan(old).select(*self.schema.names), source, key, update_cols, new_key, check_unique=False, start=base.next_id)
        mark = base.next_id
        if new_key is None:
            added = self._write(merged)
        else:
            top = Observation(f"keys_{uuid.uuid4().hex}")
            added = self._write(merged.observe(top, F.max(new_key[0]).alias("top")))
            mark = max(mark, int(top.get["top"] or 0) + 1)
        return self._commit(base, old, added, mark)

    def insert_absent(self, source: DataFrame, key: str, order_col: str) -> Version:
        """As :func:`load.inserted_if_absent`: new keys are appended, no file is rewritten."""
        base = self.version()
        LD.assert_no_null_key(source, key)
        new = LD.keep_first(source.select(*self.schema.names), key, order_col)
        if base.files:
            new = new.join(self._scan(base.files).select(key), key, "left_anti")
        return self._commit(base, (), self._write(new), base.next_id)
