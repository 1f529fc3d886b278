"""The warehouse: five tables built from raw inputs, materialised once.

``Warehouse.build`` runs the ETL (dimensions → fact → RFM) and writes each table
as Parquet under the session's shared checkpoint folder, then reads it back.
Every analysis runs on those written tables, so lineage is cut after each stage
(a lost executor re-reads files instead of recomputing the fact), the ranking
passes see stable input, and the scans get column pruning and filter pushdown.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dimensions as DIM
from ..operators import distinct as DISTINCT
from ..operators import facts as FACT
from ..operators import rfm as RFM
from ..operators.joins import broadcast_bounded_by_construction
from ..operators.stage import staging
from ..session import checkpoint_dir
from . import files
from . import schemas as S
from . import testdata as TD

TABLE_NAMES = ["dim_date", "dim_customer", "dim_product", "fact_sales", "fact_rfm"]
# A calendar dimension is broadcast when its (known) row count is at most this.
DATE_BROADCAST_MAX_ROWS = 200_000
_SUMMARY_LOCK = threading.Lock()


@dataclass
class Warehouse:
    spark: SparkSession
    tables: dict[str, DataFrame]
    start_date: dt.date
    end_date: dt.date
    location: str | None = None
    dropped_rows: int | None = None
    extras: dict = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    @property
    def fact(self) -> DataFrame:
        return self.tables["fact_sales"]

    @property
    def calendar_days(self) -> int:
        return DIM.calendar_days(self.start_date, self.end_date)

    def dim_date_for_join(self) -> DataFrame:
        """``dim_date``, broadcast: its row count is the number of calendar days."""
        return broadcast_bounded_by_construction(self.tables["dim_date"], self.calendar_days,
                                                 DATE_BROADCAST_MAX_ROWS)

    # ── summaries, written when they are first asked for ──────────────────────

    def _summary(self, name: str, make) -> DataFrame:
        if name in self.extras.get("kept", {}):   # by the loads themselves
            return self.extras["kept"][name].read()
        paths = self.extras.setdefault("summaries", {})
        with _SUMMARY_LOCK:
            if name not in paths:
                path = f"{self.location or checkpoint_dir(self.spark) + '/starloom-summaries/' + uuid.uuid4().hex}/{name}"
                with staging(self.spark):   # numbering stages its rows
                    make().write.mode("overwrite").parquet(path)
                paths[name] = path
        return self.spark.read.parquet(paths[name])

    def _lines_by_month(self) -> DataFrame:
        return DISTINCT.lines_by_month(self.fact, self.dim_date_for_join())

    def order_cells(self) -> DataFrame:
        """Sums and order bitmaps per month, channel, status and payment method (``operators/distinct.py``)."""
        def make() -> DataFrame:
            return DISTINCT.order_cells(DISTINCT.numbered_rows(DISTINCT.order_rows(self._lines_by_month()))[0])
        return self._summary("order_cells", make)

    def buyer_cells(self) -> DataFrame:
        """Customer bitmaps per month and status."""
        return self._summary("buyer_cells", lambda: DISTINCT.buyer_cells(self._lines_by_month()))

    def with_session(self, spark: SparkSession) -> "Warehouse":
        """The same materialised tables, read through another session."""
        if spark is self.spark or not self.location:
            return self
        tables = {name: spark.read.parquet(f"{self.location}/{name}") for name in self.tables}
        return Warehouse(spark, tables, self.start_date, self.end_date, self.location, self.dropped_rows, self.extras)

    def register_views(self, prefix: str = "") -> None:
        for name, df in self.tables.items():
            df.createOrReplaceTempView(prefix + name)


def _write_read(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def build(spark: SparkSession, customers: DataFrame, products: DataFrame,
          orders: DataFrame | tuple[DataFrame, DataFrame],
          start_date, end_date, snapshot_date=None, location: str | None = None,
          materialize: bool = True) -> Warehouse:
    """Run the ETL. ``orders`` is either the flat order lines or a pair (order
    headers, order lines). With ``materialize`` every table is written under
    ``location`` (default: a fresh folder below the shared checkpoint folder) and
    re-read."""
    start_d, end_d = DIM._as_date(start_date), DIM._as_date(end_date)
    snapshot = DIM._as_date(snapshot_date) if snapshot_date is not None else end_d
    if materialize and location is None:
        location = f"{checkpoint_dir(spark)}/starloom-warehouse/{uuid.uuid4().hex}"
    out: dict[str, DataFrame] = {}
    seconds: dict[str, float] = {}

    def step(name: str, make) -> DataFrame:
        """Build one table (``make`` runs its builder) and keep it; timed end to end."""
        t0 = time.perf_counter()
        df = make()
        out[name] = _write_read(df, f"{location}/{name}") if materialize else df
        seconds[name] = round(time.perf_counter() - t0, 3)
        return out[name]

    step("dim_date", lambda: DIM.build_dim_date(spark, start_d, end_d))
    dim_customer = step("dim_customer", lambda: DIM.build_dim_customer(customers))
    dim_product = step("dim_product", lambda: DIM.build_dim_product(products))
    if isinstance(orders, tuple):   # (order headers, order lines)
        fact, observed = FACT.build_fact_from_parts(orders[0], orders[1], dim_customer, dim_product)
    else:
        fact, observed = FACT.build_fact_observed(orders, dim_customer, dim_product)
    # sale_id: unique, increasing per write task (a sequence, not gap-free).
    fact = fact.select((F.monotonically_increasing_id() + F.lit(1)).alias("sale_id"), *fact.columns)
    # Written straight from the last join's output: AQE has already sized those
    # partitions and split skewed keys, so no extra shuffle of the fact is added.
    fact = step("fact_sales", lambda: S.conform(fact, S.FACT_SALES))

    def rfm_table() -> DataFrame:
        rfm = RFM.build_rfm(fact.drop("sale_id"), snapshot)
        rfm = rfm.select((F.monotonically_increasing_id() + F.lit(1)).alias("rfm_id"), *rfm.columns)
        return S.conform(rfm, S.FACT_RFM)
    step("fact_rfm", rfm_table)
    wh = Warehouse(spark, out, start_d, end_d, location)
    wh.extras["build_seconds"] = seconds   # per table: build + write (materialised runs)
    if materialize:   # the fact write above ran the observed plan
        wh.dropped_rows = int(observed.get["dropped_rows"])
    return wh


def build_from_testdata(spark: SparkSession, sf_dir: str, materialize: bool = True) -> Warehouse:
    """The warehouse of the test tables; calendar and snapshot span the order dates."""
    start, end = TD.calendar_bounds(spark, sf_dir)
    orders = (TD.order_headers(spark, sf_dir), TD.order_lines(spark, sf_dir))
    return build(spark, TD.raw_customers(spark, sf_dir), TD.raw_products(spark, sf_dir),
                 orders, start, end, materialize=materialize)


_CACHE: dict[tuple, Warehouse] = {}
_LOCK = threading.Lock()


SOURCES = ("customer", "nation", "part", "orders", "lineitem")


def for_testdata(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of ``sf_dir``, built once per Spark application and state of its files."""
    folder = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, folder, *(files.fingerprint(spark, f"{folder}/{t}.parquet") for t in SOURCES))
    with _LOCK:
        wh = _CACHE.get(key)
        if wh is None:
            wh = build_from_testdata(spark, sf_dir)
            _CACHE[key] = wh
        return wh.with_session(spark)
