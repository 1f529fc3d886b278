"""Named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the test tables of ``sf_dir`` through the warehouse built from
them (materialised once per application). Results pass through :func:`portable`
— DECIMAL → DOUBLE and DATE → ISO string — so that values compare equal across
engines whose client libraries map those types differently.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import facts as FACT
from ..operators import rfm as RFM
from ..session import checkpoint_dir
from ..sources import files
from ..sources import testdata as TD
from ..sources import warehouse as WH
from . import dashboard, maintenance, reports, sql

QueryFn = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _on_warehouse(fn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(WH.for_testdata(spark, sf_dir)))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _with_source(fn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(WH.for_testdata(spark, sf_dir), spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _table(name: str, drop: tuple[str, ...] = ()) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = WH.for_testdata(spark, sf_dir)[name]
        return portable(df.drop(*drop))
    run.__name__ = name
    return run


def _line_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(FACT.with_line_metrics(TD.raw_orders(spark, sf_dir)))


def _fact_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = WH.for_testdata(spark, sf_dir)
    return FACT.fact_dropped_rows_from_parts(TD.order_headers(spark, sf_dir), TD.order_lines(spark, sf_dir),
                                             wh["dim_customer"], wh["dim_product"])


def _rfm_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RFM.segment_counts(WH.for_testdata(spark, sf_dir)["fact_rfm"])


def etl_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole pipeline run into a new database: each created table with its columns and the rows loaded."""
    from . import pipeline

    database = f"etl_{uuid.uuid4().hex}"
    root = f"{checkpoint_dir(spark)}/{database}"
    summary = pipeline.run_testdata(spark, sf_dir, database=database, root=root)
    rows = [(name, ",".join(spark.table(f"{database}.{name}").columns), n) for name, n in sorted(summary["row_counts"].items())]
    spark.sql(f"DROP DATABASE {database} CASCADE")
    files.remove(spark, root)
    return spark.createDataFrame(rows, "table_name string, columns string, rows long")


def etl_run_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after the repeat-safe run has loaded one batch twice: the rows of a single load."""
    from . import pipeline

    root = f"{checkpoint_dir(spark)}/starloom-runs/{uuid.uuid4().hex}"
    inputs = pipeline.testdata_inputs(spark, sf_dir)
    for _ in range(2):
        pipeline.run_files(spark, *inputs, root=root)
    return portable(pipeline.file_tables(spark, root)["fact_sales"].read().drop("sale_id"))


def etl_order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order summary that two repeat-safe runs keep: all orders, and then those of the last third of the calendar again."""
    from . import pipeline

    root = f"{checkpoint_dir(spark)}/starloom-runs/{uuid.uuid4().hex}"
    customers, products, (headers, lines), start, end = pipeline.testdata_inputs(spark, sf_dir)
    again = headers.where(F.col("order_date") > F.lit(end - (end - start) / 3))
    for part in (headers, again):
        pipeline.run_files(spark, customers, products, (part, lines.join(part.select("order_id"), "order_id", "left_semi")), start, end, root=root)
    return portable(maintenance.order_cells(pipeline.file_warehouse(spark, root)))


def etl_left_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run leaves besides its tables: new staged folders, and versions of each table beyond the one in use."""
    from . import pipeline

    staged = f"{checkpoint_dir(spark)}/starloom-stage"
    before = set(files.folders(spark, staged))
    root = f"{checkpoint_dir(spark)}/starloom-runs/{uuid.uuid4().hex}"
    summary = pipeline.run_files(spark, *pipeline.testdata_inputs(spark, sf_dir), root=root)
    rows = [("staged folders", len(set(files.folders(spark, staged)) - before), 0)]
    for name, table in pipeline.file_tables(spark, root).items():
        rows.append((name, len(files.folders(spark, f"{table.root}/manifests")) - 1, summary["row_counts"][name]))
    files.remove(spark, root)
    return spark.createDataFrame(rows, "name string, left_over long, rows long")


def queries() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {
        "dim_date": _table("dim_date"),
        "dim_customer": _table("dim_customer"),
        "dim_product": _table("dim_product"),
        "line_metrics": _line_metrics,
        "fact_sales": _table("fact_sales", drop=("sale_id",)),
        "fact_dropped_rows": _fact_dropped,
        "fact_rfm": _table("fact_rfm", drop=("rfm_id",)),
        "rfm_value_counts": _rfm_counts,
        "etl_run": etl_run,
        "etl_run_twice": etl_run_twice,
        "etl_left_over": etl_left_over,
        "etl_order_cells": etl_order_cells,
    }
    for name, fn in {**reports.REPORTS, **dashboard.DASHBOARD, **maintenance.ON_WAREHOUSE}.items():
        q[name] = _on_warehouse(fn)
    for name, fn in maintenance.ON_WAREHOUSE_AND_SOURCE.items():
        q[name] = _with_source(fn)
    for name in sql.SAMPLES:
        q[name] = _on_warehouse(sql.sample(name))
    return q
