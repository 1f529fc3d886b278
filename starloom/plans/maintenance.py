"""Warehouse maintenance: the load operators applied to whole warehouse tables,
and the quality / integrity reports.

The upsert scenarios model the next daily extract arriving from the source
system. It is derived from the same test tables (no ids are sampled):

* customers — every source customer again, e-mail duplicates included (so the
  ones the first build dropped arrive as inserts), with first name and city
  restated in upper case, the premium flag flipped and the age group restated
  as ``'unknown'`` (a column the upsert must not overwrite);
* products — prices up 10 % (cost kept, margin and tier recomputed), names
  restated in upper case (not an updatable column) and the active flag flipped;
* RFM — the scoring re-run 30 days later.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money as M
from ..functions import text as X
from ..operators import dimensions as DIM
from ..operators import distinct as DISTINCT
from ..operators import facts as FACT
from ..operators import incremental as INC
from ..operators import load as LD
from ..operators import quality as Q
from ..operators import rfm as RFM
from ..operators.filetable import FileTable
from ..operators.stage import materialize
from ..session import checkpoint_dir
from ..sources import files
from ..sources import testdata as TD
from ..sources.warehouse import Warehouse

# The columns that an upsert of each table may change.
CUSTOMER_UPDATES = ["first_name", "last_name", "email", "city", "state", "is_premium"]
PRODUCT_UPDATES = ["unit_price", "unit_cost", "margin_pct", "margin_tier", "is_active"]
RFM_UPDATES = ["snapshot_date", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
               "rfm_score", "segment"]
# Fixed scenario parameters.
PRICE_FACTOR = "1.10"
RESCORE_AFTER_DAYS = 30
EXTEND_CALENDAR_DAYS = 365


def next_customer_extract(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", F.upper("first_name").alias("first_name"), "last_name",
        X.normalize_email(F.col("email")).alias("email"), F.upper("city").alias("city"), "state", "country",
        F.lit("unknown").alias("age_group"), "gender", "signup_date", (~F.col("is_premium")).alias("is_premium"))


def next_product_extract(products: DataFrame) -> DataFrame:
    price = F.round(F.col("unit_price") * F.lit(PRICE_FACTOR).cast("decimal(3,2)"), 2).cast("decimal(10,2)")
    out = products.select("product_id", F.upper("product_name").alias("product_name"), "category", "subcategory",
                          "brand", price.alias("unit_price"), "unit_cost", (~F.col("is_active")).alias("is_active"))
    m = M.margin_pct(F.col("unit_price"), F.col("unit_cost"))
    return out.withColumn("margin_pct", m).withColumn("margin_tier", M.margin_tier(F.col("margin_pct")))


# ── load operators on the warehouse ───────────────────────────────────────────

def load_append(wh: Warehouse) -> DataFrame:
    """The fact after loading the same batch a second time (every line twice)."""
    fact = wh.fact.drop("sale_id")
    return LD.appended(fact, fact)


def load_insert_absent(wh: Warehouse) -> DataFrame:
    """The date dimension after loading a calendar that runs a year further."""
    longer = DIM.build_dim_date(wh.spark, wh.start_date, wh.end_date + dt.timedelta(days=EXTEND_CALENDAR_DAYS))
    return LD.inserted_if_absent(wh["dim_date"], longer, "date_key", "full_date")


def load_insert_absent_conflict(wh: Warehouse) -> DataFrame:
    """A stored calendar of weekdays with other month names, after loading the whole calendar: stored rows stay."""
    stored = wh["dim_date"].where(~F.col("is_weekend")).withColumn("month_name", F.upper("month_name"))
    return LD.inserted_if_absent(stored, wh["dim_date"], "date_key", "full_date")


def load_replaced_dates(wh: Warehouse) -> DataFrame:
    """The fact after loading the first ten days of each month again, with every channel restated."""
    fact = wh.fact.drop("sale_id")
    batch = fact.where(F.dayofmonth("order_date") <= 10).withColumn("channel", F.upper("channel"))
    return LD.replaced_dates(LD.replaced_dates(fact, batch, "order_date"), batch, "order_date")


def load_append_ids(wh: Warehouse) -> DataFrame:
    """Two batches of the fact appended one after the other to a new table: rows, distinct ids and the smallest id."""
    spark = wh.spark
    path = f"{checkpoint_dir(spark)}/starloom-appends/{uuid.uuid4().hex}"
    fact = wh.fact.drop("sale_id")
    completed = F.col("order_status").eqNullSafe("completed")
    LD.append_to(path, fact.where(completed), "sale_id")
    LD.append_to(path, fact.where(~completed), "sale_id")
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("sale_id").alias("ids"), F.min("sale_id").alias("first_id"))
    result = spark.createDataFrame(rows.collect(), "rows long, ids long, first_id long")
    files.remove(spark, path)
    return result


def upsert_customer(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    src = next_customer_extract(TD.raw_customers(spark, sf_dir))
    return LD.upserted(wh["dim_customer"], src, "customer_id", CUSTOMER_UPDATES,
                       new_key=("customer_key", "customer_id"))


def upsert_product(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    src = next_product_extract(TD.raw_products(spark, sf_dir))
    return LD.upserted(wh["dim_product"], src, "product_id", PRODUCT_UPDATES,
                       new_key=("product_key", "product_id"))


def upsert_rfm(wh: Warehouse) -> DataFrame:
    later = wh.end_date + dt.timedelta(days=RESCORE_AFTER_DAYS)
    src = RFM.build_rfm(wh.fact.drop("sale_id"), later)
    return LD.upserted(wh["fact_rfm"].drop("rfm_id"), src, "customer_key", RFM_UPDATES)


def upsert_product_inserts(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product upsert into a store that lacks every seventh product."""
    src = next_product_extract(TD.raw_products(spark, sf_dir))
    return LD.upserted(wh["dim_product"].where("product_key % 7 <> 0"), src, "product_id", PRODUCT_UPDATES,
                       new_key=("product_key", "product_id"))


def upsert_rfm_partial(wh: Warehouse) -> DataFrame:
    """The RFM upsert into a store that lacks every fifth customer, from a source that lacks every third."""
    src = RFM.build_rfm(wh.fact.drop("sale_id").where("customer_key % 3 <> 0"), wh.end_date)
    return LD.upserted(wh["fact_rfm"].drop("rfm_id").where("customer_key % 5 <> 0"), src, "customer_key", RFM_UPDATES)


# ── the same merges by file ──────────────────────────────────────────────────

def _by_file(wh: Warehouse, name: str, key: str, rows: DataFrame) -> FileTable:
    """A new file table with ``rows``, clustered by ``key``."""
    root = f"{checkpoint_dir(wh.spark)}/starloom-runs/{uuid.uuid4().hex}/{name}"
    table = FileTable(wh.spark, root, rows.schema, order=[key])
    table.append(rows)
    return table


def upsert_customer_files(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer upsert into a file table: only files that hold a customer of the extract are rewritten."""
    wh = wh.with_session(spark)
    src = next_customer_extract(TD.raw_customers(spark, sf_dir))
    table = _by_file(wh, "dim_customer", "customer_id", wh["dim_customer"])
    table.mark(LD.next_id(wh["dim_customer"], "customer_key"))
    table.upsert(src, "customer_id", CUSTOMER_UPDATES, new_key=("customer_key", "customer_id"))
    return table.read()


def upsert_product_files(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product upsert into a file table that lacks every seventh product."""
    wh = wh.with_session(spark)
    src = next_product_extract(TD.raw_products(spark, sf_dir))
    stored = wh["dim_product"].where("product_key % 7 <> 0")
    table = _by_file(wh, "dim_product", "product_id", stored)
    table.mark(LD.next_id(stored, "product_key"))
    table.upsert(src, "product_id", PRODUCT_UPDATES, new_key=("product_key", "product_id"))
    return table.read()


def upsert_rfm_files(wh: Warehouse) -> DataFrame:
    """The RFM upsert into a file table that lacks every fifth customer, from a source that lacks every third."""
    src = materialize(RFM.build_rfm(wh.fact.drop("sale_id").where("customer_key % 3 <> 0"), wh.end_date), "rfm-source")
    table = _by_file(wh, "fact_rfm", "customer_key", wh["fact_rfm"].drop("rfm_id").where("customer_key % 5 <> 0"))
    table.upsert(src, "customer_key", RFM_UPDATES)
    return table.read()


def load_append_marks(wh: Warehouse) -> DataFrame:
    """:func:`load_append_ids` into a file table, whose manifest holds the next free id; between the two appends one dies before its commit."""
    table = FileTable(wh.spark, f"{checkpoint_dir(wh.spark)}/starloom-runs/{uuid.uuid4().hex}/fact_sales", wh.fact.schema, order=["order_date"])
    fact = wh.fact.drop("sale_id")
    completed = F.col("order_status").eqNullSafe("completed")
    table.append(fact.where(completed), "sale_id")
    table._write_numbered(None, fact, table.version(), "sale_id")   # files that no manifest names
    table.append(fact.where(~completed), "sale_id")
    return table.read().agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("sale_id").alias("ids"), F.min("sale_id").alias("first_id"))


# ── lines that go astray ─────────────────────────────────────────────────────

# Fixed scenario parameters: an id that nothing has.
ASTRAY = 1_000_000_000_000


def fact_lost_lines(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the fact build loses when every 40th order and every 50th product is unknown."""
    order, product = F.col("order_id"), F.col("product_id")
    lines = TD.order_lines(spark, sf_dir).withColumn("order_id", F.when(order % 40 == 3, order + ASTRAY).otherwise(order))
    lines = lines.withColumn("product_id", F.when(product % 50 == 7, product + ASTRAY).otherwise(product))
    return FACT.fact_lost_lines(TD.order_headers(spark, sf_dir), lines, wh["dim_customer"], wh["dim_product"])


def _quarantined(wh: Warehouse, spark: SparkSession, sf_dir: str) -> tuple[FileTable, FileTable, DataFrame, DataFrame, DataFrame]:
    """A first run in which every 40th order and every 50th product is not there yet: fact and quarantine tables, and
    what the second run brings (headers, customers, products)."""
    wh = wh.with_session(spark)
    headers, lines = TD.order_headers(spark, sf_dir), TD.order_lines(spark, sf_dir)
    some = headers.where("order_id % 40 <> 3"), lines, wh["dim_customer"], wh["dim_product"].where("product_id % 50 <> 7")
    fact, _ = FACT.build_fact_from_parts(*some)
    lost = FACT.lost_lines(*some)
    root = f"{checkpoint_dir(spark)}/starloom-runs/{uuid.uuid4().hex}"
    tables = FileTable(spark, f"{root}/fact_sales", wh.fact.schema, order=["order_date"]), FileTable(spark, f"{root}/quarantine", lost.schema, order=["order_id"])
    tables[0].append(fact, "sale_id")
    tables[1].append(lost)
    return *tables, headers, wh["dim_customer"], wh["dim_product"]


def _release(facts: FileTable, quarantine: FileTable, headers: DataFrame, customers: DataFrame, products: DataFrame) -> None:
    fact, lost = FACT.released(quarantine.read(), headers, customers, products)
    facts.append(fact, "sale_id")
    quarantine.overwrite(lost)


def fact_quarantine(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after lines that the first run lost have entered in the second."""
    tables = _quarantined(wh, spark, sf_dir)
    _release(*tables)
    return tables[0].read().drop("sale_id")


def fact_quarantine_counts(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in quarantine after each of the two runs, by what they lack."""
    tables = _quarantined(wh, spark, sf_dir)
    first = tables[1].read()
    _release(*tables)
    runs = [df.groupBy("reason").agg(F.count(F.lit(1)).alias("lines")).select(F.lit(run).cast("long").alias("run"), "reason", "lines")
            for run, df in ((1, first), (2, tables[1].read()))]
    return runs[0].unionByName(runs[1])


def dirty_tables(wh: Warehouse) -> dict[str, DataFrame]:
    """The warehouse with faults of every kind that the checks look for, as a batch has them before it is cast."""
    order, key = F.col("order_id"), F.col("product_key")
    fact = (wh.fact.withColumn("sale_id", F.when(order % 23 != 0, order))
            .withColumn("revenue", F.when(order % 11 == 0, -F.col("revenue")).when(order % 29 != 0, F.col("revenue")).cast("decimal(30,2)"))
            .withColumn("quantity", F.when(order % 13 == 0, F.lit(0)).otherwise(F.col("quantity")).cast("smallint"))
            .withColumn("customer_key", F.when(order % 17 != 0, F.col("customer_key")))
            .withColumn("product_key", F.when(order % 19 == 0, key + ASTRAY).otherwise(key))
            .withColumn("unit_price", F.col("unit_price").cast("decimal(30,2)") * F.when(order % 31 == 0, F.lit(ASTRAY)).otherwise(F.lit(1)))
            .withColumn("channel", F.when(order % 37 == 0, F.repeat("channel", F.lit(9))).otherwise(F.col("channel"))))
    customer = (wh["dim_customer"].withColumn("customer_id", F.col("customer_id") - F.col("customer_id") % 2)
                .withColumn("customer_key", F.when(F.col("customer_key") % 41 != 0, F.col("customer_key")))
                .withColumn("city", F.repeat("city", F.lit(12))))
    product = wh["dim_product"].withColumn("margin_pct", F.col("margin_pct").cast("string"))
    product = product.withColumn("margin_pct", F.when(F.col("product_key") % 43 == 0, F.lit("much")).otherwise(F.col("margin_pct")))
    rfm = wh["fact_rfm"].withColumn("rfm_id", F.when(F.col("customer_key") % 3 != 0, F.col("customer_key") % 100))
    rfm = rfm.withColumn("customer_key", F.when(F.col("customer_key") % 10 == 0, F.col("customer_key") + ASTRAY).otherwise(F.col("customer_key")))
    return {**wh.tables, "fact_sales": fact, "dim_customer": customer, "dim_product": product, "fact_rfm": rfm}


def dq_report_dirty(wh: Warehouse) -> DataFrame:
    return Q.fact_report(dirty_tables(wh)["fact_sales"])


def dq_unique_dirty(wh: Warehouse) -> DataFrame:
    return Q.unique_violations(dirty_tables(wh))


def dq_not_null_dirty(wh: Warehouse) -> DataFrame:
    return Q.not_null_violations(dirty_tables(wh))


def dq_fk_dirty(wh: Warehouse) -> DataFrame:
    return Q.foreign_key_violations(dirty_tables(wh))


def dq_fit_dirty(wh: Warehouse) -> DataFrame:
    return Q.fit_violations(dirty_tables(wh))


# ── text functions ───────────────────────────────────────────────────────────

def text_functions(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name functions over every part: singular, capitalised, first word, and the name built of them."""
    part = TD.read_table(spark, sf_dir, "part")
    word = X.first_token(F.col("p_name"))
    return part.select("p_partkey", X.singular(F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, "s").otherwise(""))).alias("singular"),
                       X.capitalize(F.col("p_type")).alias("capitalized"), word.alias("word"),
                       X.product_name(word, F.concat("p_type", F.lit("s"))).alias("name"))


# ── quality reports ───────────────────────────────────────────────────────────

def dq_report(wh: Warehouse) -> DataFrame:
    return Q.fact_report(wh.fact)


def dq_unique(wh: Warehouse) -> DataFrame:
    return Q.unique_violations(wh.tables)


def dq_not_null(wh: Warehouse) -> DataFrame:
    return Q.not_null_violations(wh.tables)


def dq_fk(wh: Warehouse) -> DataFrame:
    return Q.foreign_key_violations(wh.tables)


def dq_fit(wh: Warehouse) -> DataFrame:
    return Q.fit_violations(wh.tables)


# ── the key checks from summaries ─────────────────────────────────────────────

# Fixed scenario parameter: the share of a key's range that the last load brings.
LAST_LOAD = 0.1


def _loads(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of the loads before, and of the last one: the end of the key's range, and rows without a key."""
    top = df.agg(F.max(key)).first()[0]
    last = F.coalesce(F.col(key) > F.lit(int((top or 0) * (1 - LAST_LOAD))), F.lit(True))
    return df.where(~last), df.where(last)


def _unique_appended(tables: dict[str, DataFrame]) -> DataFrame:
    parts = []
    for table, key in Q.UNIQUE_KEYS:
        before, batch = _loads(tables[table], key)
        summary = materialize(INC.key_summary(before, key), "key-summary")
        after, _ = INC.key_summary_after(summary, before, batch, key)
        parts.append(INC.duplicates(after).select(F.lit(table).alias("table_name"), F.lit(key).alias("column_name"), F.lit("unique").alias("check_name"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def _fk_appended(tables: dict[str, DataFrame]) -> DataFrame:
    parts = []
    for child, key, parent in Q.FOREIGN_KEYS:
        before, batch = _loads(tables[child], key)
        known, late = _loads(tables[parent].where(F.col(key).isNotNull()), key)
        summary = materialize(INC.orphan_summary(before, key, known, key), "orphan-summary")
        summary = materialize(INC.orphans_after_child(summary, batch, key, known, key), "orphan-summary")  # the batch comes before its parents
        after, _ = INC.orphans_after_parent(summary, tables[child], key, tables[parent], late, key)
        parts.append(INC.orphans(after).select(F.lit(child).alias("table_name"), F.lit(key).alias("column_name"), F.lit(f"fk:{parent}").alias("check_name"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def dq_unique_appended(wh: Warehouse) -> DataFrame:
    """Unique keys after a last load, from the summaries of the loads before and the ranges that it touches."""
    return _unique_appended(wh.tables)


def dq_unique_appended_dirty(wh: Warehouse) -> DataFrame:
    return _unique_appended(dirty_tables(wh))


def dq_fk_appended(wh: Warehouse) -> DataFrame:
    """Foreign keys after a last load of the child and then one of the parent, from the summaries before them."""
    return _fk_appended(wh.tables)


def dq_fk_appended_dirty(wh: Warehouse) -> DataFrame:
    return _fk_appended(dirty_tables(wh))


# ── order summary ─────────────────────────────────────────────────────────────

def _shown(cells: DataFrame) -> DataFrame:
    out = DISTINCT.counted(cells, DISTINCT.CELL, "orders", "orders", DISTINCT.SUMS)
    return out.select("order_month", *DISTINCT.CELL[1:], "orders", *[F.col(c).cast("long").alias(c) if c in ("lines", "quantity", "revenue_n", "discount_n") else c for c in DISTINCT.SUMS])


def order_cells(wh: Warehouse) -> DataFrame:
    """The order summary: distinct orders and sums of each month, channel, status and payment method."""
    return _shown(wh.order_cells())


def order_cells_appended(wh: Warehouse) -> DataFrame:
    """The same after two loads that split most orders between them: the second load's orders keep the numbers of the
    first, new ones go behind its mark, and its rows are added to the summary."""
    lines = DISTINCT.lines_by_month(wh.fact, wh.dim_date_for_join())
    late = (F.col("product_key") % 3 == 0) | (F.col("order_id") % 5 == 0)
    late = F.coalesce(late, F.lit(False))
    first, numbers, mark = DISTINCT.numbered_rows(DISTINCT.order_rows(lines.filter(~late)))
    second, _, _ = DISTINCT.numbered_rows(DISTINCT.order_rows(lines.filter(late)), numbers, mark)
    return _shown(DISTINCT.order_cells(first).unionByName(DISTINCT.order_cells(second)))


ON_WAREHOUSE = {
    "order_cells": order_cells,
    "order_cells_appended": order_cells_appended,
    "dq_report": dq_report,
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_fk": dq_fk,
    "dq_fit": dq_fit,
    "dq_report_dirty": dq_report_dirty,
    "dq_unique_dirty": dq_unique_dirty,
    "dq_not_null_dirty": dq_not_null_dirty,
    "dq_fk_dirty": dq_fk_dirty,
    "dq_fit_dirty": dq_fit_dirty,
    "dq_unique_appended": dq_unique_appended,
    "dq_unique_appended_dirty": dq_unique_appended_dirty,
    "dq_fk_appended": dq_fk_appended,
    "dq_fk_appended_dirty": dq_fk_appended_dirty,
    "load_append": load_append,
    "load_append_ids": load_append_ids,
    "load_insert_absent": load_insert_absent,
    "load_insert_absent_conflict": load_insert_absent_conflict,
    "load_replaced_dates": load_replaced_dates,
    "load_append_marks": load_append_marks,
    "upsert_rfm_files": upsert_rfm_files,
    "upsert_rfm": upsert_rfm,
    "upsert_rfm_partial": upsert_rfm_partial,
}
ON_WAREHOUSE_AND_SOURCE = {
    "upsert_customer": upsert_customer,
    "upsert_product": upsert_product,
    "upsert_product_inserts": upsert_product_inserts,
    "upsert_customer_files": upsert_customer_files,
    "upsert_product_files": upsert_product_files,
    "fact_lost_lines": fact_lost_lines,
    "fact_quarantine": fact_quarantine,
    "fact_quarantine_counts": fact_quarantine_counts,
    "text_functions": text_functions,
}
