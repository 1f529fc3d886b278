"""Distinct counts that add up: exact bitmaps over dense numbers.

An order summary has one row for each cell (month, channel, status, payment method) and block of 32,768 order
numbers, a bitmap of the orders with lines in the cell, and one row without a block for each cell, the sums of its
lines. Sums of rows add up, bitmaps are joined bit by bit, so the distinct orders of any union of cells come from the
summary alone: an order whose lines lie in several cells is one bit in each, and counts once. Rows of a later load are
simply added.

Order numbers are dense, and follow month and kind of order: orders of one cell lie together, a block of numbers
meets few cells, and the summary takes about a bit an order where cells are large. The number of an order never changes: later
loads look their orders up and number the new ones behind the mark.

Lines without an order count in the sums, not among the orders; lines whose date the calendar lacks have month NULL.
Orders and sums take separate ways: sums are combined before they are shuffled and take a row for each cell and task,
so only an order's cells travel with it, by order when they are collected and in the order of the numbers when it is numbered.
The rows are brought together by cell and block before bitmaps are made, since a bitmap is 4 kB however few bits it
has and every task would send one of each; a cell and block hold at most 32,768 orders, whatever the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from .ranking import global_rank
from .stage import materialize

CELL = ["order_month", "channel", "order_status", "payment_method"]
BUYER_CELL = ["order_month", "order_status"]
SUMS = ["lines", "quantity", "revenue", "revenue_n", "gross_profit", "discount", "discount_n"]
COUNTS = ["lines", "revenue_n", "discount_n"]


def lines_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The fact with the month of each line; ``dim_date`` as it is to be joined."""
    month = dim_date.select("date_key", D.month_start(F.col("full_date")).alias("order_month"))
    return fact.join(month, "date_key", "left")


def order_rows(lines: DataFrame) -> DataFrame:
    """One row for each order, with the cells that it has lines in and without sums, and one row without an order for
    each cell, with the sums of its lines."""
    orders = lines.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.collect_set(F.struct(*CELL)).alias("cells"))
    sums = lines.groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").cast("long").alias("quantity"),
        F.sum("revenue").cast("decimal(28,2)").alias("revenue"), F.count("revenue").alias("revenue_n"),
        F.sum("gross_profit").cast("decimal(28,2)").alias("gross_profit"),
        F.sum("discount_pct").cast("decimal(28,2)").alias("discount"), F.count("discount_pct").alias("discount_n"))
    return orders.unionByName(sums.select(F.array(F.struct(*CELL)).alias("cells"), *SUMS), allowMissingColumns=True)


def _orders(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("lines").isNull()).drop(*SUMS)


def _sums(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("lines").isNotNull())


def _ranked(orders: DataFrame, next_number: int) -> tuple[DataFrame, int]:
    """``orders`` with their numbers from ``next_number`` on, and the next free number."""
    place = F.array_min(F.transform("cells", lambda c: F.struct(
        F.coalesce(F.unix_date(c["order_month"]), F.lit(-1)).alias("month"),
        F.xxhash64(*[c[name] for name in CELL[1:]]).alias("kind"))))  # the kind only decides which orders get near numbers
    ranked, n = global_rank(orders.withColumn("_place", place).select("*", "_place.month", "_place.kind").drop("_place"),
                            [("month", True), ("kind", True), ("order_id", True)], "order_no")
    return ranked.select(*orders.columns, (F.col("order_no") + F.lit(next_number - 1)).alias("order_no")), next_number + n


def order_numbers(rows: DataFrame, known: DataFrame | None = None, next_number: int = 1) -> tuple[DataFrame, int]:
    """(order_id, order_no) of the orders in ``rows`` that ``known`` (order_id, order_no) lacks, numbered from
    ``next_number`` on, and the next free number."""
    new = _orders(rows)
    if known is not None:
        new = new.join(known.select("order_id"), "order_id", "left_anti")
    ranked, after = _ranked(new, next_number)
    return ranked.select("order_id", "order_no"), after


def numbered_rows(rows: DataFrame, known: DataFrame | None = None, next_number: int = 1) -> tuple[DataFrame, DataFrame, int]:
    """``rows`` of :func:`order_rows` with ``order_no``, and what :func:`order_numbers` returns. The cells go along
    when their orders are numbered, so they need not be joined with the numbers afterwards."""
    if known is None:
        ranked, after = _ranked(_orders(rows), next_number)
        numbered = ranked
    else:
        looked_up = materialize(_orders(rows).join(known.select("order_id", "order_no"), "order_id", "left"), "order-rows")
        ranked, after = _ranked(looked_up.where(F.col("order_no").isNull()).drop("order_no"), next_number)
        numbered = looked_up.where(F.col("order_no").isNotNull()).unionByName(ranked)
    return numbered.unionByName(_sums(rows), allowMissingColumns=True), ranked.select("order_id", "order_no"), after


def _bitmap(number: str) -> Column:
    return F.bitmap_construct_agg(F.bitmap_bit_position(number))


def order_cells(rows: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """The summary's rows for ``rows`` of :func:`numbered_rows`, or for those of :func:`order_rows`, where ``numbers``
    has the number of every order in them."""
    keys = [*CELL, "block"]
    orders = _orders(rows)
    if numbers is not None:
        orders = orders.join(numbers, "order_id", "left")
    bits = orders.select("order_no", F.inline("cells")).withColumn("block", F.bitmap_bucket_number("order_no"))
    cells = bits.repartition(*keys).groupBy(*keys).agg(_bitmap("order_no").alias("orders"))
    kinds = {c: rows.schema[c].dataType for c in SUMS}
    none = [F.lit(0 if c in COUNTS else None).cast(kind).alias(c) for c, kind in kinds.items()]
    sums = _sums(rows).select(F.inline("cells"), *SUMS).groupBy(*CELL).agg(*[F.sum(c).cast(kind).alias(c) for c, kind in kinds.items()])
    return cells.select("*", *none).unionByName(sums.select(*CELL, F.lit(None).cast("long").alias("block"), F.lit(bytearray()).alias("orders"), *SUMS))


def buyer_cells(lines: DataFrame) -> DataFrame:
    """Bitmaps of the customers of each month and status; customer keys are dense numbers already."""
    keys = [*BUYER_CELL, "block"]
    buyers = lines.select(*BUYER_CELL, "customer_key").distinct().withColumn("block", F.bitmap_bucket_number("customer_key"))
    return buyers.repartition(*keys).groupBy(*keys).agg(_bitmap("customer_key").alias("buyers"))


def counted(cells: DataFrame, by: Sequence[str | Column], bitmap: str, out: str, sums: Sequence[str] = (), given: dict[str, Column] | None = None) -> DataFrame:
    """Distinct numbers of each group of ``cells``, as ``out``, with the group's ``sums``.

    ``given`` adds counts of the numbers in those cells that a condition holds for. Without cells the counts are 0.
    """
    parts = {out: F.lit(True), **(given or {})}
    joined = cells.groupBy(*by, "block").agg(*[F.bitmap_or_agg(F.when(c, F.col(bitmap))).alias(f"_{name}") for name, c in parts.items()],
                                             *[F.sum(c).alias(c) for c in sums])
    names = [c for c in joined.columns if c != "block" and c not in sums and c not in {f"_{n}" for n in parts}]
    return joined.groupBy(*names).agg(*[F.coalesce(F.sum(F.bitmap_count(f"_{name}")), F.lit(0)).cast("long").alias(name) for name in parts],
                                      *[F.sum(c).alias(c) for c in sums])
