"""The order summary's bitmaps against plain distinct counts."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from starloom.operators import distinct as D

MONTHS = [dt.date(2024, 1, 1), dt.date(2024, 2, 1), None]


def lines(spark, n, seed):
    """Lines whose orders lie in several cells; NULLs in every column, an order without an id, a hot order."""
    pick = lambda k, of: F.element_at(F.array(*[F.lit(v) for v in of]), (F.abs(F.xxhash64("id", F.lit(seed + k))) % len(of) + 1).cast("int"))
    h = lambda k, mod: F.abs(F.xxhash64("id", F.lit(seed + k))) % mod
    return spark.range(n).select(
        F.when(h(1, 9) == 0, F.lit(None)).when(h(1, 9) < 4, F.lit(7)).otherwise(h(2, 90_000)).cast("long").alias("order_id"),
        F.when(h(3, 3) == 2, F.lit(None)).otherwise(F.add_months(F.lit(MONTHS[0]), h(3, 3).cast("int"))).alias("order_month"),
        pick(4, ["web", "store", None]).alias("channel"), pick(5, ["completed", "cancelled", None]).alias("order_status"),
        pick(6, ["card", None]).alias("payment_method"), (h(7, 70_000) + 1).alias("customer_key"), h(8, 5).cast("short").alias("quantity"),
        F.when(h(9, 7) == 0, F.lit(None)).otherwise(h(9, 1000).cast("decimal(12,2)")).alias("revenue"),
        h(10, 100).cast("decimal(12,2)").alias("gross_profit"), h(11, 40).cast("decimal(5,2)").alias("discount_pct"))


def rows_of(df):
    return sorted(map(str, df.collect()))


def plain(df, by):
    return df.groupBy(*by).agg(F.countDistinct("order_id").alias("orders"), F.count(F.lit(1)).alias("lines"), F.sum("revenue").cast("decimal(38,2)").alias("revenue"))


@pytest.fixture(scope="module")
def loaded(spark):
    table = lines(spark, 60_000, 1).cache()
    rows = D.order_rows(table)
    numbers, mark = D.order_numbers(rows)
    return table, D.order_cells(rows, numbers).cache(), numbers.cache(), mark


@pytest.mark.parametrize("by", [[], ["order_month"], ["channel"], ["order_status", "payment_method"], D.CELL])
def test_counts_equal_plain_distinct_counts(loaded, by):
    table, cells, _, _ = loaded
    assert rows_of(D.counted(cells, by, "orders", "orders", ["lines", "revenue"])) == rows_of(plain(table, by))


def test_counts_with_a_condition(loaded):
    table, cells, _, _ = loaded
    done = F.col("order_status") == "completed"
    got = D.counted(cells, ["channel"], "orders", "orders", given={"done": done})
    assert rows_of(got) == rows_of(table.groupBy("channel").agg(F.countDistinct("order_id").alias("orders"), F.countDistinct(F.when(done, F.col("order_id"))).alias("done")))


def test_numbers_are_dense_and_follow_the_month(loaded):
    table, _, numbers, mark = loaded
    n = table.select("order_id").where("order_id IS NOT NULL").distinct().count()
    got = numbers.agg(F.min("order_no"), F.max("order_no"), F.countDistinct("order_no"), F.countDistinct("order_id")).first()
    assert tuple(got) == (1, n, n, n) and mark == n + 1
    first = table.where("order_id IS NOT NULL").groupBy("order_id").agg(F.min(F.coalesce("order_month", F.lit(dt.date(1900, 1, 1)))).alias("m"))
    ends = first.join(numbers, "order_id").groupBy("m").agg(F.min("order_no").alias("low"), F.max("order_no").alias("high")).orderBy("m").collect()
    assert all(a.high < b.low for a, b in zip(ends, ends[1:]))


def test_a_later_load_is_added(spark, loaded):
    table, cells, numbers, mark = loaded
    batch = lines(spark, 30_000, 50)
    rows = D.order_rows(batch)
    more, after = D.order_numbers(rows, numbers, mark)
    both = cells.unionByName(D.order_cells(rows, numbers.unionByName(more)))
    for by in ([], ["order_month", "order_status"]):
        assert rows_of(D.counted(both, by, "orders", "orders", ["lines", "revenue"])) == rows_of(plain(table.unionByName(batch), by))
    assert after - mark == more.count()
    assert more.join(numbers, "order_id", "left_semi").count() == 0 and more.agg(F.min("order_no")).first()[0] == mark


def test_customers(loaded):
    table = loaded[0]
    got = D.counted(D.buyer_cells(table), ["order_status"], "buyers", "n")
    assert rows_of(got) == rows_of(table.groupBy("order_status").agg(F.countDistinct("customer_key").alias("n")))


def test_empty(spark, loaded):
    none = loaded[0].limit(0)
    rows = D.order_rows(none)
    numbers, mark = D.order_numbers(rows)
    cells = D.order_cells(rows, numbers)
    assert mark == 1 and cells.count() == 0
    assert [tuple(r) for r in D.counted(cells, [], "orders", "n", ["revenue"]).collect()] == [(0, None)]
    assert D.counted(cells, ["channel"], "orders", "n").count() == 0


def test_bitmaps_are_made_once_a_cell_and_block(loaded):
    """Rows are brought together before bitmaps are made: no exchange between the bitmaps' partial and final form."""
    table, _, numbers, _ = loaded
    plan = D.order_cells(D.order_rows(table), numbers)._jdf.queryExecution().executedPlan().toString()
    last = plan[:plan.index("Exchange")]
    assert "bitmap_construct_agg" in last and "partial_bitmap_construct_agg" in last


def test_sums_do_not_travel_with_orders(spark, loaded):
    """An order is shuffled with its cells alone, once; sums take a row for each cell and task."""
    table = loaded[0]
    rows = D.order_rows(table)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    by_order = [keys for keys in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan) if "order_id" in keys]
    assert len(by_order) == 1 and "," not in by_order[0]
    orders = rows.where("order_id IS NOT NULL")
    assert orders.where("lines IS NOT NULL OR revenue IS NOT NULL").isEmpty()
    assert orders.count() == table.agg(F.countDistinct("order_id")).first()[0]
    assert rows.where("order_id IS NULL").count() == table.select(*D.CELL).distinct().count()


def test_rows_are_numbered_with_their_cells(spark, loaded):
    """Two loads with common orders: numbers as before, and summaries that need no join of orders and numbers."""
    table, _, numbers, mark = loaded
    batch = lines(spark, 30_000, 50)
    first, new, after = D.numbered_rows(D.order_rows(table))
    assert after == mark and rows_of(new) == rows_of(numbers)
    rows = D.order_rows(batch)
    second, more, last = D.numbered_rows(rows, new, after)
    expected, end = D.order_numbers(rows, numbers, mark)
    assert last == end and rows_of(more) == rows_of(expected)
    assert rows_of(second.where("order_no IS NOT NULL").select("order_id", "order_no")) == rows_of(numbers.unionByName(expected).join(batch.select("order_id").distinct(), "order_id", "left_semi"))
    cells = [D.order_cells(first), D.order_cells(second)]
    assert all("order_id" not in keys for c in cells for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)", c.select("orders")._jdf.queryExecution().executedPlan().toString()))
    for by in ([], ["order_month", "order_status"], D.CELL):
        assert rows_of(D.counted(cells[0].unionByName(cells[1]), by, "orders", "orders", ["lines", "revenue"])) == rows_of(plain(table.unionByName(batch), by))
    none, _, same = D.numbered_rows(D.order_rows(table.limit(0)), new, after)
    assert same == after and D.order_cells(none).isEmpty()
