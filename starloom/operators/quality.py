"""Data-quality and integrity checks.

The fact report (negative revenue, zero quantity, missing keys, revenue
mismatches, totals, mean order value, date range) is one two-level aggregation:
lines → one row per order (partial counters, order revenue) → one row. The
constraint checks (primary/unique keys, NOT NULL, foreign keys, declared
length/precision) are the user-level form of what a database would enforce on
write; each returns one row per check with a violation count.

Checks never modify the frame they inspect.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money as M
from ..sources import schemas as S


def revenue_mismatch(revenue: Column, quantity: Column, net_price: Column) -> Column:
    """True unless revenue equals round(quantity × net_price, 2); NULL on either side
    counts as a mismatch (as an element-wise float comparison treats NaN)."""
    expected = F.round(quantity * net_price, 2)
    return ~F.coalesce(revenue == expected, F.lit(False))


def fact_report(fact: DataFrame) -> DataFrame:
    per_order = (fact.groupBy("order_id")
                 .agg(F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col("revenue") < 0).alias("neg"),
                      F.count_if(F.col("quantity") == 0).alias("zero"),
                      F.count_if(F.col("customer_key").isNull() | F.col("product_key").isNull()).alias("miss"),
                      F.count_if(revenue_mismatch(F.col("revenue"), F.col("quantity"), F.col("net_price"))).alias("bad"),
                      F.sum("revenue").alias("order_revenue"),
                      F.min("order_date").alias("dmin"), F.max("order_date").alias("dmax")))
    keyed_revenue = F.when(F.col("order_id").isNotNull(), F.col("order_revenue"))
    def total(c: str) -> Column:   # a count: 0, not NULL, on an empty fact
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    return per_order.agg(
        total("neg").alias("negative_revenue"),
        total("zero").alias("zero_quantity"),
        total("miss").alias("missing_keys"),
        total("bad").alias("revenue_mismatch"),
        total("rows").alias("total_rows"),
        F.count("order_id").cast("long").alias("total_orders"),
        M.money_sum("order_revenue").alias("total_revenue"),
        M.exact_avg(keyed_revenue, 2).alias("avg_order_value"),
        F.min("dmin").alias("first_order_date"),
        F.max("dmax").alias("last_order_date"))


def _row(table: str, column: str, check: str, violations: Column) -> list[Column]:
    return [F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
            F.lit(check).alias("check_name"), violations.cast("long").alias("violations")]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


# Primary / unique keys of the warehouse (natural and surrogate).
UNIQUE_KEYS = [("dim_date", "date_key"), ("dim_customer", "customer_key"), ("dim_customer", "customer_id"),
               ("dim_product", "product_key"), ("dim_product", "product_id"), ("fact_rfm", "customer_key"),
               ("fact_sales", "sale_id"), ("fact_rfm", "rfm_id")]
NOT_NULL = [("dim_date", "date_key"), ("dim_date", "full_date"), ("dim_customer", "customer_key"),
            ("dim_customer", "customer_id"), ("dim_product", "product_key"), ("dim_product", "product_id"),
            ("fact_rfm", "snapshot_date"), ("fact_sales", "sale_id"), ("fact_rfm", "rfm_id")]
FOREIGN_KEYS = [("fact_sales", "date_key", "dim_date"), ("fact_sales", "customer_key", "dim_customer"),
                ("fact_sales", "product_key", "dim_product"), ("fact_rfm", "customer_key", "dim_customer")]


def unique_violations(tables: dict[str, DataFrame], keys=UNIQUE_KEYS) -> DataFrame:
    """Per key: number of key values that occur more than once."""
    parts = []
    for table, col in keys:
        dup = (tables[table].groupBy(col).agg(F.count(F.lit(1)).alias("n"))
               .agg(F.count_if(F.col("n") > 1).alias("v")))
        parts.append(dup.select(*_row(table, col, "unique", F.col("v"))))
    return _union(parts)


def _per_table_counts(table: str, df: DataFrame, aggs: dict[str, tuple[str, Column]]) -> DataFrame:
    """One pass over ``df`` computing every count in ``aggs`` ({alias: (check, expr)}),
    unpivoted to one row per check."""
    names = list(aggs)
    one = df.agg(*[expr.cast("long").alias(f"c{i}") for i, (_, expr) in enumerate(aggs.values())])
    long_form = one.unpivot([], [f"c{i}" for i in range(len(names))], "_slot", "violations")
    slot = F.col("_slot")
    col_expr = check_expr = None
    for i, name in enumerate(names):
        hit = slot == F.lit(f"c{i}")
        col_expr = F.when(hit, F.lit(name)) if col_expr is None else col_expr.when(hit, F.lit(name))
        chk = F.lit(aggs[name][0])
        check_expr = F.when(hit, chk) if check_expr is None else check_expr.when(hit, chk)
    return long_form.select(F.lit(table).alias("table_name"), col_expr.alias("column_name"),
                            check_expr.alias("check_name"), F.col("violations").cast("long").alias("violations"))


def not_null_violations(tables: dict[str, DataFrame], cols=NOT_NULL) -> DataFrame:
    by_table: dict[str, dict] = {}
    for t, c in cols:
        by_table.setdefault(t, {})[c] = ("not_null", F.count_if(F.col(c).isNull()))
    return _union([_per_table_counts(t, tables[t], aggs) for t, aggs in by_table.items()])


def foreign_key_violations(tables: dict[str, DataFrame], fks=FOREIGN_KEYS) -> DataFrame:
    """Per foreign key: child rows whose non-NULL key has no parent row.

    Child rows are first counted per key value (map-side combined), so only the
    distinct keys take part in the anti-join with the parent keys.
    """
    parts = []
    for child, col, parent in fks:
        counts = (tables[child].filter(F.col(col).isNotNull())
                  .groupBy(col).agg(F.count(F.lit(1)).alias("n")))
        orphans = counts.join(tables[parent].select(col).distinct(), col, "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("v"))
                     .select(*_row(child, col, f"fk:{parent}", F.col("v"))))
    return _union(parts)


def fit_violations(tables: dict[str, DataFrame], limits=S.VARCHAR_LIMITS, numeric=S.NUMERIC_LIMITS) -> DataFrame:
    """Values that do not fit the declared VARCHAR(n) / NUMERIC(p, s) columns (one scan per table).

    The frames may hold wider types than declared, as a batch does before it is cast: a number
    fits if it can be cast to the declared type.
    """
    parts = []
    for table, cols in limits.items():
        df = tables[table]
        aggs = {c: (f"varchar({n})", F.count_if(F.length(c) > n)) for c, n in cols.items() if c in df.columns}
        for c, (precision, scale) in numeric.get(table, {}).items():
            if c in df.columns:
                fits = F.col(c).try_cast(f"decimal({precision},{scale})").isNotNull()
                aggs[c] = ("numeric_range", F.count_if(F.col(c).isNotNull() & ~fits))
        if aggs:
            parts.append(_per_table_counts(table, df, aggs))
    return _union(parts)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([df.agg(F.count(F.lit(1)).cast("long").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
                   for name, df in tables.items()])
