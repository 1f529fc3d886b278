"""The twelve warehouse reports, as DataFrame plans over a :class:`Warehouse`.

Conventions shared by every report:

* rounded money and averages are exact DECIMALs (decimal sums, one HALF_UP
  rounding); counts are BIGINT;
* ``ORDER BY`` keys that can tie are followed by the group keys, so LIMIT results
  are deterministic; NULL placement is explicit (ASC → last, DESC → first);
* joins to ``dim_date`` broadcast it (row count known from the calendar range);
  joins to the other dimensions are left to AQE, which broadcasts from measured
  sizes and otherwise sort-merges and splits skewed keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money as M
from ..functions import scoring as SC
from ..functions import text as X
from ..operators.distinct import counted
from ..sources.warehouse import Warehouse

COMPLETED, RETURNED, CANCELLED = "completed", "returned", "cancelled"


def _completed(wh: Warehouse, label: str = COMPLETED) -> DataFrame:
    return wh.fact.filter(F.col("order_status") == F.lit(label))


def _orders() -> Column:
    return F.countDistinct("order_id").cast("long")


def _units(col: str = "quantity") -> Column:
    return F.sum(col).cast("long")


def _margin() -> Column:
    return M.exact_ratio_pct(F.sum("gross_profit"), F.sum("revenue"), 1)


def desc(c: str) -> Column:
    return F.col(c).desc_nulls_first()


def asc(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def q01_monthly(wh: Warehouse) -> DataFrame:
    """Revenue, orders, units and gross margin per calendar month."""
    d = wh.dim_date_for_join().select("date_key", "year", "month", "month_name")
    return (_completed(wh).join(d, "date_key")
            .groupBy("year", "month", "month_name")
            .agg(_orders().alias("total_orders"), _units().alias("units_sold"),
                 M.money_sum("revenue").alias("total_revenue"),
                 M.money_sum("gross_profit").alias("total_gross_profit"),
                 _margin().alias("gross_margin_pct"))
            .orderBy(asc("year"), asc("month")))


def q02_category_revenue(wh: Warehouse) -> DataFrame:
    p = wh["dim_product"].select("product_key", "category")
    return (_completed(wh).join(p, "product_key")
            .groupBy("category")
            .agg(_orders().alias("orders"), _units().alias("units_sold"),
                 M.money_sum("revenue").alias("total_revenue"),
                 M.exact_avg("net_price", 2).alias("avg_selling_price"),
                 M.money_sum("gross_profit").alias("gross_profit"),
                 _margin().alias("margin_pct"))
            .orderBy(desc("total_revenue"), asc("category")))


def q03_top_products(wh: Warehouse, limit: int = 20) -> DataFrame:
    """Best sellers by revenue. Grouped by name/category/sub-category/brand, so two
    products sharing all four merge into one row.

    The fact is first reduced to one row per product key (sums and counts are
    decomposable), so the product join shuffles products, not order lines.
    """
    keys = ["product_name", "category", "subcategory", "brand"]
    per_product = (_completed(wh).groupBy("product_key")
                   .agg(F.sum("quantity").alias("q"), F.sum("revenue").alias("rev"),
                        F.sum("gross_profit").alias("gp"), F.sum("discount_pct").alias("ds"),
                        F.count("discount_pct").alias("dn")))
    p = wh["dim_product"].select("product_key", *keys)
    return (per_product.join(p, "product_key")
            .groupBy(*keys)
            .agg(F.sum("q").cast("long").alias("units_sold"),
                 F.round(F.sum("rev"), 2).alias("total_revenue"),
                 F.round(F.sum("gp"), 2).alias("gross_profit"),
                 M.exact_avg_from(F.sum("ds"), F.sum("dn"), 1).alias("avg_discount_pct"))
            .orderBy(desc("total_revenue"), *[asc(k) for k in keys])
            .limit(limit))


def q04_channel_payment(wh: Warehouse) -> DataFrame:
    done = wh.order_cells().filter(F.col("order_status") == F.lit(COMPLETED))
    return (counted(done, ["channel", "payment_method"], "orders", "orders", ["revenue", "revenue_n"])
            .select("channel", "payment_method", "orders", F.round("revenue", 2).alias("total_revenue"),
                    M.exact_avg_from(F.col("revenue"), F.col("revenue_n"), 2).alias("avg_order_revenue"))
            .orderBy(desc("total_revenue"), asc("channel"), asc("payment_method")))


def q05_top_customers(wh: Warehouse, limit: int = 20) -> DataFrame:
    """Top customers by lifetime value.

    Every grouping column is an attribute of the customer key (unique in the
    dimension), so the fact is aggregated per customer key first and only one row
    per customer meets the dimension.
    """
    per_customer = (_completed(wh).groupBy("customer_key")
                    .agg(_orders().alias("total_orders"), _units().alias("units_bought"),
                         F.sum("revenue").alias("rev"),
                         F.min("order_date").alias("first_order"),
                         F.max("order_date").alias("last_order")))
    c = (wh["dim_customer"]
         .select("customer_key", "customer_id", "state", "age_group", "is_premium",
                 X.full_name(F.col("first_name"), F.col("last_name")).alias("customer_name")))
    return (per_customer.join(c, "customer_key")
            .groupBy("customer_id", "customer_name", "state", "age_group", "is_premium")
            .agg(F.sum("total_orders").cast("long").alias("total_orders"),
                 F.sum("units_bought").cast("long").alias("units_bought"),
                 F.round(F.sum("rev"), 2).alias("lifetime_value"),
                 F.min("first_order").alias("first_order"),
                 F.max("last_order").alias("last_order"))
            .orderBy(desc("lifetime_value"), asc("customer_id"))
            .limit(limit))


def _status_flags_per_order(fact: DataFrame, by: list[str], statuses: dict[str, str]) -> DataFrame:
    """One row per (by…, order_id) with a 0/1 flag per status.

    Counting distinct orders per status then needs plain sums: one aggregation
    with map-side combining instead of one distinct-expansion per status.
    """
    flags = [F.max(F.when(F.col("order_status") == F.lit(v), F.lit(1)).otherwise(F.lit(0))).alias(k)
             for k, v in statuses.items()]
    return (fact.filter(F.col("order_id").isNotNull())
                .groupBy(*by, "order_id").agg(*flags))


def q06_return_rates(wh: Warehouse) -> DataFrame:
    """Order counts by status and the return rate per category (all statuses)."""
    p = wh["dim_product"].select("product_key", "category")
    per_order = _status_flags_per_order(
        wh.fact.join(p, "product_key"), ["category"],
        {"returned": RETURNED, "cancelled": CANCELLED, "completed": COMPLETED})
    return (per_order.groupBy("category")
            .agg(F.count(F.lit(1)).cast("long").alias("total_orders"),
                 F.sum("returned").cast("long").alias("returned"),
                 F.sum("cancelled").cast("long").alias("cancelled"),
                 F.sum("completed").cast("long").alias("completed"))
            .withColumn("return_rate_pct",
                        M.exact_ratio_pct(F.col("returned").cast("decimal(20,0)"),
                                          F.col("total_orders").cast("decimal(20,0)"), 1))
            .orderBy(desc("return_rate_pct"), asc("category")))


def _per_customer_order(fact: DataFrame) -> DataFrame:
    """Lines reduced to one row per (customer key, order): revenue, line count and
    discount sums. Keeping the order id in the key keeps distinct-order counts
    exact whatever the data; the reduction is lines → orders before any join."""
    return (fact.groupBy("customer_key", "order_id")
            .agg(F.sum("revenue").alias("rev"), F.count("revenue").alias("rev_n"),
                 F.count(F.lit(1)).alias("lines"),
                 F.sum("discount_pct").alias("ds"), F.count("discount_pct").alias("dn")))


def q07_state_revenue(wh: Warehouse) -> DataFrame:
    c = wh["dim_customer"].select("customer_key", "customer_id", "state")
    return (_per_customer_order(_completed(wh)).join(c, "customer_key")
            .groupBy("state")
            .agg(F.countDistinct("customer_id").cast("long").alias("customers"),
                 _orders().alias("orders"),
                 F.round(F.sum("rev"), 2).alias("total_revenue"),
                 M.exact_avg_from(F.sum("rev"), F.sum("rev_n"), 2).alias("avg_order_value"))
            .orderBy(desc("total_revenue"), asc("state")))


def q08_premium_vs_standard(wh: Warehouse) -> DataFrame:
    """Premium vs standard customers. ``avg_order_value`` averages each line's
    order total (orders of every status), so larger orders weigh more.

    Completed lines are reduced per (customer, order) first; each reduced row
    carries its line count, so the line-weighted average stays exact.
    """
    order_totals = (wh.fact.groupBy("order_id")
                    .agg(F.sum("revenue").alias("order_revenue")))
    c = wh["dim_customer"].select("customer_key", "customer_id", "is_premium")
    weighted = F.when(F.col("order_revenue").isNotNull(), F.col("order_revenue") * F.col("lines"))
    weight = F.when(F.col("order_revenue").isNotNull(), F.col("lines"))
    return (_per_customer_order(_completed(wh))
            .join(order_totals, "order_id")
            .join(c, "customer_key")
            .groupBy("is_premium")
            .agg(F.countDistinct("customer_id").cast("long").alias("customers"),
                 _orders().alias("total_orders"),
                 M.exact_avg_from(F.sum(weighted), F.sum(weight), 2).alias("avg_order_value"),
                 F.round(F.sum("rev"), 2).alias("total_revenue"),
                 M.exact_avg_from(F.sum("ds"), F.sum("dn"), 1).alias("avg_discount_pct"))
            .orderBy(desc("is_premium")))


def q09_discount_impact(wh: Warehouse) -> DataFrame:
    return (_completed(wh)
            .groupBy("discount_pct")
            .agg(_orders().alias("orders"), _units().alias("units_sold"),
                 M.money_sum("discount_amt").alias("total_discount_given"),
                 M.money_sum("revenue").alias("net_revenue"),
                 M.money_sum("gross_profit").alias("gross_profit"),
                 _margin().alias("margin_pct"))
            .orderBy(asc("discount_pct")))


def q10_row_counts(wh: Warehouse) -> DataFrame:
    parts = [wh[name].agg(F.count(F.lit(1)).cast("long").alias("rows"))
                     .select(F.lit(name).alias("table_name"), "rows")
             for name in ["dim_date", "dim_customer", "dim_product", "fact_sales", "fact_rfm"]]
    return reduce(DataFrame.unionAll, parts)


def q11_segments(wh: Warehouse) -> DataFrame:
    """Segment sizes and averages; shares are over the (four-row) grouped result."""
    everything = Window.partitionBy()
    g = (wh["fact_rfm"].groupBy("segment")
         .agg(F.count(F.lit(1)).cast("long").alias("customers"),
              M.exact_avg("recency_days", 0, integral=True).alias("avg_recency_days"),
              M.exact_avg("frequency", 1, integral=True).alias("avg_orders"),
              M.exact_avg("monetary", 2).alias("avg_lifetime_value"),
              F.sum("monetary").alias("_monetary"),
              M.exact_avg("rfm_score", 1, integral=True).alias("avg_rfm_score")))
    return (g.withColumn("pct_of_customers",
                         M.exact_ratio_pct(F.col("customers").cast("decimal(20,0)"),
                                           F.sum("customers").over(everything).cast("decimal(20,0)"), 1))
             .withColumn("total_revenue", F.round("_monetary", 2))
             .withColumn("pct_of_revenue",
                         M.exact_ratio_pct(F.col("_monetary"), F.sum("_monetary").over(everything), 1))
             .select("segment", "customers", "pct_of_customers", "avg_recency_days", "avg_orders",
                     "avg_lifetime_value", "total_revenue", "pct_of_revenue", "avg_rfm_score")
             .orderBy(desc("avg_rfm_score"), asc("segment")))


def q12_champions_lost(wh: Warehouse, segments=(SC.CHAMPIONS, SC.LOST)) -> DataFrame:
    c = wh["dim_customer"].select("customer_key", "age_group", "is_premium", "state")
    return (wh["fact_rfm"].filter(F.col("segment").isin(*segments))
            .join(c, "customer_key")
            .groupBy("segment", "age_group", "is_premium", "state")
            .agg(F.countDistinct("customer_key").cast("long").alias("customers"),
                 M.exact_avg("recency_days", 0, integral=True).alias("avg_recency_days"),
                 M.exact_avg("frequency", 1, integral=True).alias("avg_orders"),
                 M.exact_avg("monetary", 2).alias("avg_spend"),
                 M.money_sum("monetary").alias("total_spend"))
            .orderBy(asc("segment"), desc("customers"), asc("age_group"), asc("is_premium"), asc("state")))


REPORTS = {
    "q01_monthly": q01_monthly,
    "q02_category_revenue": q02_category_revenue,
    "q03_top_products": q03_top_products,
    "q04_channel_payment": q04_channel_payment,
    "q05_top_customers": q05_top_customers,
    "q06_return_rates": q06_return_rates,
    "q07_state_revenue": q07_state_revenue,
    "q08_premium_vs_standard": q08_premium_vs_standard,
    "q09_discount_impact": q09_discount_impact,
    "q10_row_counts": q10_row_counts,
    "q11_segments": q11_segments,
    "q12_champions_lost": q12_champions_lost,
}
