"""Dashboard queries (four pages) and the derived shapes their charts show.

The dashboard's SQL compares ``order_status`` with capitalised labels
(``'Cancelled'``, ``'Completed'`` …) while the warehouse stores lower case, and it
treats ``discount_pct`` (stored in percent) as a fraction. The literal behaviour
is the default (``LITERAL`` labels, ``discount_as_fraction=False``); the
``*_fixed`` variants pass the stored labels and scale the discount to a fraction.

Unrounded ratios and averages are DOUBLE computed from exact decimal sums.
Customer- and product-level pages pre-aggregate the fact to one row per customer
or product key before joining the dimension (sums and counts are decomposable),
so the join shuffles customers or products rather than order lines. Questions by month, channel,
status or payment method read the order summary, whose bitmaps give distinct orders and customers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import labels as L
from ..functions import money as M
from ..functions import scoring as SC
from ..functions import text as X
from ..operators.distinct import counted
from ..sources.warehouse import Warehouse


@dataclass(frozen=True)
class StatusLabels:
    completed: str
    cancelled: str
    returned: str
    pending: str


# Fixed label values: as written in the dashboard, and as stored in the fact.
LITERAL = StatusLabels("Completed", "Cancelled", "Returned", "Pending")
STORED = StatusLabels("completed", "cancelled", "returned", "pending")
# Columns that a pivot may have, and the name of the one for orders without a status.
PIVOT_COLUMNS = 100
NO_STATUS = "none"


def desc(c: str) -> Column:
    return F.col(c).desc_nulls_first()


def asc(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def _discount(as_fraction: bool) -> Column:
    return _scaled(F.col("discount_pct"), as_fraction)


def _scaled(percent: Column, as_fraction: bool) -> Column:
    return percent * F.lit(0.01).cast("decimal(3,2)") if as_fraction else percent


def _mean_discount(as_fraction: bool) -> Column:
    """The mean discount ×100 from a summary's sum and count."""
    return _scaled(F.col("discount").cast("decimal(30,2)"), as_fraction).cast("double") / F.nullif(F.col("discount_n"), F.lit(0)) * F.lit(100.0)


def _kept(df: DataFrame, labels: StatusLabels) -> DataFrame:
    return df.filter(F.col("order_status") != F.lit(labels.cancelled))


def _not_cancelled(wh: Warehouse, labels: StatusLabels) -> DataFrame:
    return _kept(wh.fact, labels)


def _dsum(c: str) -> Column:
    return F.sum(c)


def _orders() -> Column:
    return F.countDistinct("order_id").cast("long")


# ── page 1: overview ──────────────────────────────────────────────────────────

def d01_overview_kpi(wh: Warehouse, labels: StatusLabels = LITERAL) -> DataFrame:
    """Revenue, orders, customers, order value, profit and margin (one row)."""
    orders = counted(_kept(wh.order_cells(), labels), [], "orders", "n_orders", ["revenue", "gross_profit"])
    buyers = counted(_kept(wh.buyer_cells(), labels), [], "buyers", "n_buyers")
    rev, gp, n = F.sum("revenue"), F.sum("gross_profit"), F.sum("n_orders").cast("long")
    return (orders.unionByName(buyers, allowMissingColumns=True)   # two one-row results, side by side
            .agg(rev.alias("total_revenue"), n.alias("total_orders"), F.sum("n_buyers").cast("long").alias("total_customers"),
                 M.float_ratio(rev, n).alias("aov"), gp.alias("total_profit"), M.float_ratio(gp, rev, 100).alias("profit_margin_pct")))


def d01_overview_kpi_fixed(wh: Warehouse) -> DataFrame:
    return d01_overview_kpi(wh, STORED)


def d02_monthly_trend(wh: Warehouse, labels: StatusLabels = LITERAL) -> DataFrame:
    cells = _kept(wh.order_cells(), labels).filter(F.col("order_month").isNotNull())
    return (counted(cells, ["order_month"], "orders", "orders", ["revenue", "gross_profit"])
            .select(D.month_label(F.col("order_month")).alias("month"), "revenue", "gross_profit", "orders")
            .orderBy(asc("month")))


def _channel_sums(wh: Warehouse, labels: StatusLabels) -> DataFrame:
    return (_kept(wh.order_cells(), labels).groupBy("channel")
            .agg(F.sum("revenue").alias("_revenue"), F.sum("gross_profit").alias("_gross_profit")))


def d03_channel_revenue(wh: Warehouse, labels: StatusLabels = LITERAL) -> DataFrame:
    return (_channel_sums(wh, labels)
            .select("channel", F.col("_revenue").alias("revenue"))
            .orderBy(desc("revenue"), asc("channel")))


def _share(value: str) -> Column:
    """Share of the grand total, in percent, over an already-grouped (small) frame."""
    return (F.col(value).cast("double") / F.sum(value).over(Window.partitionBy()).cast("double")) * F.lit(100.0)


def channel_share(wh: Warehouse, labels: StatusLabels = LITERAL) -> DataFrame:
    """Donut slices: each channel's share of revenue."""
    return (_channel_sums(wh, labels)
            .select("channel", F.col("_revenue").alias("revenue"),
                    _share("_revenue").alias("share_pct"))
            .orderBy(desc("revenue"), asc("channel")))


def d04_channel_profit(wh: Warehouse, labels: StatusLabels = LITERAL) -> DataFrame:
    return (_channel_sums(wh, labels)
            .select("channel", F.col("_revenue").alias("revenue"),
                    F.col("_gross_profit").alias("gross_profit"))
            .orderBy(desc("revenue"), asc("channel")))


def kpi_labels(wh: Warehouse, labels: StatusLabels = LITERAL) -> DataFrame:
    """The overview KPI cards as display strings."""
    k = d01_overview_kpi(wh, labels)
    return k.select(L.money_label(F.col("total_revenue")).alias("total_revenue"),
                    L.number_label(F.col("total_orders")).alias("total_orders"),
                    L.number_label(F.col("total_customers")).alias("unique_customers"),
                    L.money_label(F.col("aov")).alias("avg_order_value"),
                    L.money_label(F.col("total_profit")).alias("gross_profit"),
                    L.pct_label(F.col("profit_margin_pct")).alias("profit_margin"))


# ── page 2: products ──────────────────────────────────────────────────────────

def _per_product(wh: Warehouse, labels: StatusLabels, *cols: str, discount_as_fraction: bool = False) -> DataFrame:
    """Not-cancelled lines reduced to one row per product key (revenue, profit and
    discount sums), then joined to the requested product columns: the join meets
    one row per product instead of every order line."""
    sums = (_not_cancelled(wh, labels).withColumn("_disc", _discount(discount_as_fraction))
            .groupBy("product_key")
            .agg(F.sum("revenue").alias("rev"), F.sum("gross_profit").alias("gp"),
                 F.sum("_disc").alias("ds"), F.count("_disc").alias("dn")))
    return sums.join(wh["dim_product"].select("product_key", *cols), "product_key")


def d05_top_products(wh: Warehouse, labels: StatusLabels = LITERAL, limit: int = 15) -> DataFrame:
    return (_per_product(wh, labels, "product_name", "category")
            .groupBy("product_name", "category")
            .agg(_dsum("rev").alias("revenue"), _dsum("gp").alias("gross_profit"),
                 M.float_ratio(F.sum("gp"), F.sum("rev"), 100).alias("margin_pct"))
            .withColumn("revenue_label", L.money_label(F.col("revenue")))
            .orderBy(desc("revenue"), asc("product_name"), asc("category"))
            .limit(limit))


def d06_category_margin(wh: Warehouse, labels: StatusLabels = LITERAL) -> DataFrame:
    return (_per_product(wh, labels, "category")
            .groupBy("category")
            .agg(_dsum("rev").alias("revenue"), _dsum("gp").alias("gross_profit"),
                 M.float_ratio(F.sum("gp"), F.sum("rev"), 100).alias("margin_pct"))
            .orderBy(desc("revenue"), asc("category")))


def _subcategory_sums(wh: Warehouse, labels: StatusLabels) -> DataFrame:
    return (_per_product(wh, labels, "category", "subcategory")
            .groupBy("category", "subcategory")
            .agg(F.sum("rev").alias("revenue"), F.sum("gp").alias("gross_profit")))


def d07_subcategory(wh: Warehouse, labels: StatusLabels = LITERAL) -> DataFrame:
    s = _subcategory_sums(wh, labels)
    return s.select("category", "subcategory", "revenue", "gross_profit")


def treemap_rollup(wh: Warehouse, labels: StatusLabels = LITERAL) -> DataFrame:
    """Root → category → sub-category boxes: revenue per box; colour = gross profit
    for a leaf, the revenue-weighted mean of the children's colour for a parent
    (exact decimal, rounded to cents)."""
    s = _subcategory_sums(wh, labels)
    return (s.rollup("category", "subcategory")
            .agg(F.sum("revenue").alias("_rev"),
                 F.sum((F.col("revenue") * F.col("gross_profit")).cast("decimal(38,4)")).alias("_rev_gp"),
                 F.grouping_id().alias("_gid"))
            .select(F.when(F.col("_gid") == 3, F.lit(0)).when(F.col("_gid") == 1, F.lit(1))
                     .otherwise(F.lit(2)).alias("level"),
                    "category", "subcategory",
                    F.col("_rev").alias("revenue"),
                    F.round(F.col("_rev_gp") / F.nullif(F.col("_rev"), F.lit(0)), 2).alias("color"))
            .orderBy(asc("level"), asc("category"), asc("subcategory")))


def d08_margin_tier(wh: Warehouse, labels: StatusLabels = LITERAL, discount_as_fraction: bool = False) -> DataFrame:
    return (_per_product(wh, labels, "margin_tier", discount_as_fraction=discount_as_fraction)
            .groupBy("margin_tier")
            .agg(_dsum("rev").alias("revenue"), _dsum("gp").alias("gross_profit"),
                 (F.sum("ds").cast("double") / F.sum("dn") * F.lit(100.0)).alias("avg_discount"),
                 M.float_ratio(F.sum("gp"), F.sum("rev"), 100).alias("realized_margin"))
            .orderBy(desc("realized_margin"), asc("margin_tier")))


def d08_margin_tier_fixed(wh: Warehouse) -> DataFrame:
    return d08_margin_tier(wh, STORED, discount_as_fraction=True)


# ── page 3: customers ─────────────────────────────────────────────────────────

def d09_segment_profile(wh: Warehouse) -> DataFrame:
    return (wh["fact_rfm"].groupBy("segment")
            .agg(F.count(F.lit(1)).cast("long").alias("customers"),
                 M.float_avg("rfm_score").alias("avg_rfm_score"),
                 M.float_avg("recency_days").alias("avg_recency"),
                 M.float_avg("frequency").alias("avg_frequency"),
                 M.float_avg("monetary").alias("avg_monetary"))
            .orderBy(desc("avg_monetary"), asc("segment")))


def segment_share(wh: Warehouse) -> DataFrame:
    """Donut slices: each segment's share of scored customers."""
    return (d09_segment_profile(wh)
            .select("segment", "customers", _share("customers").alias("share_pct"))
            .orderBy(desc("customers"), asc("segment")))


def _per_customer(wh: Warehouse, labels: StatusLabels, discount_as_fraction: bool = False) -> DataFrame:
    """Not-cancelled lines pre-aggregated to one row per customer key."""
    return (_not_cancelled(wh, labels)
            .withColumn("_disc", _discount(discount_as_fraction))
            .groupBy("customer_key")
            .agg(F.sum("revenue").alias("revenue"), F.sum("gross_profit").alias("gross_profit"),
                 F.sum("_disc").alias("disc_sum"), F.count("_disc").alias("disc_n")))


def d10_segment_ltv(wh: Warehouse, labels: StatusLabels = LITERAL) -> DataFrame:
    r = wh["fact_rfm"].select("customer_key", "segment")
    return (r.join(_per_customer(wh, labels), "customer_key")
            .groupBy("segment")
            .agg(F.countDistinct("customer_key").cast("long").alias("customers"),
                 _dsum("revenue").alias("total_revenue"),
                 M.float_ratio(F.sum("revenue"), F.countDistinct("customer_key")).alias("ltv"),
                 M.float_ratio(F.sum("gross_profit"), F.countDistinct("customer_key")).alias("avg_profit"))
            .orderBy(desc("ltv"), asc("segment")))


def d11_customer_kpi(wh: Warehouse, labels: StatusLabels = LITERAL) -> DataFrame:
    """Total scored customers, Champions / Loyal / At Risk counts (0 if absent) and
    the unweighted mean of the per-segment LTV (0 if there is none).

    Both inputs are per-segment (at most a handful of rows); they are stacked and
    reduced in one aggregate, with no join.
    """
    seg = d09_segment_profile(wh).select("segment", F.col("customers").cast("long").alias("customers"),
                                         F.lit(None).cast("double").alias("ltv"))
    ltv = d10_segment_ltv(wh, labels).select("segment", F.lit(None).cast("long").alias("customers"), "ltv")
    both = seg.unionByName(ltv)

    def count_of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("segment") == F.lit(name), F.col("customers"))), F.lit(0)).cast("long")

    return (both.agg(F.coalesce(F.sum("customers"), F.lit(0)).cast("long").alias("total_customers"),
                     count_of(SC.CHAMPIONS).alias("champions"),
                     count_of(SC.LOYAL).alias("loyal"),
                     count_of(SC.AT_RISK).alias("at_risk"),
                     _ordered_mean("ltv").alias("avg_ltv"))
                .withColumn("avg_ltv_label", L.money_label(F.col("avg_ltv")))
                .withColumn("total_customers_label", L.number_label(F.col("total_customers"))))


def _ordered_mean(c: str) -> Column:
    """Mean of a handful of per-segment doubles, summed in ascending order so the
    result does not depend on partitioning; 0 when there is none."""
    vals = F.array_sort(F.collect_list(F.col(c)))
    total = F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(vals) > 0, total / F.size(vals)).otherwise(F.lit(0.0))


def _customer_rollup(wh: Warehouse, labels: StatusLabels, *cols: str, discount_as_fraction: bool = False) -> DataFrame:
    c = wh["dim_customer"].select("customer_key", "customer_id", *cols)
    return c.join(_per_customer(wh, labels, discount_as_fraction), "customer_key")


def d12_premium(wh: Warehouse, labels: StatusLabels = LITERAL) -> DataFrame:
    j = _customer_rollup(wh, labels, "is_premium")
    return (j.groupBy("is_premium")
            .agg(F.countDistinct("customer_id").cast("long").alias("customers"),
                 _dsum("revenue").alias("total_revenue"),
                 M.float_ratio(F.sum("revenue"), F.countDistinct("customer_id")).alias("avg_revenue"),
                 (F.sum("disc_sum").cast("double") / F.sum("disc_n") * F.lit(100.0)).alias("avg_discount"))
            .select(L.premium_label(F.col("is_premium")).alias("segment"), "customers", "total_revenue",
                    "avg_revenue", "avg_discount")
            .orderBy(desc("total_revenue"), asc("segment")))


def d13_age_group(wh: Warehouse, labels: StatusLabels = LITERAL) -> DataFrame:
    return (_customer_rollup(wh, labels, "age_group").groupBy("age_group")
            .agg(F.countDistinct("customer_id").cast("long").alias("customers"),
                 M.float_ratio(F.sum("revenue"), F.countDistinct("customer_id")).alias("avg_revenue"))
            .orderBy(desc("avg_revenue"), asc("age_group")))


def d14_top_states(wh: Warehouse, labels: StatusLabels = LITERAL, limit: int = 15) -> DataFrame:
    return (_customer_rollup(wh, labels, "state").groupBy("state")
            .agg(_dsum("revenue").alias("revenue"),
                 F.countDistinct("customer_id").cast("long").alias("customers"),
                 M.float_ratio(F.sum("revenue"), F.countDistinct("customer_id")).alias("ltv"))
            .orderBy(desc("revenue"), asc("state"))
            .limit(limit))


# ── page 4: orders ────────────────────────────────────────────────────────────

def d15_order_kpi(wh: Warehouse, labels: StatusLabels = LITERAL, discount_as_fraction: bool = False) -> DataFrame:
    """Distinct orders in total and per status label, and the mean discount ×100."""
    named = {name: F.col("order_status") == F.lit(getattr(labels, name)) for name in ("completed", "cancelled", "returned", "pending")}
    return (counted(wh.order_cells(), [], "orders", "total_orders", ["discount", "discount_n"], named)
            .select("total_orders", *named, (_mean_discount(discount_as_fraction)).alias("avg_discount_pct")))


def d15_order_kpi_fixed(wh: Warehouse) -> DataFrame:
    return d15_order_kpi(wh, STORED, discount_as_fraction=True)


def _status_sums(wh: Warehouse) -> DataFrame:
    return counted(wh.order_cells(), ["order_status"], "orders", "orders", ["revenue"])


def d16_status(wh: Warehouse) -> DataFrame:
    return (_status_sums(wh).select("order_status", "orders", "revenue")
            .orderBy(desc("orders"), asc("order_status")))


def status_share(wh: Warehouse) -> DataFrame:
    """Donut slices: each status's share of orders."""
    return (_status_sums(wh).select("order_status", "orders", _share("orders").alias("share_pct"))
            .orderBy(desc("orders"), asc("order_status")))


def d17_payment(wh: Warehouse, labels: StatusLabels = LITERAL, discount_as_fraction: bool = False) -> DataFrame:
    return (counted(_kept(wh.order_cells(), labels), ["payment_method"], "orders", "orders", ["revenue", "discount", "discount_n"])
            .select("payment_method", "orders", "revenue", _mean_discount(discount_as_fraction).alias("avg_discount"),
                    L.money_label(F.col("revenue")).alias("revenue_label"))
            .orderBy(desc("revenue"), asc("payment_method")))


def d18_discount_band(wh: Warehouse, labels: StatusLabels = LITERAL, discount_as_fraction: bool = False) -> DataFrame:
    return (_not_cancelled(wh, labels)
            .withColumn("discount_band", L.discount_band(_discount(discount_as_fraction)))
            .groupBy("discount_band")
            .agg(_orders().alias("orders"), _dsum("revenue").alias("revenue"),
                 _dsum("gross_profit").alias("gross_profit"),
                 M.float_ratio(F.sum("gross_profit"), F.sum("revenue"), 100).alias("margin_pct"))
            .withColumn("band", X.strip_sort_prefix(F.col("discount_band")))
            .orderBy(asc("discount_band")))


def d18_discount_band_fixed(wh: Warehouse) -> DataFrame:
    return d18_discount_band(wh, STORED, discount_as_fraction=True)


def _channel_status(wh: Warehouse) -> DataFrame:
    return counted(wh.order_cells(), ["channel", "order_status"], "orders", "orders")


def d19_channel_status(wh: Warehouse) -> DataFrame:
    return _channel_status(wh).orderBy(asc("channel"), asc("order_status"))


class TooManyColumns(ValueError):
    pass


def pivoted(df: DataFrame, rows: str, columns: str, value: str, most: int = PIVOT_COLUMNS) -> DataFrame:
    """One row per ``rows`` and one integer column per value of ``columns`` that is there, 0 where a pair is absent.

    The values are discovered first, in one bounded step; more than ``most`` raise, since no value may be
    dropped without a word. NULL counts as a value and is called ``none``; a value of that name then joins it.
    """
    named = df.withColumn(columns, F.coalesce(columns, F.lit(NO_STATUS)))
    found = sorted(r[0] for r in named.select(columns).distinct().limit(most + 1).collect())
    if len(found) > most:
        raise TooManyColumns(f"{columns} has more than {most} values")
    return named.groupBy(rows).agg(*[F.coalesce(F.sum(F.when(F.col(columns) == v, F.col(value))), F.lit(0)).cast("long").alias(v) for v in found])


def channel_status_pivot(wh: Warehouse) -> DataFrame:
    """Heat map: one row per channel, one integer column per status that orders have, 0 where absent."""
    return pivoted(_channel_status(wh), "channel", "order_status", "orders").orderBy(asc("channel"))


def channel_status_pivot_unknown(wh: Warehouse) -> DataFrame:
    """The heat map where every 7th order has a status that the dashboard does not know, and every 11th none; with all orders beside."""
    order = F.col("order_id")
    status = F.when(order % 11 == 4, F.lit(None)).when(order % 7 == 2, F.lit("on hold")).otherwise(F.col("order_status"))
    counts = wh.fact.withColumn("order_status", status).groupBy("channel", "order_status").agg(_orders().alias("orders"))
    total = wh.fact.groupBy("channel").agg(_orders().alias("all_orders"))
    return pivoted(counts, "channel", "order_status", "orders").join(total, "channel").orderBy(asc("channel"))


def _monthly_status(wh: Warehouse) -> DataFrame:
    return (wh.order_cells().filter(F.col("order_month").isNotNull())
            .groupBy(F.col("order_month").alias("_month"), "order_status")
            .agg(F.sum("revenue").alias("_revenue")))


def d20_monthly_status(wh: Warehouse) -> DataFrame:
    return (_monthly_status(wh)
            .select(D.month_label(F.col("_month")).alias("month"), "order_status",
                    F.col("_revenue").alias("revenue"))
            .orderBy(asc("month"), asc("order_status")))


def monthly_status_stack(wh: Warehouse) -> DataFrame:
    """Stacked area: running revenue across statuses within each month."""
    w = (Window.partitionBy("_month").orderBy(F.col("order_status").asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (_monthly_status(wh)
            .select(D.month_label(F.col("_month")).alias("month"), "order_status",
                    F.col("_revenue").alias("revenue"),
                    F.sum("_revenue").over(w).alias("stacked_revenue"))
            .orderBy(asc("month"), asc("order_status")))


DASHBOARD = {
    "d01_overview_kpi": d01_overview_kpi,
    "d02_monthly_trend": d02_monthly_trend,
    "d03_channel_revenue": d03_channel_revenue,
    "d04_channel_profit": d04_channel_profit,
    "d05_top_products": d05_top_products,
    "d06_category_margin": d06_category_margin,
    "d07_subcategory": d07_subcategory,
    "d08_margin_tier": d08_margin_tier,
    "d09_segment_profile": d09_segment_profile,
    "d10_segment_ltv": d10_segment_ltv,
    "d11_customer_kpi": d11_customer_kpi,
    "d12_premium": d12_premium,
    "d13_age_group": d13_age_group,
    "d14_top_states": d14_top_states,
    "d15_order_kpi": d15_order_kpi,
    "d16_status": d16_status,
    "d17_payment": d17_payment,
    "d18_discount_band": d18_discount_band,
    "d19_channel_status": d19_channel_status,
    "d20_monthly_status": d20_monthly_status,
    "channel_share": channel_share,
    "status_share": status_share,
    "segment_share": segment_share,
    "treemap_rollup": treemap_rollup,
    "channel_status_pivot": channel_status_pivot,
    "channel_status_pivot_unknown": channel_status_pivot_unknown,
    "monthly_status_stack": monthly_status_stack,
    "kpi_labels": kpi_labels,
    "d01_overview_kpi_fixed": d01_overview_kpi_fixed,
    "d08_margin_tier_fixed": d08_margin_tier_fixed,
    "d15_order_kpi_fixed": d15_order_kpi_fixed,
    "d18_discount_band_fixed": d18_discount_band_fixed,
}
