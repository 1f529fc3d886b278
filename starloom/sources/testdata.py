"""Adapter from the TPC-H-like test tables to the warehouse's raw inputs.

The warehouse pipeline takes three raw inputs — customers, products and order
lines. The test data ships TPC-H-like tables instead; the mapping below is fixed
(it is the documented fixture mapping shared with the SQL oracle), so both engines
start from the same raw rows.

Scale notes: every mapping is a per-row projection. ``customer ⋈ nation`` joins a
25-row table (broadcast by the planner from its file size). Orders are also offered
as two parts — order headers (one row per order) and order lines — so the fact
build can resolve the customer key on headers, four times fewer rows than lines,
and price, cost and product key in one join of the lines with the stored product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money as M
from . import schemas as S

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed values of the fixture mapping.
SEGMENT_AGE_GROUP = {"AUTOMOBILE": "18-24", "BUILDING": "25-34", "FURNITURE": "35-44",
                     "HOUSEHOLD": "45-54"}
AGE_GROUP_OTHER = "55+"
PRIORITY_PAYMENT = {"1-URGENT": "paypal", "2-HIGH": "debit_card", "3-MEDIUM": "bank_transfer"}
PAYMENT_OTHER = "credit_card"
CHANNEL_BY_CUSTKEY_MOD5 = {0: "mobile", 1: "email", 2: "social"}
CHANNEL_OTHER = "web"
SIGNUP_EPOCH = "1995-01-01"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def calendar_bounds(spark: SparkSession, sf_dir: str) -> tuple:
    """First and last order date of the data: the calendar range of the date
    dimension and the RFM snapshot date (one global min/max aggregate)."""
    d = F.col("o_orderdate").cast("date")
    row = read_table(spark, sf_dir, "orders").agg(F.min(d).alias("s"), F.max(d).alias("e")).first()
    return row["s"], row["e"]


def _case(col, mapping: dict, other):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(other))


def _unit_cost(partkey, price):
    # cost ratio 5 %..105 % of the price, by part key (exact decimal ratio)
    ratio = (F.lit(5) + F.lit(5) * (partkey % 21)).cast("decimal(5,0)") * F.lit(0.01).cast("decimal(3,2)")
    return M.unit_cost_from_ratio(price, ratio)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    # nation is a small fixed table: the planner broadcasts it from its file size
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    email_id = key - F.when(key % 50 == 49, F.lit(1)).otherwise(F.lit(0))
    df = c.join(n, c.c_nationkey == n.n_nationkey, "inner").select(
        key.alias("customer_id"),
        F.lit("Customer").alias("first_name"),
        F.substring("c_name", 10, 9).alias("last_name"),
        F.concat(F.lit("  User"), email_id.cast("string"), F.lit("@Example.COM ")).alias("email"),
        F.col("n_name").alias("city"),
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("state"),
        F.lit("US").alias("country"),
        _case(F.col("c_mktsegment"), SEGMENT_AGE_GROUP, AGE_GROUP_OTHER).alias("age_group"),
        _case(key % 3, {0: "M", 1: "F"}, "Other").alias("gender"),
        F.date_add(F.lit(SIGNUP_EPOCH).cast("date"), (key % 2000).cast("int")).alias("signup_date"),
        (key % 20 < 3).alias("is_premium"),
    )
    return S.conform(df, S.RAW_CUSTOMERS)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    price = F.col("p_retailprice").cast(S.MONEY)
    df = p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.expr("substring(p_name, instr(p_name, ' ') + 1)").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        price.alias("unit_price"),
        _unit_cost(F.col("p_partkey"), price).alias("unit_cost"),
        (F.col("p_partkey") % 10 != 0).alias("is_active"),
    )
    return S.conform(df, S.RAW_PRODUCTS)


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the order-level attributes of every line."""
    o = read_table(spark, sf_dir, "orders")
    okey = F.col("o_orderkey")
    return o.select(
        okey.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(okey % 5 < 3, F.lit("completed")).when(okey % 5 == 3, F.lit("returned"))
         .otherwise(F.lit("cancelled")).alias("order_status"),
        _case(F.col("o_orderpriority"), PRIORITY_PAYMENT, PAYMENT_OTHER).alias("payment_method"),
        _case(F.col("o_custkey") % 5, CHANNEL_BY_CUSTKEY_MOD5, CHANNEL_OTHER).alias("channel"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line as it is ordered; its price and cost are the product's."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("smallint").alias("quantity"),
        (F.col("l_discount").cast("decimal(4,2)") * F.lit(250)).cast(S.PCT).alias("discount_pct"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order's attributes: the flat raw input (one row per line)."""
    prices = raw_products(spark, sf_dir).select("product_id", "unit_price", "unit_cost")
    lines = order_lines(spark, sf_dir).join(prices, "product_id", "left").join(order_headers(spark, sf_dir), "order_id", "left")
    return S.conform(lines, S.RAW_ORDERS)
