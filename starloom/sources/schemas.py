"""Declared schemas of the warehouse tables and the raw inputs.

Types follow the warehouse DDL with one deliberate change: surrogate keys and ids
are 64-bit (``LongType``) — at the target scale customer and line counts exceed
the 32-bit range of a SERIAL column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names, types and lengths are those of the warehouse that this one replaces.
MONEY = T.DecimalType(10, 2)       # unit prices, discount amount, net price
AMOUNT = T.DecimalType(12, 2)      # revenue, cogs, gross profit, monetary
TOTAL = T.DecimalType(22, 2)       # a customer's money over all time
PCT = T.DecimalType(5, 2)          # discount_pct
MARGIN = T.DecimalType(6, 1)       # product margin_pct


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


DIM_DATE = _s(
    ("date_key", T.IntegerType(), False),
    ("full_date", T.DateType(), False),
    ("year", T.ShortType(), True),
    ("quarter", T.ShortType(), True),
    ("month", T.ShortType(), True),
    ("month_name", T.StringType(), True),
    ("week_of_year", T.ShortType(), True),
    ("day_of_week", T.ShortType(), True),
    ("day_name", T.StringType(), True),
    ("is_weekend", T.BooleanType(), True),
    ("is_month_start", T.BooleanType(), True),
    ("is_month_end", T.BooleanType(), True),
    ("is_quarter_end", T.BooleanType(), True),
)

DIM_CUSTOMER = _s(
    ("customer_key", T.LongType(), False),
    ("customer_id", T.LongType(), False),
    ("first_name", T.StringType(), True),
    ("last_name", T.StringType(), True),
    ("email", T.StringType(), True),
    ("city", T.StringType(), True),
    ("state", T.StringType(), True),
    ("country", T.StringType(), True),
    ("age_group", T.StringType(), True),
    ("gender", T.StringType(), True),
    ("signup_date", T.DateType(), True),
    ("is_premium", T.BooleanType(), True),
)

DIM_PRODUCT = _s(
    ("product_key", T.LongType(), False),
    ("product_id", T.LongType(), False),
    ("product_name", T.StringType(), True),
    ("category", T.StringType(), True),
    ("subcategory", T.StringType(), True),
    ("brand", T.StringType(), True),
    ("unit_price", MONEY, True),
    ("unit_cost", MONEY, True),
    ("margin_pct", MARGIN, True),
    ("margin_tier", T.StringType(), True),
    ("is_active", T.BooleanType(), True),
)

FACT_SALES = _s(
    ("sale_id", T.LongType(), False),
    ("date_key", T.IntegerType(), True),
    ("customer_key", T.LongType(), True),
    ("product_key", T.LongType(), True),
    ("order_id", T.LongType(), True),
    ("order_date", T.DateType(), True),
    ("quantity", T.ShortType(), True),
    ("unit_price", MONEY, True),
    ("discount_pct", PCT, True),
    ("discount_amt", MONEY, True),
    ("net_price", MONEY, True),
    ("revenue", AMOUNT, True),
    ("cogs", AMOUNT, True),
    ("gross_profit", AMOUNT, True),
    ("order_status", T.StringType(), True),
    ("payment_method", T.StringType(), True),
    ("channel", T.StringType(), True),
)

FACT_RFM = _s(
    ("rfm_id", T.LongType(), False),
    ("customer_key", T.LongType(), True),
    ("snapshot_date", T.DateType(), False),
    ("recency_days", T.IntegerType(), True),
    ("frequency", T.IntegerType(), True),
    ("monetary", TOTAL, True),
    ("r_score", T.ShortType(), True),
    ("f_score", T.ShortType(), True),
    ("m_score", T.ShortType(), True),
    ("rfm_score", T.ShortType(), True),
    ("segment", T.StringType(), True),
)

# The order summary (operators/distinct.py).
SUMMED = T.DecimalType(28, 2)
ORDER_NUMBERS = _s(("order_id", T.LongType(), False), ("order_no", T.LongType(), False))
ORDER_CELLS = _s(
    ("order_month", T.DateType(), True),
    ("channel", T.StringType(), True),
    ("order_status", T.StringType(), True),
    ("payment_method", T.StringType(), True),
    ("block", T.LongType(), True),
    ("orders", T.BinaryType(), False),
    ("lines", T.LongType(), False),
    ("quantity", T.LongType(), True),
    ("revenue", SUMMED, True),
    ("revenue_n", T.LongType(), False),
    ("gross_profit", SUMMED, True),
    ("discount", SUMMED, True),
    ("discount_n", T.LongType(), False),
)
BUYER_CELLS = _s(("order_month", T.DateType(), True), ("order_status", T.StringType(), True), ("block", T.LongType(), True), ("buyers", T.BinaryType(), False))

RAW_CUSTOMERS = _s(
    ("customer_id", T.LongType(), False),
    ("first_name", T.StringType(), True),
    ("last_name", T.StringType(), True),
    ("email", T.StringType(), True),
    ("city", T.StringType(), True),
    ("state", T.StringType(), True),
    ("country", T.StringType(), True),
    ("age_group", T.StringType(), True),
    ("gender", T.StringType(), True),
    ("signup_date", T.DateType(), True),
    ("is_premium", T.BooleanType(), True),
)

RAW_PRODUCTS = _s(
    ("product_id", T.LongType(), False),
    ("product_name", T.StringType(), True),
    ("category", T.StringType(), True),
    ("subcategory", T.StringType(), True),
    ("brand", T.StringType(), True),
    ("unit_price", MONEY, True),
    ("unit_cost", MONEY, True),
    ("is_active", T.BooleanType(), True),
)

RAW_ORDERS = _s(
    ("order_id", T.LongType(), True),
    ("customer_id", T.LongType(), True),
    ("product_id", T.LongType(), True),
    ("order_date", T.DateType(), True),
    ("quantity", T.ShortType(), True),
    ("unit_price", MONEY, True),
    ("unit_cost", MONEY, True),
    ("discount_pct", PCT, True),
    ("order_status", T.StringType(), True),
    ("payment_method", T.StringType(), True),
    ("channel", T.StringType(), True),
)

# Fact columns without the load-assigned id, in DDL order.
FACT_COLUMNS = [f.name for f in FACT_SALES.fields if f.name != "sale_id"]
RFM_COLUMNS = [f.name for f in FACT_RFM.fields if f.name != "rfm_id"]

# Declared VARCHAR(n) lengths, checked by the quality operator (C10).
VARCHAR_LIMITS = {
    "dim_date": {"month_name": 10, "day_name": 10},
    "dim_customer": {"first_name": 50, "last_name": 50, "email": 100, "city": 80, "state": 5,
                     "country": 50, "age_group": 10, "gender": 10},
    "dim_product": {"product_name": 150, "category": 50, "subcategory": 50, "brand": 80,
                    "margin_tier": 10},
    "fact_sales": {"order_status": 20, "payment_method": 20, "channel": 20},
    "fact_rfm": {"segment": 20},
}

# Declared NUMERIC(p, s) columns.
NUMERIC_LIMITS = {
    table: {f.name: (f.dataType.precision, f.dataType.scale) for f in schema.fields if isinstance(f.dataType, T.DecimalType)}
    for table, schema in (("dim_date", DIM_DATE), ("dim_customer", DIM_CUSTOMER), ("dim_product", DIM_PRODUCT),
                          ("fact_sales", FACT_SALES), ("fact_rfm", FACT_RFM))
}


def conform(df: DataFrame, schema: T.StructType, drop_extra: bool = True) -> DataFrame:
    """Cast ``df`` to ``schema`` column by column (name-based), in schema order."""
    present = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in present]
    if missing:
        raise ValueError(f"missing columns {missing}")
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    if not drop_extra:
        cols += [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*cols)


def without(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in names])
