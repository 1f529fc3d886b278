"""Dimension builders: date, customer, product."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import money as M
from ..functions import text as X
from ..sources import schemas as S
from .ranking import dense_key, keep_first


def _as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def calendar_days(start, end) -> int:
    """Number of days in ``[start, end]`` — the exact row count of ``dim_date``."""
    return max(0, (_as_date(end) - _as_date(start)).days + 1)


def build_dim_date(spark: SparkSession, start, end) -> DataFrame:
    """One row per day in ``[start, end]`` (inclusive), generated distributed by ``range``."""
    start_d = _as_date(start)
    days = calendar_days(start, end)
    d = F.col("full_date")
    df = (spark.range(0, days)
          .select(F.date_add(F.lit(start_d), F.col("id").cast("int")).alias("full_date"))
          .select(
              D.date_key(d).alias("date_key"),
              d,
              F.year(d).alias("year"),
              F.quarter(d).alias("quarter"),
              F.month(d).alias("month"),
              D.month_name(d).alias("month_name"),
              D.iso_week(d).alias("week_of_year"),
              D.day_of_week(d).alias("day_of_week"),
              D.day_name(d).alias("day_name"),
              D.is_weekend(d).alias("is_weekend"),
              D.is_month_start(d).alias("is_month_start"),
              D.is_month_end(d).alias("is_month_end"),
              D.is_quarter_end(d).alias("is_quarter_end")))
    return S.conform(df, S.DIM_DATE)


def build_dim_customer(customers: DataFrame) -> DataFrame:
    """Normalise e-mail, keep the first customer (lowest ``customer_id``) per
    e-mail, then number the survivors 1..N by ``customer_id``."""
    cleaned = customers.withColumn("email", X.normalize_email(F.col("email")))
    keyed = dense_key(keep_first(cleaned, "email", "customer_id"), "customer_id", "customer_key")
    return S.conform(keyed, S.DIM_CUSTOMER)


def build_dim_product(products: DataFrame) -> DataFrame:
    """Add margin % and tier, number products 1..N by ``product_id``."""
    m = M.margin_pct(F.col("unit_price"), F.col("unit_cost"))
    df = (products
          .withColumn("margin_pct", m)
          .withColumn("margin_tier", M.margin_tier(F.col("margin_pct"))))
    keyed = dense_key(df, "product_id", "product_key")
    return S.conform(keyed, S.DIM_PRODUCT)
