"""SQL access: run SQL text over the warehouse tables.

``run_sql(wh, text)`` registers the five tables as temporary views (``dim_date``,
``dim_customer``, ``dim_product``, ``fact_sales``, ``fact_rfm``) and returns
``spark.sql(text)`` — a lazy DataFrame planned by Catalyst exactly like the
DataFrame plans in :mod:`starloom.plans.reports`.

``SAMPLES`` are queries of this library's own that use what analysts' texts need:
ordinals, aliases in GROUP BY, windows over grouped results, HAVING and subqueries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.warehouse import Warehouse


def run_sql(wh: Warehouse, text: str) -> DataFrame:
    wh.register_views()
    return wh.spark.sql(text)


SAMPLES: dict[str, str] = {
    # alias in GROUP BY, ordinals in ORDER BY
    "sql_weekend_units": """
        SELECT is_weekend AS weekend, payment_method AS method, CAST(SUM(quantity) AS BIGINT) AS units
        FROM fact_sales INNER JOIN dim_date USING (date_key)
        GROUP BY weekend, method
        ORDER BY 1, 3 DESC, 2""",
    # windows over a grouped result
    "sql_brand_places": """
        WITH brands AS (
            SELECT category, brand, CAST(SUM(quantity) AS BIGINT) AS units
            FROM dim_product INNER JOIN fact_sales USING (product_key)
            GROUP BY category, brand)
        SELECT category, brand, units,
               CAST(RANK() OVER (PARTITION BY category ORDER BY units DESC, brand ASC NULLS LAST) AS BIGINT) AS place,
               units - COALESCE(LAG(units) OVER (PARTITION BY category ORDER BY units ASC, brand DESC NULLS LAST), 0) AS ahead_of_next
        FROM brands""",
    # HAVING against a scalar subquery
    "sql_busy_days": """
        SELECT order_date, CAST(COUNT(*) AS BIGINT) AS lines
        FROM fact_sales
        GROUP BY order_date
        HAVING COUNT(*) * (SELECT COUNT(DISTINCT order_date) FROM fact_sales) > 2 * (SELECT COUNT(*) FROM fact_sales)
        ORDER BY lines DESC, order_date ASC NULLS LAST""",
    # a semi join and a set operation
    "sql_segments_without_premium": """
        SELECT segment FROM fact_rfm
        EXCEPT
        SELECT segment FROM fact_rfm WHERE EXISTS (
            SELECT 1 FROM dim_customer WHERE dim_customer.customer_key = fact_rfm.customer_key AND age_group = '55+' AND gender = 'Other')""",
}


def sample(name: str):
    def query(wh: Warehouse) -> DataFrame:
        return run_sql(wh, SAMPLES[name])
    query.__name__ = name
    return query
