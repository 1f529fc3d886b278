import datetime as dt
from decimal import Decimal as D

from starloom.operators import quality as Q

FACT = ("order_id long, customer_key long, product_key long, quantity smallint, net_price decimal(10,2), "
        "revenue decimal(12,2), order_date date")


def test_fact_report_counts(spark):
    d = dt.date(2022, 1, 1)
    rows = [
        (1, 1, 1, 1, D("-5.00"), D("-5.00"), d),   # negative revenue, consistent
        (2, 1, 1, 0, D("5.00"), D("0.00"), d),     # zero quantity, consistent
        (3, None, 1, 1, D("5.00"), D("5.00"), d),  # missing key
        (4, 1, 1, 2, D("5.00"), D("11.00"), d),    # wrong revenue
        (5, 1, 1, 2, D("5.00"), None, d),          # null revenue
        (5, 1, 1, 1, D("3.00"), D("3.00"), dt.date(2023, 5, 1)),
    ]
    fact = spark.createDataFrame(rows, FACT)
    r = Q.fact_report(fact).first()
    assert (r.negative_revenue, r.zero_quantity, r.missing_keys, r.revenue_mismatch) == (1, 1, 1, 2)
    assert (r.total_rows, r.total_orders) == (6, 5)
    assert r.total_revenue == D("14.00")
    # order sums: -5, 0, 5, 11, 3 → mean 2.8
    assert r.avg_order_value == D("2.80")
    assert (r.first_order_date, r.last_order_date) == (d, dt.date(2023, 5, 1))
    assert fact.columns == FACT.replace(",", "").split()[0::2]  # the check did not add columns


def test_constraint_checks(spark):
    tables = {
        "dim_date": spark.createDataFrame([(20220101, d) for d in [dt.date(2022, 1, 1)]], "date_key int, full_date date"),
        "dim_customer": spark.createDataFrame([(1, 10), (2, 10), (None, 11)], "customer_key long, customer_id long"),
        "dim_product": spark.createDataFrame([(1, 5)], "product_key long, product_id long"),
        "fact_rfm": spark.createDataFrame([(1, 7, dt.date(2022, 1, 1))], "customer_key long, rfm_id long, snapshot_date date"),
        "fact_sales": spark.createDataFrame([(1, 20220101, 1, 1), (1, 20220102, 3, None), (None, 20220102, 3, 1)],
                                            "sale_id long, date_key int, customer_key long, product_key long"),
    }
    u = {(r.table_name, r.column_name): r.violations for r in Q.unique_violations(tables).collect()}
    assert u[("dim_customer", "customer_id")] == 1 and u[("dim_customer", "customer_key")] == 0
    assert u[("fact_sales", "sale_id")] == 1 and u[("fact_rfm", "rfm_id")] == 0
    n = {(r.table_name, r.column_name): r.violations for r in Q.not_null_violations(tables).collect()}
    assert n[("dim_customer", "customer_key")] == 1 and n[("fact_sales", "sale_id")] == 1
    fk = {(r.table_name, r.column_name): r.violations for r in Q.foreign_key_violations(tables).collect()}
    assert fk[("fact_sales", "date_key")] == 2 and fk[("fact_sales", "customer_key")] == 2
    assert fk[("fact_sales", "product_key")] == 0


def test_numbers_that_do_not_fit_are_found_before_the_cast(spark):
    rows = [(D("99999999.99"), "12.5"), (D("100000000.00"), "much"), (None, None), (D("-100000000.00"), "99999.9")]
    t = {"dim_product": spark.createDataFrame(rows, "unit_price decimal(20,2), margin_pct string")}
    got = {r.column_name: r.violations for r in Q.fit_violations(t, limits={"dim_product": {}}).collect()}
    assert got == {"unit_price": 2, "margin_pct": 1}


def test_totals_keep_their_cents_at_any_size(spark):
    from starloom.functions import money as M
    big = D("99999999999999999.37")
    t = spark.createDataFrame([(1, big), (2, D("0.01"))], "k int, v decimal(24,2)")
    r = t.agg(M.money_sum("v").alias("s"), M.exact_avg("v", 2).alias("a")).first()
    assert r.s == D("99999999999999999.38") and r.a == D("49999999999999999.69")


def test_rfm_and_treemap_hold_large_totals(spark):
    from pyspark.sql import functions as F

    from starloom.operators.rfm import rfm_base
    from starloom.plans.dashboard import treemap_rollup
    from starloom.sources.warehouse import Warehouse
    fact = spark.range(20).select(F.lit("completed").alias("order_status"), F.lit(1).cast("long").alias("customer_key"), "id",
                                  F.lit(dt.date(2022, 1, 1)).alias("order_date"), F.lit("9999999999.00").cast("decimal(12,2)").alias("revenue"),
                                  F.lit("9999999999.00").cast("decimal(12,2)").alias("gross_profit"), F.lit(1).cast("long").alias("product_key"),
                                  F.lit(0).cast("decimal(5,2)").alias("discount_pct")).withColumnRenamed("id", "order_id")
    assert rfm_base(fact, "2022-02-01").first().monetary == D("199999999980.00")
    product = spark.createDataFrame([(1, "c", "s")], "product_key long, category string, subcategory string")
    many = fact.withColumn("revenue", F.lit("99999999999999.25").cast("decimal(16,2)")).withColumn("gross_profit", F.col("revenue"))
    root = treemap_rollup(Warehouse(spark, {"fact_sales": many, "dim_product": product}, dt.date(2022, 1, 1), dt.date(2022, 1, 1))).where("level = 0").first()
    assert root.revenue == D("1999999999999985.00") and root.color == D("1999999999999985.00")
