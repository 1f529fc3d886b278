import uuid

import pytest
from pyspark.sql import functions as F

from starloom.plans import pipeline as P
from starloom.session import checkpoint_dir
from starloom.sources import files
from starloom.sources import warehouse as WH

SF = "/root/testdata/sf0.001"


def test_pipeline_runs_twice_append_duplicates_facts_dims_stay(spark, tmp_path):
    db = "wh_" + uuid.uuid4().hex[:8]
    first = P.run_testdata(spark, SF, database=db, root=str(tmp_path))
    wh = WH.build_from_testdata(spark, SF, materialize=False)
    expected = {n: wh[n].count() for n in P.TABLE_SCHEMAS}
    assert first["row_counts"] == expected
    q = first["quality"]
    assert q["negative_revenue"] == 0 and q["missing_keys"] == 0 and q["revenue_mismatch"] == 0
    assert q["dropped_rows"] > 0          # lines of customers removed by e-mail de-duplication

    # stored keys equal a full rebuild's keys on the first run
    stored = spark.table(f"{db}.dim_customer").select("customer_key", "customer_id")
    assert sorted(stored.collect()) == sorted(wh["dim_customer"].select("customer_key", "customer_id").collect())

    second = P.run_testdata(spark, SF, database=db, root=str(tmp_path))
    c = second["row_counts"]
    assert c["fact_sales"] == 2 * expected["fact_sales"]
    for n in ["dim_date", "dim_customer", "dim_product", "fact_rfm"]:
        assert c[n] == expected[n]
    ids = spark.table(f"{db}.fact_sales").select("sale_id")
    assert ids.distinct().count() == c["fact_sales"]
    # nothing staged is left, and one version of each merged table
    staged = f"{checkpoint_dir(spark)}/starloom-stage"
    before = files.folders(spark, staged)
    P.run_testdata(spark, SF, database=db, root=str(tmp_path))
    assert files.folders(spark, staged) == before
    for n in ["dim_date", "dim_customer", "dim_product", "fact_rfm"]:
        assert len(files.folders(spark, f"{tmp_path}/{db}.versions/{n}")) == 1
    # every fact key resolves in the stored dimensions
    from starloom.operators import quality as Q
    fk = Q.foreign_key_violations({n: spark.table(f"{db}.{n}") for n in P.TABLE_SCHEMAS}).collect()
    assert all(r.violations == 0 for r in fk)


def test_fact_from_order_parts_equals_flat_build(spark):
    from starloom.operators import facts as FACT
    from starloom.sources import testdata as TD
    wh = WH.for_testdata(spark, SF)
    dc, dp = wh["dim_customer"], wh["dim_product"]
    flat, obs_flat = FACT.build_fact_observed(TD.raw_orders(spark, SF), dc, dp)
    parts, obs_parts = FACT.build_fact_from_parts(TD.order_headers(spark, SF), TD.order_lines(spark, SF), dc, dp)
    assert flat.exceptAll(parts).count() == 0 and parts.exceptAll(flat).count() == 0
    assert {k: obs_parts.get[k] for k in obs_flat.get} == obs_flat.get


def test_cached_warehouse_is_served_through_the_callers_session(spark):
    import __spark_entry__ as E
    q = E.queries()
    a = q["q10_row_counts"](spark, SF).collect()
    other = spark.newSession()
    df = q["q10_row_counts"](other, SF)
    assert df.sparkSession is other
    assert sorted(df.collect()) == sorted(a)


def test_every_lost_line_is_counted(spark):
    from pyspark.sql import functions as F

    from starloom.operators import facts as FACT
    headers = spark.createDataFrame([(1, 10, "completed"), (2, 99, "completed")], "order_id long, customer_id long, order_status string")
    headers = headers.select("*", F.lit("2020-01-01").cast("date").alias("order_date"), F.lit("web").alias("channel"), F.lit("x").alias("payment_method"))
    lines = spark.createDataFrame([(1, 5), (7, 5), (1, 6), (2, 5), (7, 6)], "order_id long, product_id long")
    lines = lines.select("*", F.lit(1).cast("smallint").alias("quantity"), F.lit(0).cast("decimal(5,2)").alias("discount_pct"))
    customers = spark.createDataFrame([(1, 10)], "customer_key long, customer_id long")
    products = spark.sql("select 1L product_key, 5L product_id, cast(2 as decimal(10,2)) unit_price, cast(1 as decimal(10,2)) unit_cost")
    fact, obs = FACT.build_fact_from_parts(headers, lines, customers, products)
    assert fact.count() == 1
    assert obs.get == {"input_rows": 5, "dropped_rows": 4, "without_order": 2, "without_product": 1, "without_customer": 1}


def test_a_product_on_most_lines_is_split(spark):
    """AQE splits the hot product's join by itself: the join's output is shuffled anew by order anyway."""
    from pyspark.sql import functions as F

    from starloom.operators import facts as FACT
    n = 400_000
    lines = spark.range(n).select((F.col("id") % 50_000).alias("order_id"), F.when(F.col("id") % 5 < 4, F.lit(7)).otherwise(F.col("id") % 1000).cast("long").alias("product_id"),
                                  F.lit(1).cast("smallint").alias("quantity"), F.lit(0).cast("decimal(5,2)").alias("discount_pct"))
    headers = spark.range(50_000).select(F.col("id").alias("order_id"), (F.col("id") % 100).alias("customer_id"), F.lit("completed").alias("order_status"),
                                         F.lit("2020-01-01").cast("date").alias("order_date"), F.lit("web").alias("channel"), F.lit("x").alias("payment_method"))
    customers = spark.range(100).select((F.col("id") + 1).alias("customer_key"), F.col("id").alias("customer_id"))
    products = spark.range(1000).select((F.col("id") + 1).alias("product_key"), F.col("id").alias("product_id"),
                                        F.lit("2.00").cast("decimal(10,2)").alias("unit_price"), F.lit("1.00").cast("decimal(10,2)").alias("unit_cost"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact, obs = FACT.build_fact_from_parts(headers, lines, customers, products)
        fact.write.format("noop").mode("overwrite").save()
        assert obs.get["input_rows"] == n and obs.get["dropped_rows"] == 0
        joined = FACT._keyed_parts(headers, lines, customers, products).select("order_id", "product_key")
        joined._jdf.queryExecution().executedPlan().execute().count()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("column, share", [("product_id", 0.8), ("customer_id", 0.5)])
def test_flat_lines_of_a_heavy_key_stay_spread(spark, column, share):
    """One product (or customer, or none) on most flat lines: no task has twice what an even split gives, without skew handling."""
    from collections import Counter

    from starloom.operators import facts as FACT
    n, parts = 200_000, 8
    other = {"product_id": "customer_id", "customer_id": "product_id"}[column]
    heavy = F.when(F.rand(1) < share, F.lit(7)).when(F.rand(2) < 0.3, F.lit(None)).otherwise(F.col("id") % 1000).cast("long")
    lines = spark.range(0, n, 1, parts).select(F.col("id").alias("order_id"), heavy.alias(column), (F.col("id") % 900).alias(other), F.lit(1).cast("smallint").alias("quantity"),
                                               F.lit(0).cast("decimal(5,2)").alias("discount_pct"), F.lit("2.00").cast("decimal(10,2)").alias("unit_price"),
                                               F.lit("1.00").cast("decimal(10,2)").alias("unit_cost"), F.lit("2020-01-01").cast("date").alias("order_date"),
                                               F.lit("completed").alias("order_status"), F.lit("x").alias("payment_method"), F.lit("web").alias("channel"))
    customers = spark.range(1000).select((F.col("id") + 1).alias("customer_key"), F.col("id").alias("customer_id"))
    products = spark.range(1000).select((F.col("id") + 1).alias("product_key"), F.col("id").alias("product_id"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        keyed = FACT._keyed_lines(lines, customers, products).select("order_id", "product_key", "customer_key", F.spark_partition_id().alias("p"))
        rows = keyed.collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    sizes = Counter(r.p for r in rows)
    assert sum(sizes.values()) == n and max(sizes.values()) <= 2 * n / parts
    expected = {r.order_id: r for r in lines.select("order_id", "product_id", "customer_id").collect()}
    for r in rows[::97]:
        want = expected[r.order_id]
        assert (r.product_key, r.customer_key) == tuple(None if x is None else x + 1 for x in (want.product_id, want.customer_id))


def test_heavy_keys(spark):
    from starloom.operators.joins import heavy_keys
    df = spark.range(100_000).select(F.when(F.col("id") % 10 < 3, F.lit(1)).when(F.col("id") % 100 == 55, F.lit(2)).otherwise(F.col("id")).alias("k"))
    assert sorted(heavy_keys(df, "k")) == [1, 2] and heavy_keys(df.where("k > 2"), "k") == [] and heavy_keys(df.limit(0), "k") == []


def test_quarantine_releases_each_line_once(spark):
    from starloom.operators import facts as FACT
    day, money = F.lit("2020-01-01").cast("date"), lambda x: F.lit(x).cast("decimal(10,2)")
    headers = spark.createDataFrame([(1, 10), (2, 99), (3, 10)], "order_id long, customer_id long").select(
        "*", day.alias("order_date"), F.lit("completed").alias("order_status"), F.lit("x").alias("payment_method"), F.lit("web").alias("channel"))
    lines = spark.createDataFrame([(1, 5), (1, 6), (2, 5), (2, 6), (3, 5), (3, 5), (4, 5), (None, 5)], "order_id long, product_id long").select(
        "*", F.lit(1).cast("smallint").alias("quantity"), F.lit(0).cast("decimal(5,2)").alias("discount_pct"))
    customers = spark.createDataFrame([(1, 10), (2, 99)], "customer_key long, customer_id long")
    products = spark.createDataFrame([(1, 5), (2, 6)], "product_key long, product_id long").select("*", money("2.00").alias("unit_price"), money("1.00").alias("unit_cost"))
    first = headers.where("order_id < 3"), lines, customers.where("customer_id = 10"), products.where("product_id = 5")
    fact, lost = FACT.build_fact_from_parts(*first)[0], FACT.lost_lines(*first)
    assert sorted((r.order_id or 0, r.product_id, r.reason) for r in lost.collect()) == [
        (0, 5, "order"), (1, 6, "product"), (2, 5, "customer"), (2, 6, "product"), (3, 5, "order"), (3, 5, "order"), (4, 5, "order")]
    more, still = FACT.released(lost, headers, customers, products)
    whole = FACT.build_fact_from_parts(headers, lines, customers, products)[0]
    assert sorted(fact.unionByName(more).collect()) == sorted(whole.collect())
    assert sorted((r.order_id or 0, r.reason) for r in still.collect()) == [(0, "order"), (4, "order")]
    again, left = FACT.released(still, headers, customers, products)
    assert again.count() == 0 and left.count() == 2


def test_amounts_are_computed_after_the_joins(spark):
    """No shuffle of the fact build carries an amount; those of lines without a product or order are as they were."""
    from starloom.operators import facts as FACT
    from starloom.sources import schemas as S
    headers = spark.createDataFrame([(1, 10, "completed"), (None, 10, "completed")], "order_id long, customer_id long, order_status string")
    headers = headers.select("*", F.lit("2020-01-01").cast("date").alias("order_date"), F.lit("web").alias("channel"), F.lit("x").alias("payment_method"))
    lines = spark.createDataFrame([(1, 5), (1, 5), (7, 5), (1, 6), (None, 5), (1, None)], "order_id long, product_id long")
    lines = lines.select("*", F.lit(2).cast("smallint").alias("quantity"), F.lit(10).cast(S.PCT).alias("discount_pct"))
    customers = spark.createDataFrame([(3, 10)], "customer_key long, customer_id long")
    products = spark.createDataFrame([(4, 5)], "product_key long, product_id long").select(
        "*", F.lit(20).cast(S.MONEY).alias("unit_price"), F.lit(5).cast(S.MONEY).alias("unit_cost"))
    fact, _ = FACT.build_fact_from_parts(headers, lines, customers, products)
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert "AS gross_profit" in plan and not any("gross_profit" in part for part in plan.split("Join ")[1:])
    assert [(r.order_id, r.customer_key, r.product_key, float(r.revenue), float(r.gross_profit)) for r in fact.collect()] == [(1, 3, 4, 36.0, 26.0)] * 2
