import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import ranking as R
from starloom.operators.ranking import _placed, after, cut_keys, dense_key, global_rank, keep_first


def _frame(spark, n, seed=3, distinct=7):
    rnd = random.Random(seed)
    rows = [(i, rnd.randrange(distinct), rnd.randrange(1000) / 10) for i in range(n)]
    return spark.createDataFrame(rows, "k long, f int, m double")


@pytest.mark.parametrize("order", [[("f", False), ("m", True), ("k", True)], [("m", True), ("k", True)], [("f", True), ("m", False), ("k", True)]])
def test_rank_equals_single_partition_row_number(spark, order):
    df = _frame(spark, 3000)
    ranked, n = global_rank(df, order, out="r")
    assert n == 3000
    w = Window.orderBy(*[F.col(c).asc() if a else F.col(c).desc() for c, a in order])
    expected = df.withColumn("e", F.row_number().over(w))
    assert ranked.join(expected, "k").filter(F.col("r") != F.col("e")).count() == 0
    assert sorted(r[0] for r in ranked.select("r").collect()) == list(range(1, 3001))


def test_one_value_in_most_rows_is_spread(spark):
    # a third of all rows share one value; the unique tie key still splits them
    df = spark.range(30_000).selectExpr("id AS k", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions are merged otherwise
    try:
        staged, firsts, n = _placed(df, [("v", True), ("k", True)], "test")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r[1] for r in staged.groupBy("_part").count().collect()]
    assert n == 30_000 and max(sizes) < 15_000 and len(firsts) == len(sizes)


def test_cut_keys(spark):
    rows = [(i, dt.date(2020, 1, 1) + dt.timedelta(days=(i * 13) % 40), Decimal(f"{(i * 7) % 23}.{i % 100:02d}"), f"s{i % 9}") for i in range(700)]
    df = spark.createDataFrame(rows, "k long, d date, m decimal(12,2), s string").repartition(5)
    for order in ([("d", True), ("k", True)], [("m", False), ("d", True), ("k", True)], [("s", False), ("k", True)]):
        names = [c for c, _ in order]
        ordered = [tuple(r) for r in df.orderBy(*[F.col(c).asc() if a else F.col(c).desc() for c, a in order]).select(*names).collect()]
        positions = [1, 175, 350, 700, 701]
        cuts = cut_keys(df, order, positions)
        assert cuts == [ordered[p - 1] for p in positions if p <= 700]
        assert df.where(after(order, cuts[1])).count() == 700 - 175


def test_no_build_plan_gathers_rows_in_one_partition(spark):
    """Also not for a handful of rows."""
    for n in (4, 1000):
        df = spark.range(n).selectExpr("id AS k", "id % 7 AS v", "string(id) AS s")
        ranked, _ = global_rank(df, [("v", True), ("k", True)], out="r")
        for frame in (ranked, dense_key(df, "k", "key"), keep_first(df, "s", "k")):
            assert "SinglePartition" not in frame._jdf.queryExecution().executedPlan().toString()


def test_dimension_and_rfm_plans_have_no_single_partition(spark):
    from starloom.operators.dimensions import build_dim_customer, build_dim_product
    from starloom.operators.rfm import build_rfm
    from starloom.sources import testdata as TD
    from starloom.sources import warehouse as WH
    sf = "/root/testdata/sf0.001"
    frames = [build_dim_customer(TD.raw_customers(spark, sf)), build_dim_product(TD.raw_products(spark, sf)),
              build_rfm(WH.for_testdata(spark, sf).fact.drop("sale_id"), "2001-08-01")]
    for frame in frames:
        assert "SinglePartition" not in frame._jdf.queryExecution().executedPlan().toString()


def test_rank_ties_descending_go_to_lower_key_first(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 3), (4, 9)], "k long, v int")
    ranked, _ = global_rank(df, [("v", False), ("k", True)], out="r")
    assert [r.r for r in ranked.orderBy("k").collect()] == [2, 3, 4, 1]


def test_dense_key(spark):
    df = spark.createDataFrame([(30, "c"), (10, "a"), (20, "b")], "id long, x string")
    out = dense_key(df, "id", "key")
    assert [(r.key, r.id) for r in out.orderBy("key").collect()] == [(1, 10), (2, 20), (3, 30)]
    assert out.columns == ["key", "id", "x"]


def test_keep_first_per_key_by_order_column(spark):
    df = spark.createDataFrame([(1, "a@b", "x"), (2, "a@b", "y"), (3, "c@d", "z"), (4, None, "n1"),
                                (5, None, "n2")], "id long, email string, v string")
    got = sorted((r.id, r.v) for r in keep_first(df, "email", "id").collect())
    assert got == [(1, "x"), (3, "z"), (4, "n1")]


def test_customer_dimension_dedup_and_keys(spark):
    from starloom.operators.dimensions import build_dim_customer
    from starloom.sources import schemas as S
    rows = [(1, "\t A@b \n"), (2, "a@B"), (3, "c@d")]
    raw = spark.createDataFrame(rows, "customer_id long, email string")
    for f in S.RAW_CUSTOMERS.fields:
        if f.name not in raw.columns:
            raw = raw.withColumn(f.name, F.lit(None).cast(f.dataType))
    dim = build_dim_customer(raw)
    assert [(r.customer_key, r.customer_id, r.email) for r in dim.orderBy("customer_key").collect()] == \
        [(1, 1, "a@b"), (2, 3, "c@d")]


def test_rfm_scores_equal_ranks_cut_at_quartiles(spark):
    from starloom.operators.rfm import ORDERS, build_rfm
    from starloom.sources import warehouse as WH
    fact = WH.for_testdata(spark, "/root/testdata/sf0.01").fact.drop("sale_id")
    rfm = build_rfm(fact, "2001-08-01").cache()
    n = rfm.count()
    assert n > 1000
    for name, order in ORDERS.items():
        w = Window.orderBy(*[F.col(c).asc() if a else F.col(c).desc() for c, a in order])
        rank = F.row_number().over(w) - 1
        wrong = rfm.withColumn("e", F.greatest(F.lit(1), F.ceil(4 * rank / (n - 1)))).where(F.col("e") != F.col(name))
        assert wrong.count() == 0
    rfm.unpersist()


CUTS = "a int, d decimal(22,2), t date, k long"


@pytest.mark.parametrize("seed", range(3))
def test_counted_cut_keys_equal_the_sorted_ones(spark, monkeypatch, seed):
    """Ties, negative values, both directions, and ranges far wider than the bins of a round."""
    import datetime as dt
    import random
    from decimal import Decimal

    monkeypatch.setattr(R, "BINS", 5)
    rng = random.Random(seed)
    rows = [(rng.randrange(-3, 4), Decimal(rng.choice([rng.randrange(-10 ** 6, 10 ** 6), 7, 10 ** 19])) / 100, dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(40)), k * 7919 - 10 ** 6) for k in range(157)]
    df = spark.createDataFrame(rows, CUTS).repartition(3).cache()
    orders = [[("a", False), ("k", True)], [("d", True), ("k", True)], [("t", False), ("a", True), ("k", False)], [("k", True)]]
    positions = [1, 2, 40, 79, 118, 156, 157, 158, 0]
    at = {name: i for i, name in enumerate("adtk")}
    for order, keys in zip(orders, R.counted_cut_keys(df, orders, positions)):
        want = [tuple(r[at[c]] for c, _ in order) for r in rows]
        for c, asc in reversed(list(enumerate(asc for _, asc in order))):
            want.sort(key=lambda key: key[c], reverse=not asc)
        assert keys == [want[p - 1] for p in positions if 1 <= p <= len(rows)]


def test_counted_cut_keys_read_no_order(spark):
    """No sort and no range shuffle; an empty table has no keys, and other types raise."""
    df = spark.createDataFrame([(1, 2)], "a long, k long")
    assert R.counted_cut_keys(df.limit(0), [[("a", True)]], [1]) == [[]]
    assert R.counted_cut_keys(df, [[("a", True), ("k", False)]], [1, 2]) == [[(1, 2)]]
    with pytest.raises(TypeError):
        R.counted_cut_keys(spark.createDataFrame([("x",)], "s string"), [[("s", True)]], [1])
