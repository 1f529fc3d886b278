"""Property-based checks of the load and ranking operators on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators import load as LD
from starloom.operators.ranking import global_rank

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.lists(st.tuples(st.integers(0, 30), st.sampled_from(["a", "b", "c"]), st.integers(0, 5)),
                max_size=25, unique_by=lambda r: r[0])


@SETTINGS
@given(target=rows, source=rows)
def test_upsert_model(spark, target, source):
    schema = "k long, name string, v long"
    t, s = spark.createDataFrame(target, schema), spark.createDataFrame(source, schema)
    got = {r.k: (r.name, r.v) for r in LD.upserted(t, s, "k", ["v"]).collect()}
    model = {k: (n, v) for k, n, v in target}
    for k, n, v in source:
        model[k] = (model[k][0], v) if k in model else (n, v)
    assert got == model


@SETTINGS
@given(target=rows, source=rows)
def test_insert_if_absent_model(spark, target, source):
    schema = "k long, name string, v long"
    t, s = spark.createDataFrame(target, schema), spark.createDataFrame(source, schema)
    got = sorted(tuple(r) for r in LD.inserted_if_absent(t, s, "k", "k").collect())
    keys = {r[0] for r in target}
    model = sorted(list(target) + [r for r in source if r[0] not in keys])
    assert got == model


@SETTINGS
@given(values=st.lists(st.integers(0, 4), min_size=1, max_size=200), descending=st.booleans())
def test_rank_equals_row_number(spark, values, descending):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k long, v long")
    ranked, n = global_rank(df, [("v", not descending), ("k", True)], out="r")
    order = sorted(range(len(values)), key=lambda k: (-values[k] if descending else values[k], k))
    assert n == len(values) and {r.k: r.r for r in ranked.collect()} == {k: i + 1 for i, k in enumerate(order)}


def test_revenue_is_conserved_across_groupings(spark):
    from starloom.plans import reports
    from starloom.sources import warehouse as WH
    wh = WH.for_testdata(spark, "/root/testdata/sf0.001")
    total = wh.fact.filter("order_status = 'completed'").agg(F.sum("revenue")).first()[0]
    for q in (reports.q01_monthly, reports.q04_channel_payment, reports.q07_state_revenue):
        col = "total_revenue"
        s = q(wh).agg(F.sum(col)).first()[0]
        assert s == total


money = st.one_of(st.none(), st.decimals(min_value=-50, max_value=500, places=2, allow_nan=False, allow_infinity=False))
fact_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 8)),      # order_id
                               st.one_of(st.none(), st.integers(1, 3)),      # customer_key
                               st.integers(0, 3),                            # quantity
                               money, money), max_size=30)


@SETTINGS
@given(rows=fact_rows)
def test_fact_report_model(spark, rows):
    import datetime as dt
    from decimal import ROUND_HALF_UP, Decimal

    from starloom.operators import quality as Q
    d = dt.date(2022, 1, 1)
    data = [(o, c, 1, q, p, r, d) for o, c, q, p, r in rows]
    schema = ("order_id long, customer_key long, product_key long, quantity smallint, net_price decimal(10,2), "
              "revenue decimal(12,2), order_date date")
    got = Q.fact_report(spark.createDataFrame(data, schema)).first()
    assert got.total_rows == len(rows)
    assert got.negative_revenue == sum(1 for r in rows if r[4] is not None and r[4] < 0)
    assert got.zero_quantity == sum(1 for r in rows if r[2] == 0)
    assert got.missing_keys == sum(1 for r in rows if r[1] is None)

    def mismatch(q, p, r):
        if r is None or p is None:
            return True
        return r != (q * p).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert got.revenue_mismatch == sum(1 for _, _, q, p, r in rows if mismatch(q, p, r))
    orders = {}
    for o, _, _, _, r in rows:
        if o is not None:
            orders.setdefault(o, []).append(r)
    assert got.total_orders == len(orders)
    sums = [sum(x for x in v if x is not None) for v in orders.values() if any(x is not None for x in v)]
    if sums:
        exp = (sum(sums) / len(sums)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert got.avg_order_value == exp
    else:
        assert got.avg_order_value is None
