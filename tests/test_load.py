import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import load as LD
from starloom.sources import schemas as S

CUST = ("customer_key long, customer_id long, first_name string, last_name string, email string, city string, "
        "state string, country string, age_group string, gender string, signup_date date, is_premium boolean")
UPD = ["first_name", "last_name", "email", "city", "state", "is_premium"]


def _cust(spark, rows):
    return spark.createDataFrame(rows, CUST)


def test_upsert_updates_only_listed_columns_and_inserts_new_rows(spark):
    d = dt.date(2022, 1, 1)
    tgt = _cust(spark, [(1, 10, "A", "B", "a@b", "X", "CA", "US", "18-24", "M", d, False)])
    src = _cust(spark, [(7, 10, "A2", "B2", "a2@b", "Y", "TX", "CA", "55+", "F", dt.date(2023, 1, 1), True),
                        (9, 11, "N", "M", "n@m", "Z", "NY", "US", "25-34", "Other", d, False)])
    out = {r.customer_id: r for r in LD.upserted(tgt, src, "customer_id", UPD,
                                                 new_key=("customer_key", "customer_id")).collect()}
    a = out[10]
    assert (a.customer_key, a.first_name, a.last_name, a.email, a.city, a.state, a.is_premium) == \
        (1, "A2", "B2", "a2@b", "Y", "TX", True)
    assert (a.country, a.age_group, a.gender, a.signup_date) == ("US", "18-24", "M", d)
    b = out[11]
    assert (b.customer_key, b.first_name, b.age_group) == (2, "N", "25-34")


def test_upsert_keeps_target_rows_missing_from_source(spark):
    d = dt.date(2022, 1, 1)
    tgt = _cust(spark, [(1, 10, "A", "B", "a@b", "X", "CA", "US", "18-24", "M", d, False),
                        (2, 12, "K", "L", "k@l", "X", "CA", "US", "18-24", "M", d, True)])
    src = _cust(spark, [(5, 10, "A2", "B", "a@b", "X", "CA", "US", "18-24", "M", d, False)])
    out = {r.customer_id: r.first_name for r in LD.upserted(tgt, src, "customer_id", UPD).collect()}
    assert out == {10: "A2", 12: "K"}


def test_upsert_rejects_duplicate_source_key(spark):
    d = dt.date(2022, 1, 1)
    tgt = _cust(spark, [(1, 10, "A", "B", "a@b", "X", "CA", "US", "18-24", "M", d, False)])
    src = _cust(spark, [(1, 10, "A", "B", "a@b", "X", "CA", "US", "18-24", "M", d, False),
                        (2, 10, "C", "B", "a@b", "X", "CA", "US", "18-24", "M", d, False)])
    with pytest.raises(LD.DuplicateSourceKey):
        LD.upserted(tgt, src, "customer_id", UPD)


def test_upsert_is_idempotent(spark):
    d = dt.date(2022, 1, 1)
    tgt = _cust(spark, [(1, 10, "A", "B", "a@b", "X", "CA", "US", "18-24", "M", d, False)])
    src = _cust(spark, [(3, 10, "A2", "B", "a@b", "X", "CA", "US", "55+", "M", d, True),
                        (4, 20, "N", "B", "n@b", "X", "CA", "US", "55+", "M", d, True)])
    once = LD.upserted(tgt, src, "customer_id", UPD, new_key=("customer_key", "customer_id"))
    twice = LD.upserted(once, src, "customer_id", UPD, new_key=("customer_key", "customer_id"))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_insert_if_absent_leaves_existing_rows_unchanged(spark):
    tgt = spark.createDataFrame([(20220101, "old")], "date_key int, v string")
    src = spark.createDataFrame([(20220101, "new"), (20220102, "x"), (20220102, "y")], "date_key int, v string")
    out = sorted(tuple(r) for r in LD.inserted_if_absent(tgt, src, "date_key", "v").collect())
    assert out == [(20220101, "old"), (20220102, "x")]


def test_append_is_not_idempotent_and_ids_are_unique(spark, tmp_path):
    path = str(tmp_path / "fact")
    schema = S.without(S.FACT_SALES, "sale_id")
    LD.create_if_absent(spark, path, S.FACT_SALES)
    batch = spark.range(50).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    assert LD.append_to(path, batch, id_col="sale_id") == 50
    LD.append_to(path, batch, id_col="sale_id")
    t = spark.read.parquet(path)
    assert t.count() == 100
    assert t.select("sale_id").distinct().count() == 100


def test_replace_writes_a_new_version(spark, tmp_path):
    df = spark.range(3)
    p1 = LD.replace_with(str(tmp_path / "t"), df)
    p2 = LD.replace_with(str(tmp_path / "t"), df.union(df))
    assert p1 != p2
    assert spark.read.parquet(p1).count() == 3 and spark.read.parquet(p2).count() == 6


def test_null_keys_raise(spark):
    tgt = spark.createDataFrame([(1, "a")], "k long, v string")
    src = spark.createDataFrame([(None, "b"), (2, "c")], "k long, v string")
    with pytest.raises(LD.NullSourceKey):
        LD.upserted(tgt, src, "k", ["v"])
    with pytest.raises(LD.NullSourceKey):
        LD.inserted_if_absent(tgt, src, "k", "v")


def test_an_unreadable_table_is_not_an_empty_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    batch = spark.range(5).selectExpr("id AS x")
    LD.append_to(path, batch, id_col="sale_id")

    def broken(target, id_col):
        raise OSError("no answer")

    with monkeypatch.context() as m:
        m.setattr(LD, "next_id", broken)
        with pytest.raises(OSError):
            LD.append_to(path, batch, id_col="sale_id")
    LD.append_to(path, batch, id_col="sale_id")
    ids = [r.sale_id for r in spark.read.parquet(path).collect()]
    assert len(ids) == len(set(ids)) == 10


def test_replaced_dates_can_be_loaded_again(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "d int, v string")
    batch = spark.createDataFrame([(2, "c"), (2, "d"), (3, "e")], "d int, v string")
    once = LD.replaced_dates(tgt, batch, "d")
    rows = sorted(once.collect(), key=str)
    assert rows == sorted(LD.replaced_dates(once, batch, "d").collect(), key=str)
    assert sorted(r.v for r in rows) == ["a", "c", "d", "e", "n"]
