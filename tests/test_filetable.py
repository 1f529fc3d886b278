"""File tables: what a load rewrites, what it leaves, and what becomes of loads that fail."""

import pytest
from pyspark.sql import functions as F

from starloom.operators import load as LD
from starloom.operators.distinct import counted
from starloom.operators.filetable import ConcurrentLoad, FileTable
from starloom.plans import pipeline as P
from starloom.sources import files
from starloom.sources import schemas as S

SF = "/root/testdata/sf0.001"
ROW = "id long, d date, v string"


def rows(spark, first, last, day="2024-01-01", v="a"):
    """Ids first … last - 1, a day later every hundred."""
    return spark.range(first, last).select("id", F.date_add(F.lit(day).cast("date"), (F.col("id") / 100).cast("int")).alias("d"), F.lit(v).alias("v"))


def table(spark, tmp_path, **options):
    schema = spark.createDataFrame([], ROW).schema
    return FileTable(spark, str(tmp_path / "t"), schema, **options)


def content(t):
    return sorted(tuple(r) for r in t.read().collect())


def test_upsert_of_one_percent_leaves_the_other_files(spark, tmp_path):
    t = table(spark, tmp_path, order=["id"], rows_per_file=100)
    t.append(rows(spark, 0, 10_000))
    before = t.version().files
    assert len(before) >= 100
    t.upsert(rows(spark, 4_000, 4_100, v="b"), "id", ["v"])
    after = t.version().files
    kept = set(before) & set(after)
    assert len(kept) > 0.9 * len(before) and t.loaded["kept"] == len(kept)
    got = content(t)
    assert [r[0] for r in got] == list(range(10_000))
    assert {r[0] for r in got if r[2] == "b"} == set(range(4_000, 4_100))
    # new keys only: no file is rewritten
    t.upsert(rows(spark, 10_000, 10_050), "id", ["v"])
    assert set(after) <= set(t.version().files) and len(content(t)) == 10_050


def test_upsert_equals_the_whole_table_merge(spark, tmp_path):
    t = table(spark, tmp_path, order=["id"], rows_per_file=7)
    old = rows(spark, 0, 60).where("id % 3 > 0")
    t.append(old)
    source = rows(spark, 40, 90, v="new").where("id % 2 = 0")
    t.upsert(source, "id", ["v"])
    assert content(t) == sorted(tuple(r) for r in LD.upserted(old, source, "id", ["v"]).collect())
    for bad, error in ((source.unionByName(source), LD.DuplicateSourceKey), (source.withColumn("id", F.lit(None).cast("long")), LD.NullSourceKey)):
        with pytest.raises(error):
            t.upsert(bad, "id", ["v"])


def test_replace_rewrites_only_the_months_of_the_batch(spark, tmp_path):
    t = table(spark, tmp_path, partition=("m", "date_format(d, 'yyyy-MM')"), order=["d"])
    t.append(rows(spark, 0, 20_000))  # 200 days
    before = t.version().files
    batch = rows(spark, 4_000, 5_000, v="again").unionByName(rows(spark, 90_000, 90_100, v="new"))
    t.replace(batch, "d")
    once = content(t)
    kept = set(before) & set(t.version().files)
    assert kept == {f for f in before if "m=2024-02" not in f} and len(kept) < len(before)  # days 40 to 49 are in February
    assert sum(r[2] == "again" for r in once) == 1_000 and len(once) == 20_100
    t.replace(batch, "d")
    assert content(t) == once
    plan = t.where_partition("2024-02", "2024-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan
    # rows without a date stay, and take part in no replacement
    t.append(spark.createDataFrame([(-1, None, "n")], ROW))
    t.replace(batch, "d")
    assert content(t) == sorted([*once, (-1, None, "n")], key=str) or len(content(t)) == len(once) + 1


def test_ids_follow_the_mark_and_survive_a_load_that_died(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path, order=["d"])
    batch = rows(spark, 0, 50).drop("id")
    t.append(batch, "id")
    mark = t.version().next_id
    assert t.read().agg(F.max("id")).first()[0] == mark - 1

    def died(*a):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(files, "write_new", died)
        with pytest.raises(OSError):
            t.append(batch, "id")
    assert t.version().next_id == mark and t.read().count() == 50
    reads = []
    scan = FileTable._scan
    with monkeypatch.context() as m:
        m.setattr(FileTable, "_scan", lambda self, names: reads.append(names) or scan(self, names))
        t.append(batch, "id")
    assert not reads  # no stored row is read for an append
    ids = [r.id for r in t.read().select("id").collect()]
    assert len(set(ids)) == len(ids) == 100


def test_of_two_loads_from_one_version_one_fails(spark, tmp_path):
    t = table(spark, tmp_path)
    t.append(rows(spark, 0, 10))
    base = t.version()
    t.append(rows(spark, 10, 20))
    with pytest.raises(ConcurrentLoad):
        t._commit(base, (), (), 1)
    assert t.read().count() == 20


def test_versions_stay_readable_until_they_are_forgotten(spark, tmp_path):
    t = table(spark, tmp_path, order=["id"], rows_per_file=5)
    t.append(rows(spark, 0, 20))
    first = t.version()
    t.upsert(rows(spark, 3, 4, v="b"), "id", ["v"])
    assert {r.v for r in t.read(first).collect()} == {"a"}
    assert t.forget() == 1  # the file that held id 3
    assert sorted(files.data_files(spark, f"{t.root}/data")) == sorted(t.version().files)
    assert len(content(t)) == 20


def test_insert_absent_and_empty_tables(spark, tmp_path):
    t = table(spark, tmp_path, order=["id"])
    assert t.read().count() == 0 and t.version().files == ()
    t.insert_absent(rows(spark, 0, 5), "id", "d")
    kept = t.version().files
    t.insert_absent(rows(spark, 3, 8, v="b"), "id", "d")
    assert [(r[0], r[2]) for r in content(t)] == [(k, "a" if k < 5 else "b") for k in range(8)]
    assert set(kept) <= set(t.version().files)
    with pytest.raises(LD.NullSourceKey):
        t.insert_absent(rows(spark, 0, 1).withColumn("id", F.lit(None).cast("long")), "id", "d")


def test_pipeline_into_files_is_repeat_safe(spark, tmp_path):
    inputs = P.testdata_inputs(spark, SF)
    first = P.run_files(spark, *inputs, root=str(tmp_path / "wh"), rows_per_file=200)
    tables = P.file_tables(spark, str(tmp_path / "wh"))
    facts = sorted(tables["fact_sales"].read().drop("sale_id").collect())
    second = P.run_files(spark, *inputs, root=str(tmp_path / "wh"), rows_per_file=200)
    assert second["row_counts"] == first["row_counts"] and second["quality"] == first["quality"]
    assert sorted(tables["fact_sales"].read().drop("sale_id").collect()) == facts
    assert tables["fact_sales"].read().select("sale_id").distinct().count() == len(facts)
    summary = P.summary_tables(spark, str(tmp_path / "wh"))
    numbers, cells = sorted(summary["order_numbers"].read().collect()), set(summary["order_cells"].version().files)
    # a later batch of one month leaves the other months' files
    headers, lines = inputs[2]
    month = headers.where(F.date_format("order_date", "yyyy-MM") == "1996-05")
    before = set(tables["fact_sales"].version().files)
    third = P.run_files(spark, inputs[0], inputs[1], (month, lines.join(month.select("order_id"), "order_id", "left_semi")), *inputs[3:], root=str(tmp_path / "wh"), rows_per_file=200)
    assert {f for f in before if "1996-05" not in f} <= set(tables["fact_sales"].version().files)
    assert third["row_counts"] == first["row_counts"]
    assert sorted(tables["fact_sales"].read().drop("sale_id").collect()) == facts
    # its orders keep their numbers, most of the summary's files stay, and the counts are the fact's
    assert sorted(summary["order_numbers"].read().collect()) == numbers
    assert len(cells & set(summary["order_cells"].version().files)) > len(cells) / 2
    wh = P.file_warehouse(spark, str(tmp_path / "wh"))
    for got, key, column in ((wh.order_cells(), "order_id", "orders"), (wh.buyer_cells(), "customer_key", "buyers")):
        by = [F.date_format("order_date", "yyyy-MM").alias("month"), "order_status"]
        counts = counted(got, [F.date_format("order_month", "yyyy-MM").alias("month"), "order_status"], column, "n")
        assert sorted(counts.collect()) == sorted(wh.fact.groupBy(*by).agg(F.countDistinct(key).alias("n")).collect())


def test_lines_without_a_date_are_added_to_the_summary(spark, tmp_path):
    """As the fact adds them: a load that comes twice counts their lines twice, their orders once."""
    fact = FileTable(spark, str(tmp_path / "fact"), S.FACT_SALES, P.FACT_PARTITION, ["order_date"])
    summary = P.summary_tables(spark, str(tmp_path))
    day = F.when(F.col("id") % 4 > 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")))
    given = {"order_id": F.when(F.col("id") % 7 > 0, F.col("id") % 500), "customer_key": F.col("id") % 90 + 1, "order_date": day,
             "order_status": F.when(F.col("id") % 3 > 0, F.lit("completed")), "revenue": F.lit(2)}
    batch = spark.range(2000).select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.FACT_SALES.fields if f.name != "sale_id"])
    for part in (batch, batch, batch.where("order_date < '2024-02-01' OR order_date IS NULL"), batch.limit(0)):
        fact.replace(part, "order_date", id_col="sale_id")
        P.refresh_summary(fact, part, summary)
    assert fact.read().count() == 1500 + 3 * 500
    for by in ([], ["order_status"], ["order_month"]):
        plain = fact.read().withColumn("order_month", F.trunc("order_date", "MM")).groupBy(*by).agg(F.countDistinct("order_id"), F.count(F.lit(1)), F.sum("revenue").cast("decimal(38,2)"))
        assert sorted(map(str, (tuple(r) for r in counted(summary["order_cells"].read(), by, "orders", "n", ["lines", "revenue"]).collect()))) == sorted(map(str, map(tuple, plain.collect())))


def test_empty_loads_change_nothing(spark, tmp_path):
    t = table(spark, tmp_path, order=["id"])
    none = rows(spark, 0, 1).limit(0)
    for load in (lambda: t.append(none, id_col="id"), lambda: t.replace(none, "d", id_col="id"), lambda: t.upsert(none, "id", ["v"], new_key=("id", "id"))):
        load()
        assert content(t) == [] and t.version().next_id == 1
    t.append(rows(spark, 0, 5).drop("id"), id_col="id")
    before = content(t), t.version().next_id
    t.replace(none, "d", id_col="id")
    t.upsert(none, "id", ["v"])
    assert (content(t), t.version().next_id) == before


def test_a_load_that_dies_between_the_tables_keeps_its_numbers(spark, tmp_path):
    t = table(spark, tmp_path, order=["id"])
    t.append(rows(spark, 5, 8), next_id=8)
    assert t.version().next_id == 8
    t.append(rows(spark, 1, 2))
    assert t.version().next_id == 8 and len(content(t)) == 4


def test_a_month_of_one_customer_reads_few_row_groups(spark, tmp_path):
    """Month folders, and within them files in an order that customers and products both follow."""
    import pyarrow.parquet as pq

    from starloom.functions.layout import interleaved

    n = 200_000
    fact = spark.range(n).select(F.col("id").alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 120).cast("int")).alias("d"),
                                 (F.pmod(F.xxhash64("id"), F.lit(5000)) + 1).alias("customer_key"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(800)) + 1).alias("product_key"))
    t = FileTable(spark, str(tmp_path / "f"), fact.schema, ("m", "date_format(d, 'yyyy-MM')"), [interleaved([("customer_key", 5000), ("product_key", 800)])], rows_per_file=400)
    t.append(fact)
    groups = {"all": 0, "customer_key": 0, "product_key": 0}
    for name in t.version().files:
        meta = pq.ParquetFile(f"{t.root}/data/{name}").metadata
        for g in range(meta.num_row_groups):
            columns = {c.path_in_schema: c.statistics for c in (meta.row_group(g).column(i) for i in range(meta.num_columns))}
            groups["all"] += 1
            for key, value in (("customer_key", 1234), ("product_key", 321)):
                groups[key] += "m=2024-02" in name and columns[key].min <= value <= columns[key].max
    print(groups)
    assert groups["all"] >= 400 and 0 < groups["customer_key"] < 0.05 * groups["all"] and 0 < groups["product_key"] < 0.05 * groups["all"]
    plan = t.where_partition("2024-02", "2024-02").where("customer_key = 1234")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(customer_key,1234)" in plan and "PartitionFilters: [isnotnull(m" in plan


def test_rows_are_sorted_by_the_order_alone(spark, tmp_path, monkeypatch):
    """Several folders a task, each file in order, and the session's setting is as before."""
    import pyarrow.parquet as pq

    frame = type(spark.range(1))
    sorts, plain = [], frame.sortWithinPartitions
    monkeypatch.setattr(frame, "sortWithinPartitions", lambda self, *keys: (sorts.append(keys), plain(self, *keys))[1])
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    t = table(spark, tmp_path, partition=("m", "date_format(d, 'yyyy-MM')"), order=["id"])
    t.append(rows(spark, 0, 20_000).orderBy(F.xxhash64("id")))
    assert [len(keys) for keys in sorts] == [1]  # no partition name before the order
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    ids = [pq.ParquetFile(f"{t.root}/data/{f}").read(columns=["id"]).column("id").to_pylist() for f in t.version().files]
    assert all(x == sorted(x) for x in ids) and sorted(sum(ids, [])) == list(range(20_000))
    assert len({f.split("m=")[1].split("/")[0] for f in t.version().files}) == 7


def test_the_summary_is_made_from_the_batch(spark, tmp_path, monkeypatch):
    """Stored lines are read only for dates that the batch lacks in its months."""
    fact = FileTable(spark, str(tmp_path / "fact"), S.FACT_SALES, P.FACT_PARTITION, ["order_date"])
    summary = P.summary_tables(spark, str(tmp_path))
    given = {"order_id": F.col("id") % 300, "customer_key": F.col("id") % 50 + 1, "revenue": F.lit(2), "channel": F.lit("web"),
             "order_date": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int"))}
    whole = spark.range(1800).select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.FACT_SALES.fields if f.name != "sale_id"])
    part = whole.where("order_date < '2024-01-11' OR order_date > '2024-03-20'").where("order_id % 2 = 0").withColumn("channel", F.lit("shop"))
    read, plain = [], P.DISTINCT.order_rows
    monkeypatch.setattr(P.DISTINCT, "order_rows", lambda lines: (read.append([f for f in lines.inputFiles() if "/fact/" in f]), plain(lines))[1])
    for batch in (whole, part, whole):
        path = str(tmp_path / f"batch{len(read)}")
        batch.write.parquet(path)
        batch = spark.read.parquet(path)
        fact.replace(batch, "order_date", id_col="sale_id")
        P.refresh_summary(fact, batch, summary)
        for by in (["order_month"], ["channel"]):
            counts = fact.read().withColumn("order_month", F.trunc("order_date", "MM")).groupBy(*by).agg(F.countDistinct("order_id"), F.sum("revenue").cast("decimal(38,2)"))
            got = counted(summary["order_cells"].read(), by, "orders", "n", ["revenue"])
            assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, counts.collect())))
    assert [bool(files) for files in read] == [False, True, False]
