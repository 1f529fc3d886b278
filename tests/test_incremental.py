"""Key summaries against checks of the whole table, load by load."""

import random

import pytest

from starloom.operators import incremental as INC
from starloom.operators import quality as Q


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k long")


def whole(df):
    return Q.unique_violations({"t": df}, [("t", "k")]).first().violations


@pytest.mark.parametrize("seed", range(2))
def test_unique_keys_load_by_load(spark, monkeypatch, seed):
    monkeypatch.setattr(INC, "KEYS", 10)
    rng = random.Random(seed)
    stored, summary, held = keys(spark, []), INC.key_summary(keys(spark, []), "k"), []
    for load in range(4):
        values = [rng.choice([None, rng.randrange(-30, 300)]) if load % 2 else rng.randrange(100 * load, 100 * load + 60) for _ in range(25)]
        batch = keys(spark, values)
        after, _ = INC.key_summary_after(summary, stored, batch, "k")
        held += values
        stored = keys(spark, held)
        rows = after.collect()  # stored beside the table
        summary = spark.createDataFrame(rows, after.schema)
        assert INC.duplicates(summary).first().violations == whole(stored)
        assert sum(r.rows for r in rows) == len(held)
        assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, INC.key_summary(stored, "k").collect()), key=str)


def test_new_keys_read_next_to_nothing(spark):
    stored = spark.range(1_000_000).withColumnRenamed("id", "k")
    summary = INC.key_summary(stored, "k")
    after, read = INC.key_summary_after(summary, stored, spark.range(1_000_000, 1_050_000).withColumnRenamed("id", "k"), "k")
    assert INC.duplicates(after).first().violations == 0
    n = read.count()
    print(f"stored rows read: {n} of 1000000")
    assert n <= INC.KEYS


def test_foreign_keys_load_by_load(spark, monkeypatch):
    monkeypatch.setattr(INC, "KEYS", 10)
    rng = random.Random(5)
    child, parent = [rng.choice([None, rng.randrange(200)]) for _ in range(150)], sorted(rng.sample(range(200), 120))

    def check():
        frames = {"c": keys(spark, child), "p": keys(spark, parent)}
        return Q.foreign_key_violations(frames, [("c", "k", "p")]).first().violations

    def stored(df):
        return spark.createDataFrame(df.collect(), df.schema)

    summary = stored(INC.orphan_summary(keys(spark, child), "k", keys(spark, parent), "k"))
    assert INC.orphans(summary).first().violations == check() > 0
    batch = [rng.choice([None, rng.randrange(60, 260)]) for _ in range(80)]
    summary = stored(INC.orphans_after_child(summary, keys(spark, batch), "k", keys(spark, parent), "k"))
    child += batch
    assert INC.orphans(summary).first().violations == check()
    new = [k for k in range(40, 120) if k not in parent]
    parent += new
    after, read = INC.orphans_after_parent(summary, keys(spark, child), "k", keys(spark, parent), keys(spark, new), "k")
    assert INC.orphans(after).first().violations == check()
    assert 0 < read.count() < len(child)
    empty = keys(spark, [])
    assert INC.orphans(INC.orphan_summary(empty, "k", empty, "k")).first().violations == 0
    assert INC.orphans(INC.orphans_after_child(summary, empty, "k", keys(spark, parent), "k")).first().violations == INC.orphans(summary).first().violations
