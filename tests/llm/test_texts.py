"""Quality rules, suffix dedup, Jaccard join and mixing against plain versions, with odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import mixing, ngram_join, quality, suffix_dedup
from starloom.llm.suffix_sort import deep_shallow

from . import reference

SCHEMA = "doc_id long, text string, source string, row int, block string, id string, part int"


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    passage = words(rng, 60)
    out = [None, "", " \t\n ", "one", "Two words", "a b c", "éé ß " * 30, "x" * 30_000, words(rng, 6000)]
    base = [words(rng, rng.randrange(40, 200)) for _ in range(12)]
    for b in base:
        out += [b, b, b.upper(), b + " tail", passage + " " + b]
        w = b.split(" ")
        for _ in range(3):
            v = list(w)
            v[rng.randrange(len(v))] = "changed"
            out.append(" ".join(v))
        out.append(b + "\n" + b + "\n" + "é" + b)
        out.append(" ".join(x + rng.choice(["", "##", "$"]) for x in w))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    """With further columns whose names the operators use themselves."""
    return spark.createDataFrame([(k, t, None if k % 7 == 0 else f"s{k % 3 if k % 2 else 0}", k, "b", "i", 1) for k, t in texts], SCHEMA).repartition(3).cache()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality(spark, docs, texts):
    limits = quality.Limits()
    got = {r.doc_id: r.asDict() for r in quality.judge(docs, limits).collect()}
    assert len(got) == len(texts)
    for k, t in texts:
        want = reference.quality(t, limits)
        assert {c: got[k][c] for c in want} == want, t
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, g in got.items() if g["kept"])
    assert quality.judge(empty(spark)).count() == 0 and quality.keep_good(empty(spark)).count() == 0


def test_quality_repeated_rows_and_null_id(spark):
    rows = spark.createDataFrame([(None, "a b c"), (1, "x y"), (1, "x y")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_words) for r in quality.judge(rows).collect()) == [(0, 3), (1, 2), (1, 2)]


@pytest.mark.parametrize("depth", [3, 16, 50])
def test_deep_shallow_order(depth):
    rng = random.Random(depth)
    for _ in range(40):
        data = bytes(rng.choice(b"aab") for _ in range(rng.randrange(1, 300))) + b"a" * depth
        buffer = np.frombuffer(data, np.uint8)
        starts = np.array([rng.randrange(len(data) - depth + 1) for _ in range(rng.randrange(1, 200))])
        order, first = deep_shallow(buffer, starts, depth)
        keys = [data[s:s + depth] for s in starts[order]]
        assert keys == sorted(keys)
        assert first.tolist() == [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]


@pytest.mark.parametrize("often, segment", [(4096, 1 << 20), (2, 64)])
def test_suffix_dedup(spark, docs, texts, monkeypatch, often, segment):
    monkeypatch.setattr(suffix_dedup, "OFTEN", often)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.deduplicate(docs).collect()}
    want = reference.suffix_dedup(texts, 50)
    assert got == want
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    rows = {r.doc_id: r for r in left.collect()}
    assert {k: r.text for k, r in rows.items()} == {k: w[3].decode("utf-8", "ignore") for k, w in want.items()}
    assert all(r.row == k and r.block == "b" and r.id == "i" for k, r in rows.items())


def block_of(texts):
    """A block of texts with ids 0, 1, …."""
    import pyarrow as pa

    return suffix_dedup.Block.of(pa.table({"id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())}))


def passage_texts():
    """One passage in 5,000 documents, and three times as many that are nearly copies of each other."""
    rng = random.Random(8)
    passage, near = words(rng, 25, 100_000), words(rng, 30, 100_000).split(" ")
    texts = [f"{words(rng, 6, 100_000)} {passage} {words(rng, 6, 100_000)}" for _ in range(5000)]
    for _ in range(5000):
        near[rng.randrange(len(near))] = f"w{rng.randrange(100_000)}"
        texts.append(" ".join(near))
    return texts


@pytest.mark.parametrize("often", [1 << 15, 1000])
def test_suffix_dedup_sends_little_of_a_common_passage(often):
    """However many documents share a passage, a block sends no more than twice as many strings as it has."""
    block = block_of(passage_texts())
    own = block.runs.own
    _, at = np.unique(block.runs.anchor, return_inverse=True)
    strings = np.bincount(at[np.unique(np.stack([at, own.astype(np.int64)]), axis=1, return_index=True)[1]])
    flags = np.where(strings > often, 2, 1).astype(np.uint8)[at]
    sent = block.strings(flags, 16)
    print(f"runs {len(at)}, of frequent anchors {int((flags == 2).sum())}, sent {len(sent.parts)}")
    assert len(sent.parts) <= 2 * len(at)


def test_suffix_dedup_of_a_common_passage(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "OFTEN", 1000)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 5000)
    texts = list(enumerate(passage_texts()))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.deduplicate(docs, block_bytes=1 << 19).collect()}
    assert got == reference.suffix_dedup(texts, 50)


def test_suffix_dedup_odd_tables(spark):
    assert suffix_dedup.deduplicate(empty(spark)).count() == 0
    long_text = "".join(chr(97 + i % 23) + str(i) for i in range(60))
    rows = spark.createDataFrame([(None, long_text), (3, long_text), (3, long_text), (5, long_text)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_removed) for r in suffix_dedup.deduplicate(rows).collect())
    assert got == [(-1, 0), (3, 0), (3, 0), (5, len(long_text))]


@pytest.mark.parametrize("measure", [(3, 90), (5, 80), (1, 60)])
def test_jaccard_join(docs, texts, measure):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs, ngram_join.Measure(*measure)).collect()}
    assert got == reference.jaccard_components(texts, *measure)


def test_jaccard_join_large_groups(docs, texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP", 3)
    monkeypatch.setattr(ngram_join, "CHUNK", 2)
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    got = {r.doc_id: r.component_id for r in ngram_join.join(docs, ngram_join.Measure(3, 80)).collect()}
    assert got == {k: c for k, (_, c) in reference.jaccard_components(texts, 3, 80).items()}


@pytest.mark.parametrize("elements", [50, 2000])
def test_jaccard_join_of_long_texts(docs, texts, monkeypatch, elements):
    """Groups with many elements are cut into chunks however few sets they have."""
    monkeypatch.setattr(ngram_join, "ELEMENTS", elements)
    monkeypatch.setattr(ngram_join, "PIVOTS", 3)
    got = {r.doc_id: r.component_id for r in ngram_join.join(docs, ngram_join.Measure(3, 80)).collect()}
    assert got == {k: c for k, (_, c) in reference.jaccard_components(texts, 3, 80).items()}


def test_jaccard_join_with_equal_hashes(spark, monkeypatch):
    """Classes are kept apart even if 64 bits of their digests would not do so."""
    from pyspark.sql import functions

    hashed = functions.xxhash64
    monkeypatch.setattr(ngram_join.F, "xxhash64", lambda *c: functions.lit(1).cast("long") if isinstance(c[0], str) and c[0] == "digest" else hashed(*c))
    texts = list(enumerate(["a b c d e f", "a b c d e f", "p q r s t u", "p q r s t u v", "x y z", ""]))
    got = {r.doc_id: r.component_id for r in ngram_join.join(spark.createDataFrame(texts, "doc_id long, text string"), ngram_join.Measure(2, 80)).collect()}
    assert got == {k: c for k, (_, c) in reference.jaccard_components(texts, 2, 80).items()}


def test_jaccard_join_odd_tables(spark, docs, texts):
    assert ngram_join.join(empty(spark)).count() == 0
    a, b = "a b c d e f g h", "p q r s t u v w"
    rows = spark.createDataFrame([(None, a), (4, a), (4, b), (6, b), (2, ""), (3, None), (4, a)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id) for r in ngram_join.join(rows).collect() if r.doc_id is not None)
    assert got == [(2, 2), (3, 3), (4, 4), (4, 4), (4, 4), (6, 4)]
    left = ngram_join.one_of_each(docs, ngram_join.Measure(3, 90))
    want = {k for k, (n, c) in reference.jaccard_components(texts, 3, 90).items() if k == c}
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == want


def test_overlaps_in_slices():
    rng = np.random.default_rng(1)
    x = [np.unique(rng.integers(0, 50, 30).astype(np.uint64)) for _ in range(9)]
    y = [np.unique(rng.integers(0, 50, 20).astype(np.uint64)) for _ in range(5)] + [np.empty(0, np.uint64)]
    assert ngram_join.overlaps(x, y, columns=7).tolist() == [[len(np.intersect1d(a, b)) for b in y] for a in x]


def test_measure_guarantee():
    """Sets that link share as many elements of their prefixes as the filters ask for."""
    rng = random.Random(2)
    m = ngram_join.Measure(3, 80)
    for _ in range(400):
        n = rng.randrange(1, 80)
        x = set(rng.sample(range(1000), n))
        y = set(rng.sample(sorted(x), max(1, n - rng.randrange(0, n // 4 + 1)))) | set(rng.sample(range(1000), rng.randrange(0, n // 6 + 1)))
        if 100 * len(x & y) >= 80 * len(x | y):
            px, py = (set(sorted(s)[:int(m.prefix(len(s)))]) for s in (x, y))
            assert len(px & py) >= max(m.least(len(x)), m.least(len(y)))
            assert len(x & y) >= max(m.shared(len(x)), m.shared(len(y)))


@pytest.mark.parametrize("target", [mixing.Target(repetition=1.5), mixing.Target(repetition=2.0, budget=9000.0), mixing.Target(entropy=0.9, budget=3000.0), mixing.Target()])
def test_mixing(spark, docs, texts, target):
    def size(t):
        return len(reference.WORD.findall(t or ""))

    source = {r.doc_id: r.source or "" for r in docs.collect()}
    tokens = {s: sum(size(t) for k, t in texts if source[k] == s) for s in set(source.values())}
    total = sum(tokens.values())
    plan = {r.source: r for r in mixing.plan(docs, target).collect()}
    a = next(iter(plan.values())).exponent
    z = sum((n / total) ** a for n in tokens.values())
    most = max(n / (n / total) ** a for n in tokens.values())
    budget = target.budget or most * z
    for s, n in tokens.items():
        assert plan[s].tokens == n and plan[s].weight == pytest.approx((n / total) ** a / z)
        assert plan[s].quota == pytest.approx(budget * plan[s].weight, abs=1)
    passes = [budget * p.weight / tokens[s] for s, p in plan.items()]
    if target.repetition:
        assert max(passes) <= target.repetition * (1 + 1e-6)
    if target.budget is None:
        assert min(passes) >= 1 - 1e-9
    shown = {}
    rows = mixing.mixed_rows(docs, target)
    assert rows.columns == docs.columns
    for r in rows.collect():
        shown[r.doc_id] = shown.get(r.doc_id, 0) + 1
    longest = {s: max(size(t) for k, t in texts if source[k] == s) for s in tokens}
    for s in tokens:
        got = sum(size(t) * shown.get(k, 0) for k, t in texts if source[k] == s)
        assert plan[s].quota <= got <= plan[s].quota + longest[s]
        counts = {shown.get(k, 0) for k, t in texts if source[k] == s}
        assert max(counts) - min(counts) <= 1


def test_mixing_order(spark, docs, texts):
    target = mixing.Target(repetition=2.0, budget=9000.0)
    sizes = {k: len(reference.WORD.findall(t or "")) for k, t in texts}
    plan = {r.source: r for r in mixing.plan(docs, target).collect()}
    rows = mixing.mix(docs, target).select("row.doc_id", "source", "pass", "block", "place").collect()
    order = sorted(rows, key=lambda r: (r["pass"], r.block, r.place))
    assert {r["pass"] for r in rows} == set(range(1, max(p.passes for p in plan.values()) + 2))
    for s, p in plan.items():
        own = {k: [(r.block, r.place, r.doc_id) for r in order if r.source == s and r["pass"] == k] for k in range(1, p.passes + 2)}
        whole = sorted({(b, c, d) for x in own.values() for b, c, d in x})
        assert all([(b, c, d) for b, c, d in own[k]] == own[1] for k in range(1, p.passes + 1))
        part = own[p.passes + 1]  # the beginning of the same order, up to the quota
        assert sorted(set(part)) == whole[:len(set(part))]
        shown, last = sum(sizes[d] for _, _, d in part), part[-1][1] if part else None
        assert shown >= p.rest > shown - sum(sizes[d] for _, c, d in part if c == last) or not p.rest
    first = [r.source for r in order if r["pass"] == 1]
    assert sum(a != b for a, b in zip(first, first[1:])) > len(plan)  # blocks of all sources are shuffled with one another


@pytest.mark.parametrize("target", [mixing.Target(repetition=1.3, budget_share=1.0), mixing.Target(entropy=0.93, budget_share=0.4), mixing.Target(repetition=1.7)])
def test_mixing_shows_exactly_these_rows(spark, docs, texts, target):
    """Exponent by bisection, quotas, and the blocks and places in order, from the hashes that give the random orders."""
    size = {k: len(reference.WORD.findall(t or "")) for k, t in texts}
    at = {r.doc_id: (r.source, r.block, r.place) for r in mixing._placed(docs, "source", "doc_id", target.seed).select("row.doc_id", "source", "block", "place").collect()}
    tokens = {s: sum(size[k] for k in at if at[k][0] == s) for s in {s for s, _, _ in at.values()}}
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items() if n}

    def within(a):
        z = sum(p ** a for p in share.values())
        entropy = -sum(p ** a / z * np.log(p ** a / z) for p in share.values()) / np.log(len(share))
        rates = [p ** (a - 1) for p in share.values()]
        passes = max(rates) / min(rates) if target.budget_share is None else target.budget_share * max(rates) / z
        return (target.entropy is None or entropy <= target.entropy) and (target.repetition is None or passes <= target.repetition)

    low, high = 0.0, 1.0
    assert not within(low) and within(high)  # the target binds
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (low, middle) if within(middle) else (middle, high)
    a = mixing.plan(docs, target).first().exponent
    assert 0 < a < 1 and a == pytest.approx(high, abs=1e-6)
    z = sum(p ** a for p in share.values())
    budget = max(tokens[s] / share[s] ** a for s in share) * z if target.budget_share is None else target.budget_share * total
    want = []
    for s, n in tokens.items():
        passes, rest = divmod(round(budget * share[s] ** a / z), n)
        order = sorted((b, c, k) for k, (of, b, c) in at.items() if of == s)
        done, last = 0, None
        for b, c, k in order:
            if done >= rest and (b, c) != last:
                break
            done, last = done + size[k], (b, c)
            want.append((k, passes + 1))
        want += [(k, p) for _, _, k in order for p in range(1, passes + 1)]
    got = mixing.mix(docs, target).select("row.doc_id", "pass").collect()
    assert sorted((r.doc_id, r["pass"]) for r in got) == sorted(want)


def test_mixing_odd_tables(spark):
    assert mixing.mixed_rows(empty(spark), mixing.Target(repetition=2.0)).count() == 0
    rows = spark.createDataFrame([(1, None, "a"), (2, "x y", None), (2, "x y", None), (None, "z", "")], "doc_id long, text string, source string")
    assert mixing.mixed_rows(rows, mixing.Target()).count() == 4


def test_mixing_query_evens_out_sources(spark, tmp_path):
    """Every document is shown, and a source of a tenth of the size up to four times, not 1.05 times."""
    from starloom.llm.queries import op2_source_mixing

    docs = spark.range(660).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 600, "large").otherwise("small").alias("source"), F.lit("a b c").alias("text"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = op2_source_mixing(spark, str(tmp_path)).collect()
    shown = {s: [r.doc_id for r in rows if r.source == s] for s in ("large", "small")}
    assert set(shown["large"]) == set(range(600)) and set(shown["small"]) == set(range(600, 660))
    assert len(shown["large"]) == 600 and 230 <= len(shown["small"]) <= 245
    assert max(r["pass"] for r in rows) == 4
