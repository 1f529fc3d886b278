"""Ranked search, whitening and BPE by merge rounds against plain versions, with odd rows."""

import hashlib
import json
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from starloom.llm import ranked_search, whitening, word_bpe
from starloom.llm.queries import op11_ranked_search, op12_embedding_whitening, op13_word_bpe

SMALL = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, id string, n long, terms binary, score long"


# ── ranked search ─────────────────────────────────────────────────────────────

def terms(text):
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked(docs, items, k):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    held = [(d, Counter(terms(t))) for d, t in docs]
    n, total = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in held:
            if d is None or not c:
                continue
            m = 10 + 90 * c.total() * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, d))
        out += [(item, place, d, -s) for place, (s, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    word = lambda: rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else f"w{int(rng.expovariate(0.02))}"
    texts = [" ".join(word() for _ in range(rng.randrange(1, 120))) for _ in range(500)]
    texts += [texts[0]] * 300 + [None, "", " ,;\n", "ÉÉ Été-été 日本 日本", "The THE the_the", "a" * 5000, " ".join(word() for _ in range(9000))]
    docs = [(k * 3, t) for k, t in enumerate(texts)] + [(3, texts[1]), (None, texts[2])]
    rng.shuffle(docs)
    items = [(k, " ".join(word() for _ in range(rng.randrange(1, 40)))) for k in range(60)]
    items += [(100, None), (101, ""), (102, "nowhere"), (103, "Été the"), (5, "of w3"), (None, "w1 w2"), (104, texts[0]), (104, texts[0])]
    return docs, items


@pytest.fixture
def small_nodes(monkeypatch):
    """Trees of many levels and documents in many batches on a small table."""
    monkeypatch.setattr(ranked_search, "DOC_LEAF", 4)
    monkeypatch.setattr(ranked_search, "ITEM_LEAF", 2)
    monkeypatch.setattr(ranked_search, "BATCH", 100)
    monkeypatch.setattr(ranked_search, "SEED_FILES", 2)
    monkeypatch.setattr(ranked_search, "PIECE", 1000)


@pytest.mark.parametrize("item_bytes", [1 << 20, 2000])
def test_search(spark, corpus, small_nodes, item_bytes):
    docs, items = corpus
    frame = spark.createDataFrame([(d, t, "i", 1, b"", 2) for d, t in docs], DOCS).repartition(5)
    asked = spark.createDataFrame([(i, t, 7, 8) for i, t in items], "item_id long, text string, item long, score long")
    found = ranked_search.search(frame, asked, 7, item_bytes=item_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(found) == ranked(docs, items, 7)


def test_search_prunes_pairs(corpus, small_nodes):
    """Most pairs of a document and an item are never scored."""
    docs, items = corpus
    counts = [(d, ranked_search.counted((t or "").encode())) for d, t in docs if d is not None]
    vocabulary = {t: k for k, t in enumerate(sorted({t.encode() for _, text in items for t in terms(text)}))}
    n = sum(bool(c) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in vocabulary], np.int64)
    asked = [np.array(sorted({vocabulary[t.encode()] for t in terms(text)}), np.int64) for _, text in items if terms(text)]
    tree = ranked_search.Items(list(range(len(asked))), asked, weight)
    held = [(d, sorted((vocabulary[t], 10 ** 9 * c // (1000 * c + 800)) for t, c in found.items() if t in vocabulary)) for d, found in counts]
    held = [(d, x) for d, x in held if x]
    flat = np.array([v for _, x in held for v in x], np.int64)
    rows = ranked_search.Rows(flat[:, 0], flat[:, 1], np.concatenate([[0], np.cumsum([len(x) for _, x in held])]))
    scored, pairs = ranked_search.search_batch(np.array([d for d, _ in held]), rows, tree, ranked_search.Best(len(asked), 3))
    print(f"pairs scored: {scored} of {pairs}")
    assert scored < 0.5 * pairs


def test_search_strings_and_empty_tables(spark, corpus):
    docs, _ = corpus
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame([("x", "w1 w2"), (None, "w3")], "item_id string, text string")
    assert rows_of(ranked_search.search(frame, asked, 3)) == ranked(docs, [("x", "w1 w2"), (None, "w3")], 3)
    assert ranked_search.search(frame.limit(0), asked, 3).count() == 0
    assert ranked_search.search(frame, asked.limit(0), 3).count() == 0
    assert ranked_search.search(frame.where("text is null"), asked, 3).count() == 0


def test_search_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = op11_ranked_search(spark, SMALL)
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert rows_of(found) == ranked(docs, items, 10)


# ── whitening ─────────────────────────────────────────────────────────────────

def whitened(rows, top, by_count=True):
    """For each row: (id, deviation, [projection of each component]), and the explained shares."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in good], object)
    fit = x if by_count else np.array(sorted({tuple(r) for r in x.tolist()}), object)
    n, s = len(fit), fit.sum(0)
    centre = np.array([v / n for v in s])
    at, of = x.astype(float) - centre, fit.astype(float) - centre
    values, vectors = np.linalg.eigh(of.T @ of / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, [(i, int(((n * r - s) ** 2).sum())) for (i, _), r in zip(good, x)], at @ vectors[:, :top] / np.sqrt(values[:top]), values[:top] / values.sum()


def check_whitened(got, rows, top, by_count=True):
    n, exact, z, share = whitened(rows, top, by_count)
    by_key = Counter((r.vec_id, r.deviation, r.component) for r in got)
    assert by_key == Counter((i, d, k) for i, d in exact for k in range(1, top + 1))
    assert {r.n for r in got} == {n}
    of = {}
    for r in got:
        of.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, r.whitened)
    mine = np.array([[of[k][c] for c in range(1, top + 1)] for k in exact])
    sign = np.sign((mine * z).sum(0))
    assert np.abs(mine * sign - z).max() < 1e-6
    for r in got:
        assert abs(r.explained / share[r.component - 1] - 1) < 1e-9
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-8


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(4)
    rows = [(k, [rng.gauss(0, 1) * (1 + j) for j in range(6)]) for k in range(300)]
    rows += [(1000 + k, rows[0][1]) for k in range(150)]  # a hot vector
    return rows + [(7, rows[7][1]), (None, rows[9][1]), (8, [40.0] * 6)]


ODD = [(2000, None), (2001, []), (2002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2003, [math.nan] * 6), (2004, [1.0, math.inf, 0.0, 0.0, 0.0, 0.0])]


@pytest.mark.parametrize("by_count", [True, False])
def test_whitening(spark, vectors, by_count):
    frame = spark.createDataFrame([(i, v, "l", 5) for i, v in vectors + ODD], "vec_id long, embedding array<double>, x string, count long").repartition(4)
    got = whitening.whiten(frame, 4, by_count=by_count).collect()
    check_whitened(got, vectors, 4, by_count)
    assert {r.multiplicity for r in got if r.vec_id == 1000} == {151}


def test_whitening_of_odd_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame(ODD, schema)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25])] * 3, schema)).collect()
    assert len(one) == 6 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(3, 0, None, None, None)}
    flat = whitening.whiten(spark.createDataFrame([(k, [float(k), 1.0]) for k in range(4)], schema)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in flat) and flat[0].identity_error < 1e-9
    lengths = whitening.whiten(spark.createDataFrame([(k, [float(k * j % 5) for j in range(1, 2 + k % 2)]) for k in range(20)], schema)).collect()
    assert Counter(r.n for r in lengths) == {10: 30}


def test_whitening_of_large_numbers(spark):
    rng = random.Random(6)
    rows = [(k, [rng.choice([-4e12, 4e12, 1.5, 3.25]) for _ in range(3)]) for k in range(60)]
    n, exact, _, _ = whitened(rows, 3)
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 3).collect()
    want = {i: d if d < 2 ** 63 else None for i, d in exact}
    assert {r.vec_id: r.deviation for r in got} == want and None in want.values()


def test_whitening_query(spark):
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    found = op12_embedding_whitening(spark, SMALL)
    assert dict(found.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    check_whitened(found.collect(), rows, 8)


# ── BPE by merge rounds ───────────────────────────────────────────────────────

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def odd_texts():
    rng = random.Random(1)
    texts = [None, "", " ", "  a  b ", "x" * 5000, "aaa aaaa aaaaa", "Hello  World's 123 <|endoftext|> x İ ﬁ é é ​ 　 日本語テキスト", "<|startoftext|>A<|endoftext|><|endoftext|>",
             "can't  a\tb c ΑΣ 😀 x²\n\n\r\x85 y z\nq", "́a ́ ȩ́", "<|endof text|>", "a\x00b\x1c\x1dc", "ǅ ẞ ŉ ΐ K Å", "\nb a\n"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x3000), rng.randrange(0x1F300, 0x1F700), 32, 0x301, 10])) for _ in range(200)) for _ in range(60)]
    texts += ["".join(chr(rng.randrange(0x240)) for _ in range(300)) for _ in range(60)]
    return texts + ["".join(rng.choice("abcdeth  ") for _ in range(rng.randrange(1, 1500))) for _ in range(20)]


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("piece", [50, 1 << 20])
def test_word_bpe(spark, library, monkeypatch, piece):
    monkeypatch.setattr(word_bpe, "PIECE_CHARS", piece)
    monkeypatch.setattr(word_bpe, "CACHE_CHARS", 2000)
    rows = [(k, t, b"i", "n") for k, t in enumerate(odd_texts())] + [(3, "again", b"", ""), (3, "again", b"", ""), (None, "no id", b"", "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids binary, decoded string").repartition(2)
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in word_bpe.round_trip(frame, WORDS).collect())
    assert got == Counter((r[0], *digests(library, r[1])) for r in rows)
    assert word_bpe.round_trip(frame.limit(0), WORDS).count() == 0


def plain_merges(model, word):
    """One merge at a time: the lowest rank, the first of equal ones."""
    rank = {tuple(m): k for k, m in enumerate(model["merges"])}
    parts = [*word[:-1], word[-1] + model["end_of_word_suffix"]]
    while True:
        best = min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None)
        if best is None:
            return [model["vocab"][p] for p in parts]
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(6))
def test_merge_rounds_in_any_order(seed):
    """Also where a merge ranks before the one that makes its token."""
    rng = random.Random(seed)
    letters = word_bpe.byte_letters()
    tokens, merges = ["a", "b", "a$", "b$"], []
    while len(merges) < 30:
        left, right = rng.choice([t for t in tokens if not t.endswith("$")]), rng.choice(tokens)
        if [left, right] not in merges:
            merges.append([left, right])
            tokens.append(left + right)
    if seed % 2:
        rng.shuffle(merges)
    vocab = {t: k for k, t in enumerate(dict.fromkeys([*letters, *(c + "$" for c in letters), *tokens]))}
    model = {"vocab": vocab, "merges": merges, "end_of_word_suffix": "$"}
    rounds = word_bpe.Merges(model)
    words = ["".join(rng.choice("aab") for _ in range(rng.randrange(1, 30))) for _ in range(200)]
    assert [np.frombuffer(m, "<u4").tolist() for m in rounds.merged([w.encode() for w in words])] == [plain_merges(model, w) for w in words]
    assert rounds.merged([]) == []


def test_other_files_raise(tmp_path):
    config = json.load(open(WORDS, encoding="utf-8"))
    config["normalizer"]["normalizers"].append({"type": "NFKD"})
    (tmp_path / "other.json").write_text(json.dumps(config))
    with pytest.raises(ValueError):
        word_bpe.Encoder(str(tmp_path / "other.json"))
    with pytest.raises(ValueError):
        word_bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_word_bpe_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = op13_word_bpe(spark, SMALL)
    assert dict(found.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect()} == {k: digests(library, t) for k, t in texts.items()}
