"""The pipeline against a plain version of its stages."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers

import corpus_pipeline
from starloom.llm import bpe, quality

from . import reference


def documents():
    rng = random.Random(11)

    def words(n):
        return " ".join(f"wörd{rng.randrange(3000)}" for _ in range(n))

    passage = words(70)
    out = []
    for k in range(30):
        text = words(rng.randrange(60, 160))
        out.append(text)
        if k % 5 == 0:
            out += [text, text.replace("wörd1", "x1", 1), passage + " " + words(90)]
        if k % 7 == 0:
            out += ["# " * 80 + text, (words(8) + "\n") * 30, "too short"]
    out += [None, ""]
    rng.shuffle(out)
    return [(k, t, "en", f"s{k % 4 if k % 3 else 0}", len(t or "")) for k, t in enumerate(out)]


def plain(rows):
    """doc_id -> (source, text) before mixing."""
    kept = {k: (s, t) for k, t, _, s, _ in rows if reference.quality(t, quality.Limits())["kept"]}
    groups = reference.jaccard_components([(k, t) for k, (_, t) in kept.items()], 5, 80)
    kept = {k: v for k, v in kept.items() if groups[k][1] == k}
    left = reference.suffix_dedup([(k, t) for k, (_, t) in kept.items()], 50)
    return {k: (s, left[k][3].decode("utf-8", "ignore")) for k, (s, _) in kept.items()}


def test_pipeline_equals_its_plain_version(spark, tmp_path):
    rows = documents()
    folder = str(tmp_path / "sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    want = plain(rows)
    assert 0 < len(want) < len(rows)
    encoding = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert {r.doc_id for r in got} == set(want)
    for r in got:
        ids = encoding.encode_ordinary(want[r.doc_id][1])
        assert (r.n_tokens, bytes(r.ids), r.decoded_sha256) == (len(ids), np.array(ids, "<u4").tobytes(), reference.sha(want[r.doc_id][1].encode()))
    # the mixture: every document once, small sources up to 1.5 times, within a document of the quota
    size = {k: len(reference.WORD.findall(t)) for k, (_, t) in want.items()}
    tokens = Counter()
    for k, (s, _) in want.items():
        tokens[s] += size[k]
    low, high = min(tokens.values()), max(tokens.values())
    a = max(0.0, 1 + math.log(1.5) / math.log(low / high)) if low < high else 1.0
    shown = Counter(r.doc_id for r in got)
    for s, n in tokens.items():
        quota = n * (n / high) ** (a - 1)
        seen = sum(shown[k] * size[k] for k, (own, _) in want.items() if own == s)
        assert quota - 2 <= seen <= quota + max(size.values()) + 1
    assert set(shown.values()) <= {1, 2}


def test_stages_keep_the_columns(spark):
    frame = spark.createDataFrame([(1, "a b", "s", 3, 2)], "doc_id long, text string, source string, block int, n_chars int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, "")
        assert out.columns == frame.columns and [f.dataType for f in out.schema] == [f.dataType for f in frame.schema]


def test_pipeline_of_nothing(spark, tmp_path):
    folder = str(tmp_path / "sf")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
