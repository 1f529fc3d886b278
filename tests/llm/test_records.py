"""URL filter, HTML extraction, token files, chat formatting, BPE and embeddings."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from starloom.llm import bpe, chat, embed_join, html_text, tokens, url_filter

from . import reference

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def test_url_rules_and_parts(spark):
    cases = {
        "https://A.Example.ORG/es/1?x=/y#z": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
        "http://x.org": ("x.org", "", None, "allow"),
        "x://com/de/?q": ("com", "/de/", "com/de/", "block"),
        "http://É.com?u://b/": ("É.com", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://m.cheappills.net/en/4": ("m.cheappills.net", "/en/4", None, "block"),
        "http://freecasinobonus.net/": ("freecasinobonus.net", "/", None, "block"),
        "http://news.net/library/article": ("news.net", "/library/article", None, "allow"),
        "http://" + "q" * 3000 + ".net/": ("q" * 3000 + ".net", "/", None, "allow"),
    }
    rows = spark.createDataFrame([(i, u, "x", 1.5) for i, u in enumerate(cases)] + [(None, "http://x.org", "x", 2.0)], "page_id long, url string, host string, score double")
    got = url_filter.judge(rows, RULES).collect()
    assert len(got) == len(cases) + 1
    by_id = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    for i, (u, want) in enumerate(cases.items()):
        assert by_id[i] == want, u
    assert url_filter.judge(rows.limit(0), RULES).count() == 0


@pytest.mark.parametrize("hosts", [
    ["cheappills.net"], ["www.cheappills.net", "m.cheappills.net"], ["cheappills.net", "cheappills.com", "cheappills.co.uk"],
    [f"s{i}.cheappills.{e}" for i in range(12) for e in ("net", "com")] + [f"cheappills.shop{c}.org:80" for c in "abcdefgh"]])
def test_concatenated_name_on_several_hosts(spark, hosts):
    urls = [f"http://{h}/en/{i}" for i, h in enumerate(hosts)] + ["http://buycheappills.org/x"]
    # common words that end like a block word stay whole
    urls += [f"http://{h}.net/{p}/1" for h in ("alder", "birch", "cedar", "maple") for p in ("threads", "uploads")]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(rows, ()).collect()}
    assert [got[i] for i in range(len(urls))] == ["block"] * (len(hosts) + 1) + ["allow"] * 8


def test_block_words_alone(spark):
    block = ["poker", "escort", "warez", "lottery", "jackpot", "payday", "sex", "keygen", "slots", "replica"]
    allow = ["mail", "download", "girls", "uploads", "threads", "essex", "middlesex"]
    urls = [f"http://{w}.net/" for w in block + allow] + [f"http://{w}.org/" for w in ("pay", "day", "jack", "pot")] * 2
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(rows, ()).collect()}
    assert [got[i] for i in range(len(urls))] == ["block"] * len(block) + ["allow"] * (len(urls) - len(block))


def test_concatenations():
    seeds = {"cheap", "pills", "ads"}
    known = {(0, 5): 2.0, (5, 5): 3.0}
    assert url_filter.concatenation("cheappills", 1e6, known, 1e9, seeds) == ["cheap", "pills"]
    assert url_filter.concatenation("cheappills", 2.0, known, 1e9, ()) == ["cheap", "pills"]
    assert url_filter.concatenation("cheappills", 3.0, known, 1e9, ()) == []  # more common than its parts
    assert url_filter.concatenation("heads", 2.0, {(0, 2): 50.0, (2, 3): 50.0}, 1e3, seeds) == []  # one part of three letters


def test_viterbi():
    known = {(0, 5): 4.0, (5, 5): 3.0, (0, 10): 0.0}
    assert url_filter.viterbi("cheappills", known, 100.0) == ["cheap", "pills"]
    assert url_filter.viterbi("cheappills", {}, 100.0) == ["cheappills"]
    assert "".join(url_filter.viterbi("ab" * 500, {(0, 2): 1.0}, 10.0)) == "ab" * 500


def test_seed_names_get_their_labels(spark):
    """Also on other hosts, whatever the language of the page."""
    urls = [(f"http://www.{name.replace('.example', '.example.net').partition('/')[0]}/{code}/{name.replace('.example', '').partition('/')[2]}", label)
            for name, label in url_filter.SEEDS for code in ("en", "fr", "196")]
    rows = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(rows, ()).collect()}
    assert [(u, got[i]) for i, (u, _) in enumerate(urls)] == urls


def splits(name):
    """All ways to cut a name."""
    for cuts in range(1 << (len(name) - 1)):
        at = [0] + [i + 1 for i in range(len(name) - 1) if cuts >> i & 1] + [len(name)]
        yield list(zip(at, at[1:]))


def test_segmentation_against_all_splits(monkeypatch):
    """The likeliest split of all, also where several are equally likely and where words are limited."""
    monkeypatch.setattr(url_filter, "MAX_WORD", 7)
    rng = np.random.default_rng(0)
    for _ in range(150):
        n = int(rng.integers(1, 10))
        known = {(a, b - a): float(rng.integers(1, 4)) for a in range(n) for b in range(a + 1, n + 1) if rng.random() < 0.3 and b - a <= 7}
        total = 20.0

        def cost(split):
            return sum(np.log(total) - np.log(known[a, b - a]) if (a, b - a) in known else np.log(total) + 2.3 * (b - a) for a, b in split)

        got = url_filter.viterbi("x" * n, known, total)
        ends = np.cumsum([len(w) for w in got]).tolist()
        mine = list(zip([0, *ends], ends))
        assert cost(mine) == pytest.approx(min(cost(s) for s in splits("x" * n) if all(b - a <= 7 for a, b in s)))
        # parts: known pieces of two letters or more, not the whole, two of them of three
        good = [s for s in splits("x" * n) if all((a, b - a) in known and b - a > 1 and b - a < n for a, b in s) and sum(b - a > 2 for a, b in s) > 1]
        parts = url_filter.parts_of("x" * n, known, total)
        assert bool(parts) == bool(good)
        if good:
            ends = np.cumsum([len(w) for w in parts]).tolist()
            assert cost(zip([0, *ends], ends)) == pytest.approx(min(map(cost, good)))


def test_url_filter_repeated_rows(spark):
    rows = spark.createDataFrame([(1, "http://cheappills.net/"), (1, "http://cheappills.net/"), (1, "http://news.net/"), (2, None)], "page_id long, url string")
    assert sorted((r.page_id, r.verdict) for r in url_filter.judge(rows, ()).collect()) == [(1, "allow"), (1, "block"), (1, "block"), (2, "allow")]


RU_LONG = "Кошка весь день спит у окна, пока на улице идёт дождь, и никто не решается разбудить её раньше ужина."
LONG = "The cat is on the mat and it was there for a long time with the other cats of the house."


@pytest.mark.parametrize("page, want", [
    ("", ""), (None, ""), ("plain  text\n here", "plain text here"),
    (f"<nav><a href=x>{LONG}</a></nav><article><h1>Head</h1><p>Short.<p>{LONG}</p>End&amp;lt; &lt;b&gt;</article><footer>{LONG}</footer>", f"Head\nShort.\n{LONG}\nEnd&lt; <b>"),
    (f"<article><p>{LONG}<div class='comments'><p>{LONG}</p></div><aside>{LONG}</aside><form>{LONG}</form><p>Be.</p></article><div class=ad>{LONG}</div>", f"{LONG}\nBe."),
    (f"<body><div id='cookie-notice'>{LONG}</div><p>{LONG}</p><p>Tiny.</p><p>{LONG}</p><ul><li><a>one</a><li><a>two</a></ul>", f"{LONG}\nTiny.\n{LONG}"),
    (f"<article><p>a<b>b</b>c<br>d\u00a0 e<script>var t='</p>';</script>f</p><!-- <p>no</p> --><p>{LONG}", f"abc d e f\n{LONG}"),
    (f"<article><p title=\"a > b\">{LONG}</p><style>p{{}}</style><p>x &#233;&eacute; &nope;", f"{LONG}\nx éé &nope;"),
    ("<article><p>one<p>two", "one\ntwo"), ("<article><p>" + "word " * 40000, ("word " * 40000).strip()),
])
def test_main_text(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    # wrappers of the whole article
    (f"<nav><a href=x>Home</a></nav><div class='widget Blog' id='Blog1'><h1>Head</h1><p>{LONG}</p><p>Tiny.</p><p>{LONG}</p></div><footer>{LONG}</footer>", f"Head\n{LONG}\nTiny.\n{LONG}"),
    (f"<div class='elementor-widget elementor-widget-theme-post-content'><p>{LONG}</p></div><div class='elementor-widget elementor-share'><p>Share it</p></div>", LONG),
    (f"<main><div class='elementor-widget'><p>{LONG}</p></div><div class='elementor-widget'><p>{LONG}</p></div></main>", f"{LONG}\n{LONG}"),
    (f"<div class='search-results'><p>{LONG}</p></div>", LONG), (f"<div id='page-share-wrap'><article><p>One.<p>{LONG}</article></div>", f"One.\n{LONG}"),
    ("<div class=widget><article><p>one<p>two</article></div>", "one\ntwo"), (f"<div class=ad-supported><main><p>{LONG}</main></div>", LONG),
    (f"<div class='layout sidebar-right'><div><p>{LONG}</p><p>{LONG}</p></div><div class=sidebar><p>{LONG}</p></div></div>", f"{LONG}\n{LONG}\n{LONG}"),
    # side boxes, comments and what is hidden stay apart
    (f"<article><p>{LONG}</article><div class=related><article><p>{LONG}</article></div>", LONG),
    (f"<div><p>{LONG}</p><p>{LONG}</p></div><div class=sidebar><article><p>{LONG}</article></div>", f"{LONG}\n{LONG}"),
    (f"<div><p>{LONG}</p></div><div class=comments><article class=comment-body><p>{LONG}</article><article><p>{LONG}</article></div>", LONG),
    (f"<article><p>{LONG}<div class=share><p>Tell a friend</div><p>{LONG}</article>", f"{LONG}\n{LONG}"),
    (f"<div hidden><article><p>{LONG}</article></div><div role=search><p>{LONG}</p></div><p>{LONG}</p>", LONG),
    # text outside the articles is not lost by them
    (f"<div><p>{LONG}</p></div><div class=related><article><p>{LONG}</article><article><p>{LONG}</article></div>", f"{LONG}\n{LONG}\n{LONG}"),
    ("<div class=widget>" * 5000 + LONG, LONG),
])
def test_marked_containers(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    # an author's line and a marked paragraph are the article's
    (f"<article><p class=byline>By Ann</p><p>{LONG}</article>", f"By Ann\n{LONG}"), (f"<article><div class=byline><p>{LONG}</p></div><p>{LONG}</article>", f"{LONG}\n{LONG}"),
    (f"<article><p class=comment>{LONG}</p><p>{LONG}</article>", f"{LONG}\n{LONG}"),
    # longer names that only have a marking word in them
    (f"<nav><a href=x>Home</a></nav><div class=ad-free-reading><p>{LONG}</p><p>Be.</p><p>{LONG}</p></div><footer>{LONG}</footer>", f"{LONG}\nBe.\n{LONG}"),
    (f"<div id=cookie-recipes><p>{LONG}</p><div class=comments>{LONG}</div></div><div class=cookie-banner>{LONG}</div>", LONG),
    (f"<div id=cookie-recipes><p>{RU_LONG}</p></div><div class=ad>{LONG}</div>", RU_LONG),
    # and that go as long as there is other text; plain names always go
    (f"<article><p>{LONG}<div class=ad-acme-2020><p>{LONG}</p></div></article>", LONG), (f"<div class='cookie-notice box'><p>{LONG}</p></div>", ""),
    (f"<div class=ad-wrapper-left>{LONG}</div><div class=comment-list-item>{LONG}</div>", ""),
])
def test_names_with_a_marking_word(page, want):
    assert html_text.main_text(page) == want


def plain_article(page):
    """The article's blocks as the standard library's parser sees them."""
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.inside, self.blocks = 0, [""]

        def handle_starttag(self, tag, attrs):
            self.inside += tag == "article"
            if tag in ("p", "h1", "article"):
                self.blocks.append("")
            self.blocks[-1] += " " if tag == "br" else ""

        def handle_endtag(self, tag):
            self.inside -= tag == "article"
            if tag in ("p", "h1", "article"):
                self.blocks.append("")

        def handle_data(self, data):
            if self.inside:
                self.blocks[-1] += data

    parser = Article()
    parser.feed(page)
    parser.close()
    return "\n".join(b for b in (" ".join(b.split()) for b in parser.blocks) if b)


def test_all_pages_against_their_articles(spark):
    """The test pages have their text in an article of headings and paragraphs, and an advert, a menu and a footer outside it."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: plain_article(r.html or "") for r in rows.collect()}
    got = {r.page_id: r.text for r in html_text.extract(rows).collect()}
    assert got == want and sum(map(bool, want.values())) > 200


IT = "Il gatto dorme tutto il giorno vicino alla finestra mentre fuori piove, e nessuno osa svegliarlo prima di cena."
RU = "Кошка весь день спит у окна, пока на улице идёт дождь, и никто не решается разбудить её раньше ужина."
ZH = "猫整天睡在窗边，外面下着雨，没有人敢在晚饭前叫醒它。" * 4
NAV, FOOT = "<nav><ul><li><a href=x>Home</a></ul></nav>", "<footer>Copyright</footer>"
LIST = "<ul><li><a href=x>one thing</a><li><a href=x>another thing</a></ul>"
POEM = [f"Riga breve numero {n}" for n in ("uno", "due", "tre", "quattro", "cinque")]


@pytest.mark.parametrize("page, want", [
    *[(f"<body>{NAV}<div><h1>Gatto</h1><p>{t}</p><p>Bis.</p><p>{t}</p></div>{FOOT}", f"Gatto\n{t}\nBis.\n{t}") for t in (IT, RU, ZH, LONG)],
    (f"<body>{NAV}{''.join(f'<p>{x}' for x in POEM)}</p>{FOOT}", "\n".join(POEM)),
    (f"<body>{LIST}<div>{''.join(f'<p>{x}' for x in POEM)}</p></div>{LIST}", "\n".join(POEM)),
    (f"<body>{LIST}<div><p>{RU}</p></div>{LIST}", RU),
    (f"{NAV}<article><p>{RU}</p>{LIST}<p>{IT}</p></article>{FOOT}", f"{RU}\n{IT}"), ("<article><p>Prima." + LIST + "<p>Dopo.</article>", "Prima.\nDopo."),
    (f"{NAV}<div class='widget Blog'><p>{RU}</p><p>{RU}</p></div><div class='widget share'><p>Делиться</p></div><div class=cookies>{LONG}</div>{FOOT}", f"{RU}\n{RU}"),
    # what is set apart stays apart
    (f"<body><nav>{IT}</nav><p>{IT}</p><div class=comments><p>{RU}</p></div><aside>{RU}</aside><footer>{IT}</footer>", IT),
    (f"<body>{LIST}<p>Su.</p>{LIST}{FOOT}", ""),
])
def test_text_without_known_stop_words(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    (f"<article><p>{LONG} So <math display=block class=eq><semantics><mrow><mi>x</mi><mo>&lt;</mo><mn>2</mn></mrow><annotation encoding=tex>x \\lt 2</annotation></semantics></math> holds.</article>", f"{LONG} So x<2 holds."),
    (f"<article><p>{LONG}<xmp class=code><b>if</b> a &amp;&amp; b:\n  <p>x</xmp>After.<p>{LONG}</article>", f"{LONG}\n<b>if</b> a &amp;&amp; b: <p>x\nAfter.\n{LONG}"),
    (f"<article><p>{LONG}<XMP hidden>no</XMP><p>{LONG}<xmp>to the <i>end", f"{LONG}\n{LONG}\nto the <i>end"),
    (f"<article><p>{LONG}<svg><text>no</text></svg><template>no</template><math><mi>y</math> <annotation>yes</annotation>", f"{LONG} y yes"),
])
def test_math_and_xmp(page, want):
    assert html_text.main_text(page) == want


def test_extract(spark):
    rows = spark.createDataFrame([(1, "u", "<p>a", "t"), (1, "u", "<p>a", "t"), (None, None, None, "t")], "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in html_text.extract(rows).collect())
    assert got == [(0, "", "", 0), (1, "u", "a", 1), (1, "u", "a", 1)]
    assert html_text.extract(rows.limit(0)).count() == 0


ODD = ["", None, "it's  we'll\n\n x'd 'sake I'VE ''s", "<|endoftext|> x", "日本 é½²\x85\xa0 \x1c", "   ", "word " * 9000, "z" * 20000, "a\u0301 ɏɐ 😀😀", "\n\n\nend \n"]


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(4)
    texts = ODD + ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext", "|>y", "<|endoftext|><|endoftext|> é½日"] + ["".join(rng.choice("ab zT'sretvlmd 12é\n\t\xa0.!") for _ in range(rng.randrange(80))) for _ in range(300)]
    rows = spark.createDataFrame([(3 * i, t, 1, "s") for i, t in enumerate(texts)], "doc_id long, text string, part int, ids string").repartition(5)
    path = str(tmp_path / "tokens")
    tokens.write(rows, path, public_tokenizers.path("byte_bpe_50k.json"), files=4)
    got = {r.doc_id: r for r in tokens.checksums(tokens.read(spark, path)).collect()}
    start = 0
    for i, t in enumerate(texts):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        r = got[3 * i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t
        start += len(ids)
    none = str(tmp_path / "none")
    tokens.write(rows.limit(0), none, public_tokenizers.path("byte_bpe_50k.json"), files=1)
    assert tokens.read(spark, none).count() == 0


@pytest.mark.parametrize("change", [
    lambda c: c.update(pre_tokenizer={"type": "Sequence", "pretokenizers": [{"type": "Digits", "individual_digits": True}, c["pre_tokenizer"]]}),
    lambda c: c.update(normalizer={"type": "Lowercase"}),
    lambda c: c["added_tokens"].append({"id": 50257, "content": "cat", "single_word": True, "lstrip": False, "rstrip": False, "normalized": True, "special": False}),
    lambda c: c["added_tokens"].append({"id": 50257, "content": "é the", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False}),
    lambda c: c.update(truncation={"direction": "Right", "max_length": 4, "strategy": "LongestFirst", "stride": 0})])
def test_token_ids_of_other_files(tmp_path, change):
    """What pieces cannot show goes through the library, whatever the file."""
    import json

    import pyarrow as pa
    from tokenizers import Tokenizer

    from starloom.llm.textnum import text_column

    config = json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))
    change(config)
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(config, f)
    library = Tokenizer.from_file(path)
    library.no_truncation()
    texts = ["The CAT 123 cats, cat", "é the 4567 é", "", "a <|endoftext|> b cat", "x" * 50 + " 2024"]
    ids, n = tokens.Encoder(path).encode(*text_column(pa.array(texts)))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_file_layout(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text "), F.col("id").cast("string")).alias("text"))
    path = str(tmp_path / "tokens")
    tokens.write(rows, path, public_tokenizers.path("byte_bpe_50k.json"), files=1, layout=tokens.Layout(page_rows=500))
    file = next((tmp_path / "tokens").glob("*.parquet"))
    meta = pq.ParquetFile(file).metadata.row_group(0)
    columns = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and columns["doc_id"].has_column_index
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings


def test_known_pieces_start_anew(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 64)
    e = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    import pyarrow as pa

    from starloom.llm.textnum import text_column
    for k in range(5):
        texts = [f"t{i} u{i * k} it's" for i in range(100)]
        ids, n = e.encode(*text_column(pa.array(texts)))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [x.tolist() for x in e.whole(texts)]


def test_bpe_round_trip(spark, monkeypatch):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoding = bpe.load(ranks, public_tokenizers.PATTERN)
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(None, "a b", "x"), (1, "a b", "x")], "doc_id long, text string, ids string")
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(rows, ranks, public_tokenizers.PATTERN).collect()]

    def want(k, t):
        ids = encoding.encode_ordinary(t or "")
        return k, len(ids), reference.sha(np.array(ids, "<u4").tobytes()), reference.sha((t or "").encode())

    assert sorted(got, key=str) == sorted([want(i, t) for i, t in enumerate(ODD)] + [want(None, "a b"), want(1, "a b")], key=str)
    assert bpe.round_trip(rows.limit(0), ranks, public_tokenizers.PATTERN).count() == 0
    rng = random.Random(1)
    for _ in range(200):
        t = "".join(rng.choice("ab 1.'s\n\té ") for _ in range(300))
        cut = bpe.pieces(t, 20)
        assert "".join(cut) == t and [i for p in cut for i in encoding.encode_ordinary(p)] == encoding.encode_ordinary(t)


def chats(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat.format_chats(frame.withColumn("parts", chat.text_part(F.col("text"))))


def test_chat_round_trip(spark):
    odd = r"\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", odd), (-7, 1, "assistant", odd), (1, 2, "assistant", "b\\l\\\\h<#"), (1, 1, "us:\ner", None), (1, 0, "system", "é\n</turn>\n### x:\n"),
            (2, 0, None, "x"), (3, None, "assistant", ""), (3, 1, "assistant", "t" * 50000), (3, 1, "assistant", "t" * 50000), (None, 0, "assistant", "n")]
    got = {r.conv_id: r for r in chat.digests(chats(spark, rows)).collect()}
    for conv in (-7, 1, 2, 3, None):
        own = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv))
        learned = "".join(x for _, r, x in own if r == "assistant")
        g = got[conv]
        assert (g.n_turns, g.turns_sha256) == (len(own), reference.sha("".join(f"{r}\n{x}\n" for _, r, x in own).encode()))
        assert (g.loss_chars, g.loss_sha256) == (len(learned), reference.sha(learned.encode()))
    assert chat.digests(chats(spark, [])).count() == 0


def test_chat_parts(spark):
    part = chat.PART
    rows = spark.sql(f"""select 1L conv_id, 0L turn, 'user' role, cast(array(
        named_struct('kind','text','text','see <','ref',null,'width',null,'height',null,'millis',null,'pages',null),
        named_struct('kind','image','text',null,'ref','a.png','width',29,'height',14,'millis',null,'pages',null),
        named_struct('kind','audio','text',null,'ref','b.wav','width',null,'height',null,'millis',90,'pages',null), null,
        named_struct('kind','document','text',null,'ref','c.pdf','width',null,'height',null,'millis',null,'pages',3),
        named_struct('kind','vid<eo','text',null,'ref','d','width',null,'height',null,'millis',null,'pages',null)) as array<{part}>) parts
        union all select 1L, 1L, 'assistant', cast(null as array<{part}>)""")
    r = chat.format_chats(rows).collect()[0]
    assert r.formatted == "### user:\nsee \\l<image 0.1><audio 0.2><document 0.3><vid\\leo 0.4></turn>\n### assistant:\n</turn>\n"
    assert [(a.turn, a.place, a.kind, a.ref, a.tokens) for a in r.attachments] == [
        (0, 1, "image", "a.png", 3), (0, 2, "audio", "b.wav", 3), (0, 3, "document", "c.pdf", 768), (0, 4, "vid<eo", "d", 0)]
    assert r.mask == []


def test_chat_is_native(spark):
    frame = chat.digests(chats(spark, [(1, 0, "assistant", "x")]))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("block, short", [(None, 256), (8, 256), (40, 7)])
def test_embeddings(spark, monkeypatch, block, short):
    monkeypatch.setattr(embed_join, "SHORT", short)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(20, 12))
    rows = [(i, (base[i % 20] + 0.25 * rng.normal(size=12)).tolist()) for i in range(150)]
    rows += [(200, None), (201, [0.0] * 12), (202, [float("nan")] * 12), (203, [1.0, None] + [0.0] * 10), (204, [float("inf")] + [1.0] * 11), (205, []), (206, [1.0, 2.0]), (207, [2.0, 4.0]),
             (208, rows[3][1]), (209, [x * 1e200 for x in rows[3][1]])]
    frame = spark.createDataFrame([(i, v, i, "x") for i, v in rows], "vec_id long, embedding array<double>, id long, links string").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_join.near_duplicates(frame, block=block).collect()}
    scaled = [(i, [x / 1e200 for x in v] if i == 209 else v) for i, v in rows]
    want = reference.cosine_components(scaled, 0.9)
    assert got == {k: (n, c, k == c) for k, (n, c) in want.items()}
    assert max(n for n, _ in want.values()) > 3


def test_embeddings_odd_tables(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embed_join.near_duplicates(frame).count() == 0
    frame = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None)], "vec_id long, embedding array<float>")
    got = sorted((r.vec_id or 0, r.n_links, r.kept) for r in embed_join.near_duplicates(frame).collect())
    assert got == [(0, 0, False), (1, 0, True), (2, 0, True)]


def table_of(kind, n, dim=24):
    """Unit vectors all over the sphere, or in tight groups, some of them copies."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(n if kind == "random" else 20, dim))
    base /= np.linalg.norm(base, axis=1)[:, None]
    x = base + 0.004 * rng.normal(size=base.shape) if kind == "random" else base[np.sort(rng.integers(0, 20, n))] + 0.004 * rng.normal(size=(n, dim))
    x[n // 2:n // 2 + n // 10] = x[0]
    return x.astype(np.float32)


@pytest.mark.parametrize("kind", ["clustered", "random"])
def test_embedding_blocks_that_are_skipped(spark, monkeypatch, kind):
    """The links are exact, and boxes leave out most block pairs of clustered vectors."""
    monkeypatch.setattr(embed_join, "SHORT", 30)
    n, threshold = 2400, 0.9
    x = table_of(kind, n)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    want = (u @ u.T >= threshold).sum(1) - 1
    got = {r.vec_id: r.n_links for r in embed_join.near_duplicates(frame, threshold=threshold, block=100).collect()}
    assert [got[i] for i in range(n)] == want.tolist()
    good = embed_join.usable(frame, "vec_id", "embedding")
    basis = embed_join.principal(good, x.shape[1], 16)
    epsilon = (2 - 2 * threshold) ** 0.5
    _, pairs, blocks = embed_join.blocks_and_pairs(good, x.shape[1], epsilon, 100, basis)
    all_pairs = blocks * (blocks + 1) // 2
    skipped = 1 - pairs.count() / all_pairs
    count, _, left_out = embed_join.link_counts(u, None, threshold, basis)
    assert count.tolist() == want.tolist()
    print(f"{kind}: {skipped:.2f} of {all_pairs} block pairs skipped, {left_out:.2f} of the pairs in one block of table order")
    assert kind == "random" or (skipped > 0.5 and left_out > 0.3)


def test_embedding_links_at_the_threshold():
    """Pairs that single precision cannot decide."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 16))
    u = x / np.linalg.norm(x, axis=1)[:, None]
    threshold = float(np.sort((u[:150] @ u[150:].T).ravel())[-40])  # one pair lies exactly on it
    exact = np.array([[(a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())) for b in x[150:]] for a in x[:150]])
    count, label, _ = embed_join.link_counts(x[:150], x[150:], threshold, np.eye(16)[:, :4])
    link = exact >= threshold
    assert count.tolist() == link.sum(1).tolist() + link.sum(0).tolist() and 30 < link.sum() < 50
    union = reference.Union()
    for i, j in zip(*np.nonzero(link)):
        union.join(int(i), int(j) + 150)
    assert label.tolist() == [union.find(i) for i in range(300)]
