"""URL filters: rules on host and path, and a naive Bayes verdict on segmented names for the rest.

Host and path are cut at everything but letters; concatenated names are then split into words by
Viterbi over a unigram model. The model counts, over all URLs, the sites that use a name as a
whole word (a name's use of itself is not counted), plus the words of the labelled seeds. The
subdomains and endings of one site count once. A concatenation of other words is no word, however
often it is counted: names made of seed words, and names that are rarer than their parts (than the
geometric mean of their counts, as Koehn and Knight split compounds); two parts need three letters
or more. Which pieces of a name are words is found by a join of its substrings with the counts, so
no dictionary has to fit in a task. Multinomial naive Bayes, fitted on the seeds, scores the words.

Defined results for odd input: a null URL or one without ``://`` has an empty host and path, no
rule and the verdict of the class prior; endless names are split like others, with words of at
most ``MAX_WORD`` characters; repeated rows are judged one by one; a null id is carried; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Container, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .memory import tidy_batches

MAX_WORD = 24
# Decisions that a task remembers on which names are concatenations.
REMEMBERED = 100_000
# The ending of a host: one label, or two as in co.uk; a port goes with it.
ENDING = r"(?:\.(?:ac|co|com|edu|gov|net|org)\.[a-z]{2}|\.[^.]*)\.?(?::\d*)?$"
# Log odds that a verdict of block needs: a block word seeded twice passes alone, one seeded once (mail, download, girls)
# needs another. Words of one letter say nothing.
CLEAR = 0.9
# Labelled names the classifier is fitted on; a parameter, to be replaced by a site's own list.
SEEDS: tuple[tuple[str, str], ...] = tuple(
    [(f"{n}.example", "block") for n in (
        "cheap-pills", "buy-pills-online", "casino-win", "win-big-casino", "free-bets", "online-bets", "spam-farm", "link-farm", "adult-x", "adult-cams",
        "ads-track", "track-ads-click", "free-casino-bonus", "payday-loan", "fast-loan-cash", "lottery-win", "poker-bonus", "cheap-replica-watches",
        "hot-singles", "click-bait", "crack-keygen", "warez-download", "diet-pills", "sex-cams", "spam-mail", "popup-ads", "escort-girls", "jackpot-slots",
        "poker-lottery", "jackpot-payday", "sex-escort", "warez-keygen", "slots-replica")]
    + [(f"{n}.example", "allow") for n in (
        "news/world", "blog/article", "wiki/page", "docs/manual", "library/books", "university/research", "museum/history", "science/journal", "weather/report",
        "city/council", "school/lessons", "health/clinic", "recipes/kitchen", "travel/guide", "music/review", "sports/results", "garden/plants", "maps/routes",
        "forum/questions", "photo/gallery", "code/projects", "film/archive", "radio/program", "local/market", "theatre/tickets", "bakery/bread", "festival/concert", "hospital/doctors",
        "essex/sussex", "middlesex/county", "uploads/downloads", "threads/heads", "roads/alphabets")])


def host_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3)).otherwise(F.lit(""))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def names(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}+"), 0)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, say in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest is asked first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(say)).otherwise(verdict)
    return rule, verdict


def fit(seeds: Sequence[tuple[str, str]]) -> tuple[dict[str, float], float, Counter]:
    """(log odds of block for each word, log odds of the prior, word counts) from labelled names."""
    counts: dict[str, Counter] = {"block": Counter(), "allow": Counter()}
    for text, label in seeds:
        word = ""
        for ch in text.lower() + " ":
            if ch.isalpha():
                word += ch
            else:
                counts[label][word] += len(word) > 1
                word = ""
    every = counts["block"] + counts["allow"]  # drops what was not counted
    size = {k: sum(c.values()) + len(every) for k, c in counts.items()}
    odds = {w: math.log((counts["block"][w] + 1) / size["block"]) - math.log((counts["allow"][w] + 1) / size["allow"]) for w in every}
    labels = Counter(label for _, label in seeds)
    return odds, math.log(max(labels["block"], 1) / max(labels["allow"], 1)), every


def viterbi(name: str, known: dict[tuple[int, int], float], total: float) -> list[str]:
    """The likeliest split: known pieces (start, length) -> count; others cost more the longer they are."""
    best, back = [0.0] + [math.inf] * len(name), [0] * (len(name) + 1)
    log_total = math.log(total)
    for end in range(1, len(name) + 1):
        for start in range(max(0, end - MAX_WORD), end):
            n = known.get((start, end - start), 0.0)
            cost = best[start] + (log_total - math.log(n) if n > 0 else log_total + 2.3 * (end - start))
            if cost < best[end]:
                best[end], back[end] = cost, start
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def parts_of(name: str, known: dict[tuple[int, int], float], total: float, words: Container[str] | None = None) -> list[str]:
    """The likeliest split into known pieces of two letters or more, two of them of three; empty if there is none. ``words``: the pieces allowed."""
    size, log_total = len(name), math.log(total)
    # best[end][k]: (cost, start, k before) with k pieces of three letters or more, two standing for all above
    best: list[list[tuple[float, int, int] | None]] = [[(0.0, 0, 0), None, None]] + [[None] * 3 for _ in range(size)]
    for end in range(2, size + 1):
        for start in range(max(0, end - MAX_WORD), end - 1):
            n = known.get((start, end - start), 0.0)
            if n <= 0 or end - start == size or (words is not None and name[start:end] not in words):
                continue
            for k, before in enumerate(best[start]):
                if before is not None:
                    to, cost = min(2, k + (end - start > 2)), before[0] + log_total - math.log(n)
                    if best[end][to] is None or cost < best[end][to][0]:
                        best[end][to] = (cost, start, k)
    out, end, k = [], size, 2
    while end and best[end][k] is not None:
        _, start, k = best[end][k]
        out.append(name[start:end])
        end = start
    return out[::-1]


def concatenation(name: str, own: float, known: dict[tuple[int, int], float], total: float, seeds: Container[str]) -> list[str]:
    """The words that ``name``, counted ``own`` times, is made of; empty if it is a word itself."""
    if name in seeds:
        return []
    if made := parts_of(name, known, total, seeds):
        return made
    made, at, logs = parts_of(name, known, total), 0, 0.0
    for part in made:
        logs += math.log(known[at, len(part)])
        at += len(part)
    return made if made and logs / len(made) >= math.log(max(own, 1.0)) else []


def segment(name: str, pieces: Sequence[dict], total: float, seeds: Container[str], seen: dict[str, list[str]]) -> list[str]:
    """The words of ``name``. ``pieces``: its substrings that are counted (start from 1, length, n); ``seen``: decisions on other names."""
    if name in seeds:
        return [name]
    known: dict[tuple[int, int], float] = {}
    for p in sorted(pieces, key=lambda p: p["length"]):  # what a piece is made of is known before the piece
        at, size = p["start"] - 1, p["length"]
        piece = name[at:at + size]
        if piece not in seen:
            if len(seen) >= REMEMBERED:
                seen.clear()
            inner = {(a - at, n): known[a, n] for a in range(at, at + size) for n in range(2, at + size - a + 1) if (a, n) in known}
            seen[piece] = concatenation(piece, p["n"], inner, total, seeds)
        if not seen[piece]:
            known[at, size] = p["n"]
        elif size == len(name):
            return seen[piece]
    whole = (0, len(name))
    if whole in known:  # its own use says nothing on whether it is one word
        known[whole] -= 1.0
    return viterbi(name, known, total)


def uses(urls: DataFrame) -> DataFrame:
    """(name, place), distinct: a name in a host is used by its label and those behind it but for the ending, one in a path by the host."""
    host = F.col("host")
    labels = urls.select("host").distinct().select(F.split(host, r"\.").alias("labels"), F.size(F.split(F.regexp_replace(host, ENDING, ""), r"\.")).alias("m"))
    labels = labels.select("labels", "m", F.posexplode("labels").alias("at", "label"))
    size = F.greatest(F.lit(0), F.least(F.lit(4), F.col("m") - F.col("at")))
    site = F.concat_ws(".", F.slice("labels", F.col("at") + 1, size))
    in_host = labels.select(F.explode(names(F.col("label"))).alias("name"), F.concat(F.lit("site "), site).alias("place"))
    in_path = urls.select(F.explode(names(F.col("path"))).alias("name"), F.concat(F.lit("path "), host).alias("place"))
    return in_host.unionByName(in_path).distinct()


def segmented(urls: DataFrame, seeds: Sequence[tuple[str, str]] = SEEDS) -> DataFrame:
    """(name, words, score) of each distinct name in ``urls`` (host, path)."""
    odds, _, seed_counts = fit(seeds)
    spark = urls.sparkSession
    own = uses(urls).groupBy("name").agg(F.count(F.lit(1)).cast("double").alias("hosts"))
    prior = spark.createDataFrame([(w, float(n)) for w, n in sorted(seed_counts.items())], "name string, hosts double")
    words = own.unionByName(prior).where(F.length("name") <= MAX_WORD).groupBy("name").agg(F.sum("hosts").alias("n"))
    total = 10.0 + (own.unionByName(prior).agg(F.sum("hosts")).first()[0] or 0.0)

    n = F.length("name")
    cut = own.select("name", n.alias("size"), F.explode(F.sequence(F.lit(1), n)).alias("start"))
    cut = cut.select("name", "size", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.col("size") - F.col("start") + 1))).alias("length"))
    cut = cut.select("name", "start", "length", F.substr("name", F.col("start"), F.col("length")).alias("piece"))
    found = cut.join(words.select(F.col("name").alias("piece"), "n"), "piece")
    known = found.groupBy("name").agg(F.collect_list(F.struct("start", "length", "n")).alias("known"))

    def run(batches):
        seen: dict[str, list[str]] = {}
        for batch in batches:
            got = batch.to_pydict()
            split = [segment(name, pieces or (), total, odds, seen) for name, pieces in zip(got["name"], got["known"])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(got["name"], pa.string()), pa.array(split, pa.list_(pa.string())), pa.array([sum(odds.get(w, 0.0) for w in s) for s in split], pa.float64())],
                names=["name", "words", "score"])

    return own.select("name").join(known, "name", "left").mapInArrow(tidy_batches(run), "name string, words array<string>, score double")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], seeds: Sequence[tuple[str, str]] = SEEDS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(``id_col``, host, path, rule, score, verdict) of every row. ``rules``: (host/path, allow or block)."""
    prior = fit(seeds)[1]
    parts = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    urls = parts.select("host", "path").distinct()
    scores = segmented(urls, seeds).where("score <> 0").select("name", F.col("score").alias("s"))
    used = urls.select("host", "path", F.explode(F.concat(names(F.col("host")), names(F.col("path")))).alias("name"))
    url_scores = used.join(scores, "name").groupBy("host", "path").agg(F.sum("s").alias("s"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    scored = parts.join(url_scores, ["host", "path"], "left")
    score = F.lit(prior) + F.coalesce("s", F.lit(0.0))
    return scored.select(id_col, "host", "path", rule.alias("rule"), F.round(score, 9).alias("score"),
                         F.coalesce(said, F.when(score > CLEAR, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
