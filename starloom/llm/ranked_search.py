"""The best documents for each of a set of query items, by an exact dual-tree search.

A term is a maximal run of letters and digits of ASCII and of anything above it; A-Z count as a-z. With N
documents that have terms, L their terms and n one document's, a term that df documents hold
weighs ``w = floor(1000 ln((2N + 2) / (2df + 1)))``, and tf occurrences of it in a document are
worth ``v = 10^9 tf div (1000 tf + 8m)`` with ``m = 10 + 90nN div L``. A score is the sum of w v over the
item's different terms.

1. Each document's terms that some item has are counted, and written with their counts once; df, N and L
   are sums over these rows.
2. The items make a binary tree, and so do a task's documents, some thousand at a time: each node is
   halved between two unlike members. A node of documents keeps the largest v of each term
   (its coordinate maxima), a node of items the w of each term that one of its items has.
3. A pair of nodes is bounded by the product of its maxima. It is left if the bound is below the
   weakest of its items' k-th best scores so far, and with it all pairs of its documents and items; otherwise both
   sides are opened. What is left of the leaves is scored exactly, all in integers.
4. The k-th best scores of any documents are lower bounds of the final ones. Those of the documents in
   ``SEED_FILES`` of the written files are found first and handed to all tasks; each task then returns at most
   k documents an item.

Items come in blocks of about ``ITEM_BYTES`` of text, each of which is searched in a pass of its
own, so what tasks and driver hold of the items is bounded. Documents stay where they are: only
counts and the best of each task are shuffled.

Defined results for odd input: a null or empty text has no terms, so such a document is never found and such
an item finds nothing; documents without an id count in N, L and df, but are not returned; each row is a
document, also if its id is repeated; each item row is an item of its own, repeated ones
and those without an id too; equal scores go by ascending id; texts of any length are read whole, in pieces cut
between terms; an empty table gives an empty result; only ids and texts are read, so other columns may have any names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .memory import tidy_batches
from .storage import discard, stored

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
PIECE = 1 << 20
ITEM_BYTES = 1 << 20
SEED_FILES = 4
BATCH = 8192
BATCH_ENTRIES = 1 << 21
DOC_LEAF = 64
ITEM_LEAF = 8
EXACT = 1 << 53  # sums of products below it are exact in double precision


def counted(text: bytes | None) -> Counter:
    """Occurrences of each term."""
    found: Counter = Counter()
    text, start = text or b"", 0
    while len(text) - start > PIECE:
        cut = GAP.search(text, start + PIECE)
        if cut is None:
            break
        found.update(TERM.findall(text[start:cut.start()].lower()))
        start = cut.end()
    found.update(TERM.findall(text[start:].lower()))
    return found


@dataclass
class Rows:
    """Sparse rows of (term, value), by ascending term within a row."""

    terms: np.ndarray
    values: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def places(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the entries of the given rows are, and the offsets of these rows among them."""
        size = np.diff(self.offsets)[order]
        offsets = np.concatenate([[0], np.cumsum(size)])
        return np.arange(offsets[-1]) + np.repeat(self.offsets[order] - offsets[:-1], size), offsets

    def take(self, order: np.ndarray) -> "Rows":
        at, offsets = self.places(order)
        return Rows(self.terms[at], self.values[at], offsets)

    def sums(self, dense: np.ndarray) -> np.ndarray:
        """Of each row, the sum of value x dense[term]."""
        total = np.concatenate([[0], np.cumsum(self.values * dense[self.terms])])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def maxima(self, bounds: np.ndarray) -> "Rows":
        """For each range of rows between neighbouring ``bounds``, the largest value of each term."""
        node = np.repeat(np.searchsorted(bounds, np.arange(len(self)), "right") - 1, np.diff(self.offsets))
        order = np.lexsort((self.terms, node))
        t, g = self.terms[order], node[order]
        new = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (g[1:] != g[:-1])])) if len(t) else np.empty(0, np.int64)
        values = np.maximum.reduceat(self.values[order], new) if len(t) else self.values
        return Rows(t[new], values, np.searchsorted(g[new], np.arange(len(bounds))))


def halved(rows: Rows, weight: np.ndarray, leaf: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """An order of the rows, and for each level of a binary tree over it the bounds of its nodes (the root first)."""
    order, levels = np.arange(len(rows)), [np.array([0, len(rows)])]
    dense = np.zeros(len(weight), np.float64)

    def like(members: np.ndarray, pivot: int) -> np.ndarray:
        a, b = rows.offsets[pivot], rows.offsets[pivot + 1]
        dense[rows.terms[a:b]] = weight[rows.terms[a:b]] * rows.values[a:b]
        at, offsets = rows.places(members)
        total = np.concatenate([[0], np.cumsum(weight[rows.terms[at]] * rows.values[at] * dense[rows.terms[at]])])
        dense[rows.terms[a:b]] = 0
        return total[offsets[1:]] - total[offsets[:-1]]

    while np.diff(levels[-1]).max() > leaf:
        bounds = [0]
        for a, b in zip(levels[-1][:-1].tolist(), levels[-1][1:].tolist()):
            members = order[a:b]
            one = members[np.argmin(like(members, int(members[0])))]
            near = like(members, int(one))
            other = members[np.argmin(near)]
            order[a:b] = members[np.argsort(like(members, int(other)) - near, kind="stable")]
            bounds += [(a + b) // 2, b]
        levels.append(np.array(bounds))
    return order, levels


class Items:
    """The tree over a block of items; its last level holds the items themselves."""

    def __init__(self, ids: list, terms: list[np.ndarray], weight: np.ndarray):
        flat = np.concatenate(terms)
        rows = Rows(flat, np.ones(len(flat), np.int64), np.concatenate([[0], np.cumsum([len(t) for t in terms])]))
        order, levels = halved(rows, weight.astype(np.float64), ITEM_LEAF)
        rows = rows.take(order)
        self.ids = [ids[k] for k in order.tolist()]
        self.weight = weight
        self.bounds = [*levels, np.arange(len(rows) + 1)]
        self.levels = [rows.maxima(b) for b in self.bounds]
        for level in self.levels:
            level.values = weight[level.terms]
        # nodes of the next level that each node has: halves, and at the end its items
        self.first = [np.searchsorted(self.bounds[k + 1], b) for k, b in enumerate(self.bounds[:-1])]

    def opened(self, level: int, nodes: np.ndarray) -> np.ndarray:
        first = self.first[level]
        return np.concatenate([np.arange(first[k], first[k + 1]) for k in nodes.tolist()])


class Best:
    """The k best documents of each item so far, and the score and id to beat."""

    def __init__(self, n: int, k: int, score=None, last=None):
        self.k = k
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64))] * n
        self.score = np.zeros(n, np.int64) if score is None else score.copy()
        self.last = np.full(n, np.iinfo(np.int64).max) if last is None else last.copy()

    def offer(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, d = (np.concatenate(x) for x in zip(self.found[item], (scores, ids)))
        keep = np.lexsort((d, -s))[:self.k]
        self.found[item] = s[keep], d[keep]
        if len(keep) == self.k and (s[keep[-1]], -d[keep[-1]]) > (self.score[item], -self.last[item]):
            self.score[item], self.last[item] = s[keep[-1]], d[keep[-1]]


def search_batch(ids: np.ndarray, docs: Rows, items: Items, best: Best) -> tuple[int, int]:
    """Both trees from their roots down. Returns how many pairs of a document and an item were scored, of how many."""
    weight = items.weight
    order, levels = halved(docs, weight.astype(np.float64), DOC_LEAF)
    ids, docs = ids[order], docs.take(order)
    nodes = [docs.maxima(levels[-1])]
    for bounds in reversed(levels[:-1]):
        nodes.append(nodes[-1].maxima(np.arange(0, 2 * len(bounds), 2)))
    nodes.reverse()
    dense = np.zeros(len(weight), np.int64)
    last = len(items.levels) - 1
    scored = 0

    def near(level: int, of: np.ndarray, low_id: int) -> np.ndarray:
        """Item nodes whose bound with the document node in ``dense`` reaches what they need."""
        bound = items.levels[level].take(of).sums(dense)
        if level < last:
            need = np.minimum.reduceat(best.score, items.bounds[level][:-1])[of]
            return of[(bound > 0) & (bound >= need)]
        need, ahead = best.score[of], best.last[of]
        return of[(bound > 0) & ((bound > need) | ((bound == need) & (low_id <= ahead)))]

    def score(a: int, b: int, of: np.ndarray) -> None:
        nonlocal scored
        scored += (b - a) * len(of)
        theirs = items.levels[last].take(of)
        used = np.unique(theirs.terms)
        slot = np.full(len(weight), -1)
        slot[used] = np.arange(len(used))
        part = docs.take(np.arange(a, b))
        at = slot[part.terms]
        on = at >= 0
        row = np.repeat(np.arange(b - a), np.diff(part.offsets))
        worth = np.zeros((b - a, len(used)), np.int64)
        worth[row[on], at[on]] = part.values[on] * weight[part.terms[on]]
        has = np.zeros((len(used), len(of)), np.int64)
        has[slot[theirs.terms], np.repeat(np.arange(len(of)), np.diff(theirs.offsets))] = 1
        if int(worth.sum(1).max()) < EXACT:
            scores = (worth.astype(np.float64) @ has.astype(np.float64)).astype(np.int64)
        else:
            scores = worth @ has
        here = ids[a:b, None]
        beats = (scores > 0) & ((scores > best.score[of]) | ((scores == best.score[of]) & (here <= best.last[of])))
        for k in np.flatnonzero(beats.any(0)).tolist():
            best.offer(int(of[k]), scores[beats[:, k], k], ids[a:b][beats[:, k]])

    def visit(depth: int, k: int, level: int, of: np.ndarray) -> None:
        a, b = int(levels[depth][k]), int(levels[depth][k + 1])
        s, e = nodes[depth].offsets[k], nodes[depth].offsets[k + 1]
        terms = nodes[depth].terms[s:e]
        dense[terms] = nodes[depth].values[s:e]
        low_id = int(ids[a:b].min())
        of = near(level, of, low_id)
        leaf = depth == len(levels) - 1
        while len(of) and level < last:
            of, level = items.opened(level, of), level + 1
            if not leaf:
                break
            of = near(level, of, low_id)
        dense[terms] = 0
        if not len(of):
            return
        if leaf:
            score(a, b, of)
        else:
            visit(depth + 1, 2 * k, level, of)
            visit(depth + 1, 2 * k + 1, level, of)

    visit(0, 0, 0, np.array([0]))
    return scored, len(ids) * len(items.ids)


def term_rows(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, counts) of every document: all its terms, and those of the vocabulary as 32-bit integers."""

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                size, terms, counts = [], [], []
                for text in part.column(1).to_pylist():
                    found = counted(text)
                    known = sorted((vocabulary[t], c) for t, c in found.items() if t in vocabulary)
                    both = np.array(known, np.int32).reshape(-1, 2)
                    size.append(found.total())
                    terms.append(both[:, 0].tobytes())
                    counts.append(both[:, 1].tobytes())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())],
                                                 names=["id", "n", "terms", "counts"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(tidy_batches(run), "id long, n long, terms binary, counts binary")


def document_frequencies(rows: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary: one number a term for the driver."""

    def run(batches):
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            held += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), minlength=n_terms)
        on = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(on, pa.int64()), pa.array(held[on], pa.int64())], names=["term", "df"])

    held = np.zeros(n_terms, np.int64)
    for term, df in rows.select("terms").mapInArrow(tidy_batches(run), "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        held[term] = df
    return held


def _batches(batches, docs_with_terms: int, all_terms: int):
    """(ids, rows of v) of some thousand documents at a time; those without an id or a known term are left out."""
    ids, terms, values, size, held = [], [], [], [], 0

    def full():
        offsets = np.concatenate([[0], np.cumsum(size)])
        return np.array(ids, np.int64), Rows(np.concatenate(terms), np.concatenate(values), offsets)

    for batch in batches:
        for doc, n, t, c in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if doc is None or not t:
                continue
            tf = np.frombuffer(c, np.int32).astype(np.int64)
            m = 10 + 90 * n * docs_with_terms // all_terms
            ids.append(doc)
            terms.append(np.frombuffer(t, np.int32).astype(np.int64))
            values.append(10 ** 9 * tf // (1000 * tf + 8 * m))
            size.append(len(tf))
            held += len(tf)
            if len(ids) >= BATCH or held >= BATCH_ENTRIES:
                yield full()
                ids, terms, values, size, held = [], [], [], [], 0
    if ids:
        yield full()


def _found(rows: DataFrame, items: Items, stats: tuple[int, int], k: int, id_type: str, score=None, last=None) -> DataFrame:
    """(item, item_id, score, doc_id): up to ``k`` documents an item from each task."""

    def run(batches):
        best = Best(len(items.ids), k, score, last)
        for ids, docs in _batches(batches, *stats):
            search_batch(ids, docs, items, best)
        for i, (s, d) in enumerate(best.found):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(s), pa.int64()), pa.array([items.ids[i]] * len(s), kind), pa.array(s), pa.array(d)],
                                                 names=["item", "item_id", "score", "doc_id"])

    kind = {"string": pa.string(), "int": pa.int32()}.get(id_type, pa.int64())
    return rows.mapInArrow(tidy_batches(run), f"item long, item_id {id_type}, score long, doc_id long")


def _best_of(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """With rank: the k best rows of each item."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc()))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", doc_text: str = "text",
           item_id: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 of each item."""
    id_type = items.schema[item_id].dataType.simpleString()
    if id_type not in ("string", "int"):
        id_type = "bigint"
    asked = items.select(F.col(item_id).cast(id_type).alias("id"), F.col(item_text).cast("binary").alias("text"))
    blocks = -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // item_bytes)
    found = docs.sparkSession.createDataFrame([], f"block int, item long, item_id {id_type}, score long, doc_id long")
    for block in range(blocks):  # each holds about item_bytes of text
        mine = sorted(asked.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect(), key=lambda r: (str(r.id), r.text or b""))
        cut = [(r.id, sorted(counted(r.text))) for r in mine]
        cut = [(i, t) for i, t in cut if t]
        vocabulary = {t: j for j, t in enumerate(sorted({t for _, ts in cut for t in ts}))}
        if not cut:
            continue
        rows = stored(term_rows(docs, vocabulary, doc_id, doc_text), "terms")
        n, total = rows.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if n:
            df = document_frequencies(rows, len(vocabulary))
            weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * h + 1))) for h in df.tolist()], np.int64)
            tree = Items([i for i, _ in cut], [np.array([vocabulary[t] for t in ts], np.int64) for _, ts in cut], weight)
            score, last = np.zeros(len(cut), np.int64), np.full(len(cut), np.iinfo(np.int64).max)
            names = sorted(rows.inputFiles())
            seeds = rows.sparkSession.read.schema(rows.schema).parquet(*names[::-(-len(names) // SEED_FILES)])
            kth = _best_of(_found(seeds, tree, (n, total), k, id_type), ["item"], k).where(F.col("rank") == k)
            for r in kth.select("item", F.struct("score", -F.col("doc_id")).alias("least")).collect():  # one row an item
                score[r.item], last[r.item] = r.least[0], -r.least[1]
            part = stored(_found(rows, tree, (n, total), k, id_type, score, last), "best").select(F.lit(block).alias("block"), "*")
            found = found.unionByName(part)
        discard(rows)
    return _best_of(found, ["block", "item"], k).select("item_id", "rank", "doc_id", "score")
