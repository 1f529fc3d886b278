"""Jaccard join of documents on word n-grams by prefix filters under several global orders.

A document's set holds the 64-bit hashes of its distinct n-grams. Documents with equal sets form
a class, and one set of each class goes on. Two sets of sizes a and b with Jaccard similarity t or more share at least
t * max(a, b) elements, so under any global order of the elements their prefixes share some. Three orders
filter the pairs, one after the other:

* by hash: prefixes that must share several elements. How many sets hold an element in this prefix
  is counted, and a set with too few elements that others hold leaves. The rest fetch their
  whole sets, and all their elements are counted: again a set leaves if too few are held by others;
* by that count, rare ones first: the prefixes must share one element;
* by the count's power of two, then another hash: they must share one under this order too.

A pair must pass them all before it is verified on the whole sets. Under the second order, sets
that share an element are tied to the smallest of them, and the connected components are groups;
no pair is listed. In a group of up to ``GROUP`` sets, one task finds the pairs that pass the
second and third order and verifies them. A larger group, or one with more than ``ELEMENTS`` elements, is cut into chunks that meet the same filters
against a bounded number of pivot sets at a time: whoever links with a linked pivot needs no
further look, and rounds go on until every set outside the group's largest component has
been a pivot. So no link between components is lost, and work grows with the group, not with its pairs.

Defined results for odd input: a text without words, empty or null, has an empty set, and is a
component of its own; with fewer words than an n-gram, the whole sequence is the one element;
documents with one id are one component; a null id has a null component; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import by_key, components
from .forest import roots
from .memory import tidy_batches, tidy_group
from .storage import discard, stored
from .textnum import Roller, byte_values, chunks, text_column, word_bounds

GROUP = 512
CHUNK = 512
PIVOTS = 1024
ELEMENTS = 1 << 22  # of a group's or a chunk's sets, for one task


@dataclass(frozen=True)
class Measure:
    """n-grams of ``words`` words; a link at a Jaccard similarity of ``percent`` / 100 or more."""

    words: int = 5
    percent: int = 80

    def shared(self, n):
        """Elements that a set of n must share with any partner."""
        return (self.percent * n + 99) // 100

    def extra(self, n):
        """Elements that the prefixes under the first order must share, for a set of n and a larger partner."""
        return np.minimum(((100 - self.percent) * n + 199) // 200 + 1, self.shared(n))

    def prefix(self, n):
        return n - self.shared(n) + self.extra(n)

    def least(self, n):
        """Elements that the prefixes must share with any partner, smaller ones included."""
        return self.extra(self.shared(n))


def sets_of(data: np.ndarray, offsets: np.ndarray, words: int):
    """The sorted distinct n-gram hashes of each row."""
    upper = np.arange(256, dtype=np.uint8)
    upper[65:91] += 32
    data = upper[data]
    _, start, end, row = word_bounds(data, offsets)
    grams = Roller(Roller(byte_values()[data]).hash(start, end))
    first = np.searchsorted(row, np.arange(len(offsets) - 1), "left")
    last = np.append(first[1:], len(start))
    for a, b in zip(first.tolist(), last.tolist()):
        if a == b:
            yield np.empty(0, np.uint64)
        elif b - a <= words:
            yield grams.hash(np.array([a]), np.array([b]))
        else:
            at = np.arange(a, b - words + 1)
            yield np.unique(grams.hash(at, at + words))


def sketches(docs: DataFrame, measure: Measure, id_col: str, text_col: str) -> DataFrame:
    """(id, n, digest, prefix): size and digest of each document's set, and its prefix under the first order."""

    def run(batches):
        for batch in batches:
            data, offsets = text_column(batch.column(1))
            for a, b in chunks(offsets):
                n, digest, prefix = [], [], []
                for s in sets_of(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], measure.words):
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    prefix.append(s[:int(measure.prefix(len(s)))].view(np.int64) if len(s) else s.view(np.int64))
                ends = np.concatenate([[0], np.cumsum([len(p) for p in prefix])])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(prefix)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), lists],
                                                 names=["id", "n", "digest", "prefix"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy_batches(run), "id long, n long, digest binary, prefix array<long>")


def _whole(measure: Measure, name: str, n: Column) -> Column:
    """``Measure.shared`` and ``Measure.least`` as columns."""
    shared = F.floor((F.lit(measure.percent) * n + 99) / 100).cast("long")
    if name == "shared":
        return shared
    return F.least(F.floor((F.lit(100 - measure.percent) * shared + 199) / 200).cast("long") + 1, _whole(measure, "shared", shared))


def held_by_others(sets: DataFrame, tokens: str, least: Column) -> DataFrame:
    """(id, n, held array<struct<df, token>>): the sets with ``least`` or more tokens that other sets hold too, and these tokens."""
    each = sets.select("id", "n", F.explode(tokens).alias("token"))
    counts = by_key(each, "token", F.count(F.lit(1)), "df").where("df > 1")
    held = each.join(counts, "token").groupBy("id", "n").agg(F.collect_list(F.struct("df", "token")).alias("held"))
    return held.where(F.size("held") >= least)


def prefixed(sets: DataFrame, measure: Measure) -> DataFrame:
    """(id, rare, mixed): prefixes of whole sets (id, n, elements) under the second and third order.

    Elements that no other set holds come first under both; the rest of a prefix is listed.
    """
    shared = _whole(measure, "shared", F.col("n"))
    left = (F.size("held") - shared + 1).cast("int")

    def prefix(first, salt: int) -> Column:
        ordered = F.array_sort(F.transform("held", lambda h: F.struct(first(h["df"]).alias("f"), F.xxhash64(F.lit(salt), h["token"]).alias("h"), h["token"].alias("token"))))
        return F.transform(F.slice(ordered, F.lit(1), left), lambda h: h["token"])

    rare, mixed = prefix(lambda df: df, 1), prefix(lambda df: F.floor(F.log2(df)).cast("long"), 2)
    return held_by_others(sets, "elements", shared).select("id", rare.alias("rare"), mixed.alias("mixed"))


def grouped(sets: DataFrame) -> DataFrame:
    """``sets`` with the group that each belongs to under the second order; sets alone in theirs are left out."""
    tokens = sets.select("id", F.explode("rare").alias("token"))
    least = by_key(tokens, "token", F.min("id"), "b")
    ties = tokens.join(least, "token").where("id <> b").select(F.col("id").alias("a"), "b")
    return sets.join(components(ties, "rare").withColumnRenamed("component", "group"), "id")


def overlaps(x: list[np.ndarray], y: list[np.ndarray], columns: int = 1 << 13) -> np.ndarray:
    """Sizes of all intersections of sorted distinct sets, from matrix products over slices of the elements.

    Of a list with itself, sizes off the diagonal only.
    """
    flat_x, flat_y = np.concatenate(x) if x else np.empty(0, np.uint64), np.concatenate(y) if y else np.empty(0, np.uint64)
    row_x, row_y = np.repeat(np.arange(len(x)), [len(s) for s in x]), np.repeat(np.arange(len(y)), [len(s) for s in y])
    if x is y:  # what one set holds alone counts for nothing beside the diagonal
        common, times = np.unique(flat_x, return_counts=True)
        common = common[times > 1]
    else:
        common = np.intersect1d(flat_x, flat_y)
    out = np.zeros((len(x), len(y)), np.int64)
    if not len(common):
        return out

    def places(flat, row):
        at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
        hit = common[at] == flat
        order = np.argsort(at[hit], kind="stable")
        return at[hit][order], row[hit][order]

    (at_x, row_x), (at_y, row_y) = places(flat_x, row_x), places(flat_y, row_y)
    for a in range(0, len(common), columns):
        size = min(columns, len(common) - a)
        mx, my = np.zeros((len(x), size), np.float32), np.zeros((len(y), size), np.float32)
        for m, at, row in ((mx, at_x, row_x), (my, at_y, row_y)):
            s, e = np.searchsorted(at, [a, a + size])
            m[row[s:e], at[s:e] - a] = 1
        out += np.rint(mx @ my.T).astype(np.int64)
    return out


def linked(sizes_x: np.ndarray, sizes_y: np.ndarray, inter: np.ndarray, percent: int) -> np.ndarray:
    return 100 * inter >= percent * (sizes_x[:, None] + sizes_y[None, :] - inter)


def whole_sets(docs: DataFrame, wanted: DataFrame, measure: Measure, id_col: str, text_col: str) -> DataFrame:
    """``wanted`` (doc, digest, ...) with ``elements``: the whole set of a document of that id with the set's digest."""
    names = wanted.columns
    schema = ", ".join(f"{c} {wanted.schema[c].dataType.simpleString()}" for c in names) + ", elements array<long>"

    def run(batches):
        for batch in batches:
            data, offsets = text_column(batch.column(batch.schema.get_field_index("text")))
            for a, b in chunks(offsets):
                part = batch.slice(a, b - a)
                sets = list(sets_of(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], measure.words))
                same = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d for s, d in zip(sets, part.column("digest").to_pylist())], pa.bool_())
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
                out = [part.column(c) for c in names] + [lists]
                yield pa.RecordBatch.from_arrays(out, names=[*names, "elements"]).filter(same)

    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return texts.join(wanted, "doc").mapInArrow(tidy_batches(run), schema)


def _sets(column) -> list[np.ndarray]:
    """Lists of hashes as sorted unsigned arrays."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at, flat = np.asarray(column.offsets), column.values.to_numpy().view(np.uint64)
    return [np.sort(flat[a:b]) for a, b in zip(at[:-1], at[1:])]


def links_of(x: dict, y: dict, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of x and y that link: those that share elements under both later orders, verified on the whole sets."""
    passes = (overlaps(x["rare"], y["rare"]) > 0) & (overlaps(x["mixed"], y["mixed"]) > 0)
    if x is y:
        np.fill_diagonal(passes, False)
    i, j = np.flatnonzero(passes.any(1)), np.flatnonzero(passes.any(0))
    left = [x["elements"][k] for k in i]
    right = left if x is y else [y["elements"][k] for k in j]
    n, m = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    p, q = np.nonzero(linked(n, m, overlaps(left, right), percent) & passes[np.ix_(i, j)]) if len(i) else (i, j)
    return i[p], j[q]


def _columns(table) -> dict:
    return {c: _sets(table.column(c)) for c in ("rare", "mixed", "elements")}


def verified(members: DataFrame, measure: Measure) -> DataFrame:
    """Edges (a, b) that span the links inside each group of ``members`` (group, id, rare, mixed, elements)."""
    percent = measure.percent

    def run(table):
        ids = table.column("id").to_numpy()
        own = _columns(table)
        root = roots(len(ids), *links_of(own, own, percent))
        on = np.flatnonzero(root != np.arange(len(ids)))
        return pa.table({"a": ids[on], "b": ids[root[on]]})

    return members.select("group", "id", "rare", "mixed", "elements").groupBy("group").applyInArrow(tidy_group(run), "a long, b long")


def against_pivots(members: DataFrame, pivots: DataFrame, measure: Measure) -> DataFrame:
    """Edges that span the links between ``members`` (group, chunk, id and sets) and the pivots (group, id and sets)."""
    percent = measure.percent

    def run(table):
        pivot = table.column("pivot").to_numpy(zero_copy_only=False).astype(bool)
        ids = table.column("id").to_numpy()
        m, p = np.flatnonzero(~pivot), np.flatnonzero(pivot)
        i, j = links_of(_columns(table.take(pa.array(m))), _columns(table.take(pa.array(p))), percent)
        every, place = np.unique(ids, return_inverse=True)
        root = roots(len(every), place[m[i]], place[p[j]])
        on = np.flatnonzero(root != np.arange(len(every)))
        return pa.table({"a": every[on], "b": every[root[on]]})

    names = ["group", "chunk", "id", "rare", "mixed", "elements"]
    chunks_of = members.groupBy("group").agg(F.max("chunks").alias("chunks"))
    # dealt out again before a pivot is copied for each chunk, so that no task writes the copies of a whole group
    sent = pivots.join(chunks_of, "group").repartition("group", "id").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    sent = sent.select(*names, F.lit(True).alias("pivot"))
    rows = members.select(*names, F.lit(False).alias("pivot")).unionByName(sent)
    return rows.groupBy("group", "chunk").applyInArrow(tidy_group(run), "a long, b long")


def by_pivots(members: DataFrame, measure: Measure) -> DataFrame:
    """Edges that span the links inside groups too large for one task; rounds until no link can be missing."""
    spark = members.sparkSession
    members = members.withColumn("chunks", F.greatest(F.ceil(F.col("size") / CHUNK), F.ceil(F.col("total") / ELEMENTS)).cast("long"))
    members = stored(members.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks"))), "large-groups")
    edges = spark.createDataFrame([], "a long, b long")
    asked, turn = spark.createDataFrame([], "id long"), 0
    while True:
        label = components(edges, "pivot-labels")
        state = members.select("group", "id").join(label, "id", "left").join(asked.withColumn("asked", F.lit(True)), "id", "left")
        state = stored(state.withColumn("component", F.coalesce("component", "id")), "pivot-state")
        sizes = state.groupBy("group", "component").agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.groupBy("group").agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
        waiting = state.join(largest, "group").where((F.col("component") != F.col("largest")) & F.col("asked").isNull())
        # about PIVOTS of a group's waiting sets, in another random order each round; the first is always among them
        waiting = waiting.withColumn("order", F.xxhash64(F.lit(turn), "id"))
        most = waiting.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("order").alias("first"))
        share = F.lit(PIVOTS) / F.col("n")
        chosen = waiting.join(most, "group").where((F.col("order") / 2.0**64 + 0.5 <= share) | (F.col("order") == F.col("first")))
        chosen = stored(chosen.select("group", "id"), "pivots")
        if chosen.isEmpty():
            return edges
        pivots = members.select("group", "id", "rare", "mixed", "elements").join(chosen, ["group", "id"])
        edges = edges.unionByName(stored(against_pivots(members, pivots, measure), "pivot-edges"))
        asked, turn = asked.unionByName(chosen.select("id")), turn + 1


def join(docs: DataFrame, measure: Measure = Measure(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_shingles, component_id) of every row of ``docs``."""
    sketched = stored(sketches(docs, measure, id_col, text_col), "sketches")
    # classes are numbered, whatever their digests; doc is a class's smallest document
    classed = sketched.where("n > 0 and id is not null").groupBy("digest", "n").agg(F.min("id").alias("doc"), F.first("prefix").alias("prefix"))
    classed = stored(classed.withColumn("id", F.monotonically_increasing_id()), "classes")
    seen = stored(sketched.select("id", "n", "digest"), "sizes")
    discard(sketched)  # the prefixes are read once: they need no place while whole sets are compared
    some = held_by_others(classed, "prefix", _whole(measure, "least", F.col("n"))).select("id")
    some = stored(some.join(classed.select("id", "doc", "digest", "n"), "id"), "survivors")
    classes = stored(classed.select("id", "doc", "digest", "n"), "class-ids")
    discard(classed)
    full = seen.where("n > 0 and id is not null")
    sets = stored(whole_sets(docs, some, measure, id_col, text_col).select("id", "n", "elements").dropDuplicates(["id"]), "sets")
    groups = stored(grouped(stored(prefixed(sets, measure), "prefixes")), "groups")
    sizes = groups.join(sets.select("id", "n"), "id").groupBy("group").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"))
    members = stored(groups.join(sizes, "group").join(sets.select("id", "elements"), "id"), "members")
    small = (F.col("size") <= GROUP) & (F.col("total") <= ELEMENTS)
    edges = verified(members.where(small), measure)
    large = members.where(~small)
    if not large.isEmpty():
        edges = edges.unionByName(by_pivots(large, measure))
    # one id with different texts is one document with several sets
    several = full.groupBy("id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).where("least <> most")
    same = full.select(F.col("id").alias("doc"), "digest").join(several.select(F.col("id").alias("doc"), "least"), "doc").select("digest", "least").distinct()
    same = same.join(classes.select("digest", F.col("id").alias("a")), "digest").join(classes.select(F.col("digest").alias("least"), F.col("id").alias("b")), "least")
    edges = edges.unionByName(same.select("a", "b"))
    links = components(edges, "links").withColumnRenamed("component", "tie")
    place = classes.select("digest", "id", "doc").join(links, "id", "left").withColumn("tie", F.coalesce("tie", "id"))
    place = place.join(by_key(place, "tie", F.min("doc"), "component"), "tie").select("digest", "component")
    return (seen.select("id", "n", "digest").join(place, "digest", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))).alias("component_id")))


def one_of_each(docs: DataFrame, measure: Measure = Measure(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component: those whose id is the component's smallest."""
    found = join(docs, measure, id_col, text_col).where((F.col(id_col) != F.col("component_id")) & (F.col("n_shingles") > 0)).select(id_col).distinct()
    return docs.join(found, id_col, "left_anti")
