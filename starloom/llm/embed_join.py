"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors with cosine c lie sqrt(2 - 2c) apart, so a cosine threshold is a distance epsilon.
Vectors are projected on the leading principal directions of all rows, cut into grid cells there
and sorted by cell. The sorted sequence is dealt into blocks with bounding boxes; a tree over
the sequence is joined with itself from the root down, interval by interval, and an interval
pair is left as soon as its boxes are more than epsilon apart. The length of what the projection leaves
out is one more coordinate of the boxes, as it bounds distances too. What remains are block pairs; a block sends to
a pair only the rows within epsilon of the other block's box.

In a task the recursion goes on: the blocks' rows are cut into short sequences with boxes of their own, on more
directions; for what is near, the cosine is bounded by the product of the projections and the rests' lengths, and only rows
and columns with a pair above the threshold are multiplied whole, in single precision. Pairs within its error of the
threshold are decided in double precision.

A block pair returns the number of links of each vector and a spanning star of each group that
it has linked, at most one edge for each vector: links are counted slice by slice, so large groups of
copies are never listed in pairs. A block holds up to ``BLOCK_BYTES`` of vectors, so up to ``BLOCKS`` of these every
vector is sent a fixed number of times; beyond, the number of times grows with what the boxes leave.

Defined results for odd input: a vector that is null, empty, zero or has a null or non-finite
component links with nothing, nor does one with a null id; vectors link only with those of their
own length; rows with one id are vectors of their own, and each of them reports the links of all;
an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .forest import roots
from .memory import tidy_batches, tidy_group
from .storage import stored

BLOCK_BYTES = 32 << 20
BLOCKS = 6
LEAST_ROWS = 2048
SHORT = 256  # rows of a short sequence in a task
FANOUT = 8
SORT_DIMS = 8
BOX_DIMS = 16
BOUND_DIMS = 32
PCA_COORDINATES = 256


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, vec): finite non-zero vectors as the bytes of their float32 or float64 components."""
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                ids, dims, vecs = [], [], []
                for i, v in zip(part.column(0).to_pylist(), part.column(1)):
                    x = v.values
                    if i is None or x is None or not len(x) or x.null_count:
                        continue
                    x = x.to_numpy(zero_copy_only=False)
                    if np.isfinite(x).all() and x.any():
                        ids.append(i)
                        dims.append(len(x))
                        vecs.append(x.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())], names=["id", "dim", "vec"])

    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("v")).mapInArrow(tidy_batches(run), "id long, dim int, vec binary")


def doubles(raw: bytes, rows: int, dim: int) -> np.ndarray:
    """Packed vectors as doubles, scaled to a largest component of 1."""
    x = np.frombuffer(raw, np.float32 if len(raw) == 4 * rows * dim else np.float64).reshape(rows, dim).astype(np.float64)
    return x / np.abs(x).max(1, initial=0)[:, None]


def matrix(column, dim: int) -> np.ndarray:
    return doubles(b"".join(column.to_pylist()), len(column), dim)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def with_rest(u: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Coordinates of unit vectors on the directions (of their first coordinates), and the length of the rest: distances
    of these are at most those of the vectors, and their products at least."""
    at = u[:, :len(basis)] @ basis
    return np.hstack([at, np.sqrt(np.maximum(0, 1 - (at * at).sum(1)))[:, None]])


def principal(vectors: DataFrame, dim: int, n: int) -> np.ndarray:
    """The ``n`` leading principal directions of all unit vectors (of their first coordinates, if
    there are more than PCA_COORDINATES). The driver gets one number for each pair of coordinates."""
    d = min(dim, PCA_COORDINATES)

    def run(batches):
        total = np.zeros((d + 1, d + 1))
        for batch in batches:
            u = unit(matrix(batch.column(0), dim))[:, :d] if batch.num_rows else np.zeros((0, d))
            u = np.hstack([u, np.ones((len(u), 1))])
            total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"])

    sums = vectors.select("vec").mapInArrow(tidy_batches(run), "sums array<double>").select(F.posexplode("sums").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x"))
    total = np.zeros((d + 1) ** 2)
    for k, x in sums.collect():
        total[k] = x
    total = total.reshape(d + 1, d + 1)
    mean = total[d, :d] / total[d, d]
    _, basis = np.linalg.eigh(total[:d, :d] / total[d, d] - np.outer(mean, mean))
    return np.ascontiguousarray(basis[:, ::-1][:, :n])


def ordered_blocks(vectors: DataFrame, dim: int, epsilon: float, block: int, rows: int, basis: np.ndarray) -> DataFrame:
    """Blocks (part, seq, ids, vecs, lo, hi) of the sequence in epsilon grid order; boxes have a coordinate more than directions."""
    n = basis.shape[1] + 1
    sort_dims = min(n - 1, SORT_DIMS)

    def cells(batches):
        for batch in batches:
            at = with_rest(unit(matrix(batch.column(1), dim)), basis) if batch.num_rows else np.zeros((0, n))
            cell = np.floor(at[:, :sort_dims] / (epsilon / 4)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.FixedSizeListArray.from_arrays(pa.array(cell.ravel()), sort_dims).cast(pa.list_(pa.int32())),
                 pa.FixedSizeListArray.from_arrays(pa.array(at.ravel()), n).cast(pa.list_(pa.float64()))], names=["id", "vec", "cell", "at"])

    def cut(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        kept, held = [], 0

        def blocks(final: bool):
            nonlocal kept, held, seq
            table = pa.Table.from_batches(kept).combine_chunks()
            while held >= 2 * block or (final and held):
                size = block if held >= 2 * block else (held if held <= block else (held + 1) // 2)
                head, table, held = table.slice(0, size), table.slice(size), held - size
                at = np.array(head.column("at").to_pylist())
                vecs = b"".join(head.column("vec").to_pylist())
                ids = np.array(head.column("id").to_pylist(), np.int64).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([ids], pa.binary()), pa.array([vecs], pa.binary()),
                     pa.array([at.min(0).tolist()], pa.list_(pa.float64())), pa.array([at.max(0).tolist()], pa.list_(pa.float64()))],
                    names=["part", "seq", "ids", "vecs", "lo", "hi"])
                seq += 1
            kept = table.to_batches()

        for batch in batches:
            if batch.num_rows:
                kept.append(batch)
                held += batch.num_rows
                if held >= 2 * block:
                    yield from blocks(False)
        if held:
            yield from blocks(True)

    parts = max(1, math.ceil(rows / (4 * block)))
    placed = vectors.select("id", "vec").mapInArrow(tidy_batches(cells), "id long, vec binary, cell array<int>, at array<double>")
    return (placed.repartitionByRange(parts, "cell", "id").sortWithinPartitions("cell", "id")
            .mapInArrow(tidy_batches(cut), "part long, seq long, ids binary, vecs binary, lo array<double>, hi array<double>"))


def _apart(n: int) -> Column:
    """Squared distance of the boxes of a and b."""
    gaps = [F.greatest(F.lit(0.0), F.col("a_lo")[i] - F.col("b_hi")[i], F.col("b_lo")[i] - F.col("a_hi")[i]) for i in range(n)]
    total = F.lit(0.0)
    for g in gaps:
        total = total + g * g
    return total


def near_pairs(boxes: DataFrame, n: int, epsilon: float, top: int) -> DataFrame:
    """Block pairs (a <= b) whose boxes are within epsilon, found from the root of the interval tree down.

    ``boxes`` is (node, lo, hi) with consecutive node numbers; ``top`` is the largest.
    """
    levels = [boxes]
    while top >= FANOUT:
        top //= FANOUT
        bounds = [F.min(F.col("lo")[i]).alias(f"l{i}") for i in range(n)] + [F.max(F.col("hi")[i]).alias(f"h{i}") for i in range(n)]
        up = levels[-1].groupBy(F.floor(F.col("node") / FANOUT).cast("long").alias("node")).agg(*bounds)
        levels.append(up.select("node", F.array(*[f"l{i}" for i in range(n)]).alias("lo"), F.array(*[f"h{i}" for i in range(n)]).alias("hi")))
    pairs = boxes.sparkSession.range(1).select(F.col("id").alias("pa"), F.col("id").alias("pb"))
    for level in reversed(levels):
        up = F.floor(F.col("node") / FANOUT).cast("long")
        a = level.select(up.alias("pa"), F.col("node").alias("a"), F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"))
        b = level.select(up.alias("pb"), F.col("node").alias("b"), F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"))
        pairs = pairs.join(a, "pa").join(b, "pb")
        pairs = pairs.where((F.col("a") <= F.col("b")) & (_apart(n) <= F.lit(epsilon * epsilon + 1e-9))).select(F.col("a").alias("pa"), F.col("b").alias("pb"))
    return pairs.select(F.col("pa").alias("a"), F.col("pb").alias("b"))


def _boxes(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest coordinates of each short sequence."""
    first = np.arange(0, len(at), SHORT)
    return np.minimum.reduceat(at, first), np.maximum.reduceat(at, first)


def link_counts(x: np.ndarray, y: np.ndarray | None, threshold: float, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Links of each row of x and then of y with the other's rows (y None: of x among themselves), the smallest row that
    each is linked to over these links, and the share of pairs that the boxes of short sequences left out."""
    ux = unit(x)
    uy = ux if y is None else unit(y)
    shift = 0 if y is None else len(x)
    total = len(ux) + (0 if y is None else len(uy))
    count, label = np.zeros(total, np.int64), np.arange(total)
    slack, reach = 4e-6 + 1.2e-7 * x.shape[1], 2 - 2 * threshold + 1e-6
    ax = with_rest(ux, basis)
    ay = ax if y is None else with_rest(uy, basis)
    fx, fy, bx, by = (m.astype(np.float32) for m in (ux, uy, ax, ay))
    (low_x, high_x), (low_y, high_y) = _boxes(ax), _boxes(ay)
    left_out = 0
    for k, a in enumerate(range(0, len(ux), SHORT)):
        gap = np.maximum(0, np.maximum(low_y - high_x[k], low_x[k] - high_y))
        near = (gap * gap).sum(1) <= reach
        if y is None:
            near[:k] = False  # compared before
        rows = np.arange(a, min(a + SHORT, len(ux)))
        columns = np.flatnonzero(np.repeat(near, SHORT)[:len(uy)])
        left_out += len(rows) * (len(uy) - len(columns) - (k * SHORT if y is None else 0))
        if not len(columns):
            continue
        may = bx[rows] @ by[columns].T >= threshold - slack
        rows, columns, may = rows[may.any(1)], columns[may.any(0)], may[np.ix_(may.any(1), may.any(0))]
        if not len(rows):
            continue
        cosine = fx[rows] @ fy[columns].T
        link = may & (cosine >= threshold - slack)
        if y is None:
            link &= rows[:, None] < columns[None, :]
        p, q = np.nonzero(link & (cosine < threshold + slack))
        for s in range(0, len(p), 1 << 14):  # decided by their own sums
            i, j = p[s:s + (1 << 14)], q[s:s + (1 << 14)]
            u, v = x[rows[i]], (x if y is None else y)[columns[j]]
            link[i, j] = (u * v).sum(1) / (np.sqrt((u * u).sum(1)) * np.sqrt((v * v).sum(1))) >= threshold
        count[rows] += link.sum(1)
        count[columns + shift] += link.sum(0)
        one, other = label[rows], label[columns + shift]
        p, q = np.nonzero(link & (one[:, None] != other[None, :]))
        if len(p):
            label = roots(total, one[p], other[q])[label]
    pairs = len(ux) * (len(ux) + 1) // 2 if y is None else len(ux) * len(uy)
    return count, label, left_out / max(pairs, 1)


def trimmed(sides: DataFrame, dim: int, epsilon: float, basis: np.ndarray) -> DataFrame:
    """``sides`` (a, b, ids, vecs, lo, hi) with only the rows within epsilon of the box lo … hi of the pair's other block."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids = np.frombuffer(batch.column(2)[k].as_py(), np.int64)
                raw = batch.column(3)[k].as_py()
                at = with_rest(unit(doubles(raw, len(ids), dim)), basis)
                gap = np.maximum(0, np.maximum(np.array(batch.column(4)[k].as_py()) - at, at - np.array(batch.column(5)[k].as_py())))
                near = (gap * gap).sum(1) <= epsilon * epsilon + 1e-9
                if near.any():
                    vecs = np.frombuffer(raw, np.uint8).reshape(len(ids), -1)[near].tobytes()
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([ids[near].tobytes()], pa.binary()), pa.array([vecs], pa.binary())],
                                                     names=["a", "b", "ids", "vecs"])

    return sides.mapInArrow(tidy_batches(run), "a long, b long, ids binary, vecs binary")


def block_links(blocks: DataFrame, pairs: DataFrame, dim: int, threshold: float, epsilon: float, boxed: np.ndarray, basis: np.ndarray) -> DataFrame:
    """(id, root, links) for each vector of each block pair that has links there."""

    def run(table):
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        ids = [np.frombuffer(x, np.int64) for x in table.column("ids").to_pylist()]
        vecs = [doubles(x, len(i), dim) for x, i in zip(table.column("vecs").to_pylist(), ids)]
        none = np.empty(0, np.int64)
        if a != b and len(ids) < 2:  # no row of one is near the other's box
            return pa.table({"id": none, "root": none, "links": none})
        count, label, _ = link_counts(vecs[0], vecs[1] if a != b else None, threshold, basis)
        every = np.concatenate(ids)
        on = np.flatnonzero(count)
        by_id, place = np.unique(every[on], return_inverse=True)
        # a row's label is a row that may have no link of its own id before it: tie both
        slot = np.zeros(len(every), np.int64)
        slot[on] = place
        root = roots(len(by_id), place, slot[label[on]])
        return pa.table({"id": by_id, "root": by_id[root], "links": np.bincount(place, count[on], len(by_id)).astype(np.int64)})

    boxes = blocks.select(F.col("node").alias("other"), "lo", "hi")
    a = pairs.select(F.col("a").alias("node"), F.col("b").alias("other"), "a", "b")
    b = pairs.where("a <> b").select(F.col("b").alias("node"), F.col("a").alias("other"), "a", "b")
    sides = a.unionByName(b).join(boxes, "other").join(blocks.select("node", "ids", "vecs"), "node").select("a", "b", "ids", "vecs", "lo", "hi")
    return trimmed(sides, dim, epsilon, boxed).groupBy("a", "b").applyInArrow(tidy_group(run), "id long, root long, links long")


def blocks_and_pairs(vectors: DataFrame, dim: int, epsilon: float, block: int | None, boxed: np.ndarray) -> tuple[DataFrame, DataFrame, int]:
    """(blocks with their numbers, pairs of them that may hold near rows, number of blocks)."""
    rows, width = vectors.agg(F.count(F.lit(1)), F.max(F.octet_length("vec"))).first()
    block = block or max(LEAST_ROWS, min(math.ceil(rows / BLOCKS), BLOCK_BYTES // width))
    cut = stored(ordered_blocks(vectors, dim, epsilon, block, rows, boxed), "blocks")
    offset, offsets = 0, []
    for part, n in sorted(cut.groupBy("part").agg(F.count(F.lit(1))).collect()):  # one row for each partition of the sequence
        offsets.append((part, offset))
        offset += n
    numbered = cut.join(cut.sparkSession.createDataFrame(offsets, "part long, first long"), "part").withColumn("node", F.col("first") + F.col("seq"))
    return numbered, near_pairs(numbered.select("node", "lo", "hi"), boxed.shape[1] + 1, epsilon, offset - 1), offset


def similar(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, block: int | None = None) -> DataFrame:
    """(id, root, links): partial link counts and spanning edges of all pairs with cosine >= threshold."""
    epsilon = math.sqrt(max(0.0, 2 - 2 * threshold))
    good = stored(usable(vectors, id_col, vector_col), "vectors")
    found = None
    for (dim,) in good.select("dim").distinct().orderBy("dim").collect():
        own = good.where(F.col("dim") == dim)
        basis = principal(own, dim, min(dim, BOUND_DIMS))
        boxed = basis[:, :BOX_DIMS]
        numbered, pairs, _ = blocks_and_pairs(own, dim, epsilon, block, boxed)
        links = block_links(numbered, pairs, dim, threshold, epsilon, boxed, basis)
        found = links if found is None else found.unionByName(links)
    return stored(found, "links") if found is not None else good.select("id", F.col("id").alias("root"), F.lit(0).cast("long").alias("links")).limit(0)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, block: int | None = None) -> DataFrame:
    """(``id_col``, n_links, component_id, kept) for every row of ``vectors``."""
    links = similar(vectors, id_col, vector_col, threshold, block)
    n = links.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    ids = vectors.select(F.col(id_col).cast("long").alias("id"))
    out = ids.join(n, "id", "left").join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
