"""Whitening of embeddings by the covariance of distinct vectors with multiplicities.

Entries are quantised to whole numbers, ``x = floor(1024 c) + 100000``, so equal vectors can be
grouped exactly. From there on every distinct vector is worked on once, with the number of its
rows as its weight in the fit (or with one, if ``by_count`` is off):

1. vectors are packed into the narrowest integers that hold them, and counted by a grouping that
   combines before it shuffles: a vector in a third of all rows costs each task one row;
2. n, the sums S and then the covariance of the centred vectors, one weighted matrix product a
   batch; the driver gets one number for each coordinate and for each pair of them, nothing that grows with the rows;
3. each distinct vector is projected on the leading eigenvectors, scaled, and joined back to its rows
   by a 256-bit digest; the join's sides are both shuffled by it, so Spark may split a common vector.

Vectors are centred as ``n x - S`` in whole numbers and divided by n once, so no digits are lost.

Defined results for odd input: a vector that is null, empty, holds a null or non-finite entry or one beyond
2**52 / 1024 is left out; vectors of different lengths are fits of their own; components without variance (up to
1e-12 of the trace) have whitened null and no part in identity_error; if all have none, explained and
identity_error are null; a deviation beyond 64 bits is null; rows with one id, or without one, are rows of their own; an
empty table gives an empty result; only the id and the vector are read, so other columns may have any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import tidy_batches
from .storage import discard, stored

STEPS = 1024
SHIFT = 100_000
LARGEST = 2.0 ** 52
NO_VARIANCE = 1e-12
_KINDS = (np.int16, np.int32, np.int64)  # of packed entries, without SHIFT


def packed(x: np.ndarray) -> bytes:
    """The entries less SHIFT in the narrowest integers, and their width at the end."""
    low, high = int(x.min()) - SHIFT, int(x.max()) - SHIFT
    for kind in _KINDS:
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return (x - SHIFT).astype(kind).tobytes() + bytes([np.dtype(kind).itemsize])
    raise AssertionError("entries are below 2**52")


def unpacked(rows: list[bytes], dim: int) -> np.ndarray:
    """Long entries of packed vectors of one length."""
    out = np.empty((len(rows), dim), np.int64)
    width = np.array([r[-1] for r in rows])
    for kind in _KINDS:
        on = np.flatnonzero(width == np.dtype(kind).itemsize)
        if len(on):
            out[on] = np.frombuffer(b"".join(rows[k][:-1] for k in on.tolist()), kind).reshape(-1, dim)
    return out + SHIFT


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, x): usable rows with packed vectors."""

    def run(batches):
        for batch in batches:
            ids, dims, rows = [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                c = v.values
                if c is None or not len(c) or c.null_count:
                    continue
                scaled = c.to_numpy(zero_copy_only=False) * float(STEPS)
                if not (np.abs(scaled) < LARGEST).all():  # also false for what is not a number
                    continue
                rows.append(packed(np.floor(scaled).astype(np.int64) + SHIFT))
                ids.append(i)
                dims.append(len(c))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(rows, pa.binary())], names=["id", "dim", "x"])

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(tidy_batches(run), "id long, dim int, x binary")


def _totals(distinct: DataFrame, columns: list[str], part, size: int, kind) -> np.ndarray:
    """Sum over all batches of ``part(batch)``, ``size`` numbers: added in each task, then by place."""
    spark_kind, arrow = ("long", pa.int64()) if kind is np.int64 else ("double", pa.float64())

    def run(batches):
        total = np.zeros(size, kind)
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                total += part(batch.slice(a, 4096))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(arrow))], names=["sums"])

    sums = distinct.select(*columns).mapInArrow(tidy_batches(run), f"sums array<{spark_kind}>").select(F.posexplode("sums").alias("k", "v"))
    total = np.zeros(size, kind)
    for k, v in sums.groupBy("k").agg(F.sum("v")).collect():
        total[k] = v
    return total


def _centred(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """x - S/n, from whole numbers as long as they fit."""
    if s.dtype == np.int64 and n * int(np.abs(x).max(initial=0)) < 2 ** 62:
        return (n * x - s) / float(n)
    return x.astype(np.float64) - np.array([v / n for v in s.tolist()])


def deviations(x: np.ndarray, n: int, s: np.ndarray) -> list[int | None]:
    """Of each row, the sum of (n x - S)^2, exactly."""
    if not len(x):
        return []
    reach = n * int(np.abs(x).max()) + int(np.abs(s).max())
    if reach < 2 ** 62 and s.dtype == np.int64:
        off = n * x - s
        top = int(np.abs(off).max())
        if top * top * x.shape[1] < 2 ** 63:
            return (off * off).sum(1).tolist()
    exact = [sum((n * a - b) ** 2 for a, b in zip(row, s.tolist())) for row in x.tolist()]
    return [v if v < 2 ** 63 else None for v in exact]


def fit(distinct: DataFrame, dim: int, by_count: bool) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(n, S, eigenvalues, eigenvectors as columns) of the distinct vectors, eigenvalues falling; S as objects if it is beyond 64 bits."""

    def weights(batch) -> np.ndarray:
        count = batch.column(1).to_numpy()
        return count if by_count else np.ones(len(count), np.int64)

    def sums(batch) -> np.ndarray:  # high and low halves apart, so that no sum overflows
        w = weights(batch)
        high, low = np.divmod(unpacked(batch.column(0).to_pylist(), dim), 1 << 26)
        return np.concatenate([(high * w[:, None]).sum(0), (low * w[:, None]).sum(0), [w.sum()]])

    total = _totals(distinct, ["x", "count"], sums, 2 * dim + 1, np.int64).tolist()
    n, exact = total[-1], [(h << 26) + low for h, low in zip(total[:dim], total[dim:2 * dim])]
    s = np.array(exact, np.int64 if all(abs(v) < 2 ** 62 for v in exact) else object)

    def products(batch) -> np.ndarray:
        at = _centred(unpacked(batch.column(0).to_pylist(), dim), n, s)
        return ((at * weights(batch)[:, None]).T @ at).ravel()

    v = _totals(distinct, ["x", "count"], products, dim * dim, np.float64).reshape(dim, dim) / max(n, 1)
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    return n, s, np.maximum(values[::-1], 0), np.ascontiguousarray(vectors[:, ::-1])


def _identity_error(white: DataFrame, live: list[int], weight, n: int) -> float | None:
    """Largest absolute entry of the whitened covariance less the identity, centred before multiplying."""
    if not live:
        return None
    z = [F.col("z")[k] for k in live]
    mean = white.agg(*[(F.sum(c * weight) / n).alias(f"m{k}") for k, c in enumerate(z)]).first()
    off = [c - F.lit(mean[k]) for k, c in enumerate(z)]
    pairs = [(a, b) for a in range(len(z)) for b in range(a + 1)]
    cov = white.agg(*[(F.sum(weight * off[a] * off[b]) / n).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(cov, pairs))


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding", by_count: bool = True) -> DataFrame:
    """(``id_col``, component, n, deviation, whitened, explained, identity_error, multiplicity) of each usable row and
    component up to ``components``. ``by_count`` weighs a distinct vector by its rows, else by one."""
    rows = quantised(vectors, id_col, vector_col)
    counts = rows.groupBy("dim", "x").agg(F.count(F.lit(1)).alias("count"))
    distinct = stored(counts, "distinct-vectors")
    result = None
    for (dim,) in distinct.select("dim").distinct().orderBy("dim").collect():
        mine = distinct.where(F.col("dim") == dim)
        n, s, values, basis = fit(mine, dim, by_count)
        top = min(components, dim)
        trace = float(values.sum())
        live = [k for k in range(top) if trace > 0 and values[k] > NO_VARIANCE * trace]
        scale = np.array([1 / np.sqrt(values[k]) if k in live else np.nan for k in range(top)])
        lead = basis[:, :top] * scale

        def project(batches):
            for batch in batches:
                for a in range(0, batch.num_rows, 4096):
                    part = batch.slice(a, 4096)
                    x = unpacked(part.column(0).to_pylist(), dim)
                    z = _centred(x, n, s) @ lead
                    z = pa.array(z.ravel(), pa.float64(), from_pandas=True)  # not a number: null
                    ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * top)
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(deviations(x, n, s), pa.int64()), pa.ListArray.from_arrays(ends, z)],
                                                     names=["x", "count", "deviation", "z"])

        white = mine.select("x", "count").mapInArrow(tidy_batches(project), "x binary, count long, deviation long, z array<double>")
        white = stored(white.select(F.unhex(F.sha2("x", 256)).alias("key"), "count", "deviation", "z"), "whitened")
        error = _identity_error(white, live, F.col("count") if by_count else F.lit(1), n)
        keyed = rows.where(F.col("dim") == dim).select("id", F.unhex(F.sha2("x", 256)).alias("key"))
        explained = [float(values[k] / trace) if trace > 0 else None for k in range(top)]
        each = keyed.join(white, "key").select("id", "count", "deviation", F.posexplode("z").alias("k", "whitened"))
        share = F.element_at(F.array(*[F.lit(e).cast("double") for e in explained]), F.col("k") + 1)
        out = each.select(F.col("id").alias(id_col), (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                          share.alias("explained"), F.lit(error).cast("double").alias("identity_error"), F.col("count").alias("multiplicity"))
        result = out if result is None else result.unionByName(out)
    if result is None:
        schema = f"`{id_col}` long, component int, n long, deviation long, whitened double, explained double, identity_error double, multiplicity long"
        result = vectors.sparkSession.createDataFrame([], schema)
    discard(distinct)
    return result
