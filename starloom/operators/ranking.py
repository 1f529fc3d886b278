"""Exact global ordering operators that stay distributed, at every size.

``global_rank`` numbers rows 1..N in a total order with one range shuffle: Spark
range-partitions and sorts the rows, they are staged with their partition number
and their place in it, and the sizes of the partitions before (one row per
partition) turn that place into the rank. No window, no row limit, no special
case for small inputs.

``cut_keys`` finds the keys at given positions of an order without numbering the
rows for good: callers that only need to know on which side of a few positions a
row lies compare it with a handful of literals, and their rows are not shuffled.
``counted_cut_keys`` does so without sorting anything, for keys that are whole numbers,
decimals or dates: rows are counted in equal bins of a key's range, the bin of each position is
divided into bins again, and so on; all positions of all orders go through one pass a round.

The last sort key must be unique, so that the order is total. Sort keys must be
non-NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stage import materialize

OrderSpec = Sequence[tuple[str, bool]]  # (column, ascending)

_PART, _PLACE = "_part", "_place"


def _order_cols(order: OrderSpec) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in order]


def _placed(df: DataFrame, order: OrderSpec, label: str) -> tuple[DataFrame, list[tuple[int, int]], int]:
    """``df`` staged in order with partition and 0-based place, the first 0-based rank of each
    partition, and the row count."""
    keys = _order_cols(order)
    low_bits = F.lit((1 << 33) - 1)  # monotonically_increasing_id counts within a partition in its low 33 bits
    ordered = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
               .select("*", F.spark_partition_id().alias(_PART),
                       F.monotonically_increasing_id().bitwiseAND(low_bits).alias(_PLACE)))
    staged = materialize(ordered, label)
    firsts, n = [], 0
    for part, size in sorted(staged.groupBy(_PART).agg(F.count(F.lit(1)).alias("n")).collect()):
        firsts.append((part, n))
        n += size
    return staged, firsts, n


def global_rank(df: DataFrame, order: OrderSpec, out: str = "rank") -> tuple[DataFrame, int]:
    """Add ``out`` = 1-based position of each row in ``order``; return (frame, row count)."""
    staged, firsts, n = _placed(df, order, "ranked")
    first = df.sparkSession.createDataFrame(firsts or [(0, 0)], f"{_PART} int, _first long")
    ranked = staged.join(F.broadcast(first), _PART)   # one row per partition
    return ranked.select(*df.columns, (F.col("_first") + F.col(_PLACE) + 1).cast("long").alias(out)), n


def cut_keys(df: DataFrame, order: OrderSpec, positions: Sequence[int]) -> list[tuple]:
    """The sort keys at the given 1-based positions of ``order`` (positions beyond the rows are left out)."""
    names = [c for c, _ in order]
    staged, firsts, n = _placed(df.select(*names), order, "cuts")
    found = {}
    for position in {p for p in positions if 1 <= p <= n}:
        part, first = max((f, p) for p, f in firsts if f < position)[::-1]
        row = staged.where((F.col(_PART) == part) & (F.col(_PLACE) == position - 1 - first)).first()
        found[position] = tuple(row[c] for c in names)
    return [found[p] for p in positions if p in found]


# Bins of a range in one round; the driver gets at most that many rows for each position that is still open.
BINS = 4096


def _whole(column: str, kind: T.DataType) -> Column:
    """The column as a whole number in the same order."""
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    if isinstance(kind, T.DecimalType):
        return (F.col(column) * F.lit(10 ** kind.scale)).cast("decimal(38,0)")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    raise TypeError(f"{column}: {kind.simpleString()} has no bins")


def _back(whole: int, kind: T.DataType):
    if isinstance(kind, T.DecimalType):
        return Decimal(whole).scaleb(-kind.scale)
    if isinstance(kind, T.DateType):
        return T.DateType().fromInternal(whole)
    return whole


def _literal(whole: int) -> Column:
    return F.lit(whole if abs(whole) < 1 << 62 else Decimal(whole))


@dataclass
class _Cut:
    """A position that is looked for: the ``place``-th row (from 0) of those that have the ``fixed`` values in the
    first columns of the order and lie in ``low`` … ``high`` of the next one."""

    order: int
    place: int
    low: int = 0
    high: int = 0
    fixed: list[int] = field(default_factory=list)

    def range(self) -> tuple:
        return self.order, tuple(self.fixed), self.low, self.high


def counted_cut_keys(df: DataFrame, orders: Sequence[OrderSpec], positions: Sequence[int]) -> list[list[tuple]]:
    """For each order its sort keys at the given 1-based positions (those beyond the rows are left out).

    ``df`` is read once a round, so it should be stored; a round is one aggregation that combines before it
    shuffles a row for each bin. Rounds grow with the logarithm of the keys' ranges, not with the rows.
    """
    columns = list(dict.fromkeys((c, asc) for order in orders for c, asc in order))
    kinds = {c: df.schema[c].dataType for c, _ in columns}
    plain = df.select(*[(_whole(c, kinds[c]) * F.lit(1 if asc else -1)).alias(f"c{k}") for k, (c, asc) in enumerate(columns)])
    ends = plain.agg(F.count(F.lit(1)).alias("n"), *[f(f"c{k}").alias(f"{name}{k}") for k in range(len(columns)) for name, f in (("low", F.min), ("high", F.max))]).first()
    if not ends.n:
        return [[] for _ in orders]
    span = [(int(ends[f"low{k}"]), int(ends[f"high{k}"])) for k in range(len(columns))]
    # from 0 on, in 64 bits where the range allows
    shifted = plain.select(*[(F.col(f"c{k}") - _literal(low)).cast("long" if high - low < 1 << 62 else "decimal(38,0)").alias(f"c{k}") for k, (low, high) in enumerate(span)])
    at = [[columns.index((c, asc)) for c, asc in order] for order in orders]
    cuts = [_Cut(o, p - 1) for o in range(len(orders)) for p in positions if 1 <= p <= ends.n]

    def opened(cut: _Cut) -> _Cut:
        """At the next column of its order, over that column's whole range."""
        if len(cut.fixed) < len(at[cut.order]):
            low, high = span[at[cut.order][len(cut.fixed)]]
            cut.low, cut.high = 0, high - low
        return cut

    for cut in cuts:
        opened(cut)
    while todo := [c for c in cuts if len(c.fixed) < len(at[c.order])]:
        ranges = list(dict.fromkeys(c.range() for c in todo))
        width = [-(-(high - low + 1) // BINS) for _, _, low, high in ranges]
        bins = []
        for k, (o, fixed, low, high) in enumerate(ranges):
            names = [f"c{j}" for j in at[o]]
            here = F.col(names[len(fixed)]).between(_literal(low), _literal(high))
            for name, value in zip(names, fixed):
                here &= F.col(name) == _literal(value)
            value = F.col(names[len(fixed)])
            bins.append(F.when(here, F.struct(F.lit(k).alias("range"), F.expr(f"({names[len(fixed)]} - {low}) div {width[k]}").alias("bin"), value.cast("decimal(38,0)").alias("value"))))
        counted = (shifted.select(F.explode(F.array_compact(F.array(*bins))).alias("b")).groupBy("b.range", "b.bin")
                   .agg(F.count(F.lit(1)).alias("n"), F.min("b.value").alias("low"), F.max("b.value").alias("high")))
        found: list[list] = [[] for _ in ranges]
        for r in counted.collect():
            found[r.range].append((r.bin, r.n, int(r.low), int(r.high)))
        for cut in todo:
            for _, n, low, high in sorted(found[ranges.index(cut.range())]):
                if cut.place < n:
                    break
                cut.place -= n
            if low < high:
                cut.low, cut.high = low, high
            else:
                cut.fixed.append(low)
                opened(cut)
    keys: list[list[tuple]] = [[] for _ in orders]
    for cut in cuts:
        values = [(v + span[j][0]) * (1 if columns[j][1] else -1) for v, j in zip(cut.fixed, at[cut.order])]
        keys[cut.order].append(tuple(_back(v, kinds[c]) for v, (c, _) in zip(values, orders[cut.order])))
    return keys


def after(order: OrderSpec, key: Sequence) -> Column:
    """True for rows that come after ``key`` in ``order``."""
    expr = F.lit(False)
    for (name, asc), value in reversed(list(zip(order, key))):
        c, v = F.col(name), F.lit(value)
        expr = ((c > v) if asc else (c < v)) | ((c == v) & expr)
    return expr


def dense_key(df: DataFrame, order_col: str, out: str) -> DataFrame:
    """Surrogate key 1..N in ascending ``order_col`` (unique), placed first."""
    ranked, _ = global_rank(df, [(order_col, True)], out=out)
    return ranked.select(out, *df.columns)


def keep_first(df: DataFrame, key: str | Column, order_col: str) -> DataFrame:
    """Keep, per ``key`` value, the row with the smallest ``order_col`` (unique).

    Only (key, order_col) is aggregated — hash-based, with partial aggregation before the
    shuffle — and the rows are found again by ``order_col``. NULL keys form one group.
    """
    key_col = F.col(key) if isinstance(key, str) else key
    first = df.groupBy(key_col.alias("_k")).agg(F.min(order_col).alias("_first")).select("_first")
    return df.join(first, F.col(order_col) == F.col("_first"), "left_semi")
