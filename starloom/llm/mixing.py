"""Mixing sources to target weights by temperature.

Source weights are the token shares to the power of an exponent, normalised. The exponent is the
smallest (flattest mixture) in [0, 1] that keeps to the repetition limit or reaches the target
entropy from above; entropy falls and the need for repetition falls too as it grows, so an interval search finds it.
Each round is one aggregate over the source table for many exponents at once, so the sources are
never gathered on the driver.

A source with weight w has a quota of w x budget tokens: whole passes over its documents, then a
part of one more. Its documents lie in blocks in a seeded random order, in every pass; for the part, blocks
are taken whole in that order, and the block that crosses the quota gives documents, in a random order
of their own, until the quota is met. The order of the mixture is (pass, block, place), where the
blocks of all sources are shuffled with one another; rows carry it, and who writes a stream sorts by it. So a source's plan is three numbers, and a document knows
from its own hash how often it is shown.

Texts are read once to count their tokens; from there on one narrow row a document is worked with. The block that
crosses a quota is searched by sums over ranges of places first, so no task sorts more than a millionth of a
source. Texts are shuffled only if the plan, one row a source, is too large for Spark to broadcast.

Defined results for odd input: a null source is the source with the empty name; a null or empty
text has no tokens and is shown with its block; a source without tokens keeps one pass over its
documents if every document is to be shown and has weight 0 otherwise; repeated rows share a place
in the order and go together; an empty table gives an empty result; columns of ``docs`` are
carried whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import discard, stored

BLOCKS = 1024
CANDIDATES = 32
ROUNDS = 6
RANGE_BITS = 10  # places of a block are summed in so many binary digits of their range first


@dataclass(frozen=True)
class Target:
    """``repetition``: most passes over any source. ``entropy``: of the weights, as a share of the
    largest possible. ``budget``: tokens to show, ``budget_share``: the same as a multiple of all tokens; with
    neither every document is shown at least once."""

    repetition: float | None = None
    entropy: float | None = None
    budget: float | None = None
    seed: int = 7
    budget_share: float | None = None


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _placed(docs: DataFrame, source_col: str, id_col: str, seed: int) -> DataFrame:
    """``docs`` as a struct ``row`` with source, the order of its block and its own order in it."""
    block = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(BLOCKS))
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), source.alias("source"),
                       F.xxhash64(F.lit(seed + 1), source, block).alias("block"), F.xxhash64(F.lit(seed + 2), F.col(id_col)).alias("place"))


def _measures(sources: DataFrame, exponents: list[float], budget: float | None) -> list[tuple[float, float]]:
    """(entropy as a share of the largest, most passes over a source) for each exponent."""
    s = sources.where("tokens > 0").withColumn("p", F.col("tokens") / F.col("total"))
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, a in enumerate(exponents):
        w = F.pow(F.col("p"), F.lit(a))
        aggs += [F.sum(w).alias(f"z{i}"), F.sum(w * F.ln("p") * F.lit(a)).alias(f"l{i}"), F.max(F.pow(F.col("p"), F.lit(a - 1))).alias(f"hi{i}"),
                 F.min(F.pow(F.col("p"), F.lit(a - 1))).alias(f"lo{i}"), F.first("total").alias(f"t{i}")]
    r = s.agg(*aggs).first()
    out = []
    import math

    for i in range(len(exponents)):
        if not r["n"]:
            out.append((1.0, 1.0))
            continue
        entropy = math.log(r[f"z{i}"]) - r[f"l{i}"] / r[f"z{i}"]
        passes = r[f"hi{i}"] / r[f"lo{i}"] if budget is None else budget * r[f"hi{i}"] / r[f"z{i}"] / r[f"t{i}"]
        out.append((entropy / math.log(r["n"]) if r["n"] > 1 else 1.0, passes))
    return out


def exponent(sources: DataFrame, target: Target) -> float:
    """The smallest exponent in [0, 1] within the target; 1 (the given shares) if none is."""

    def within(m: tuple[float, float]) -> bool:
        entropy, passes = m
        return (target.entropy is None or entropy <= target.entropy + 1e-12) and (target.repetition is None or passes <= target.repetition + 1e-12)

    low, high = 0.0, 1.0
    if target.entropy is None and target.repetition is None:
        return 1.0
    for _ in range(ROUNDS):
        step = (high - low) / CANDIDATES
        tries = [low + step * k for k in range(CANDIDATES)] + [high]
        good = [within(m) for m in _measures(sources, tries, target.budget)]
        if not any(good):
            return 1.0
        k = good.index(True)
        if k == 0:
            return tries[0]
        low, high = tries[k - 1], tries[k]
    return high


def plan(docs: DataFrame, target: Target, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per source: tokens, weight, quota, passes (whole ones), edge_block and edge_place (how far the last one goes)."""
    placed = _placed(docs, source_col, id_col, target.seed)
    slim = stored(placed.select("source", "block", "place", n_tokens(F.col(f"row.`{text_col}`")).alias("t")), "mix-tokens")
    blocks = stored(slim.groupBy("source", "block").agg(F.sum("t").alias("tokens")), "mix-blocks")
    total = blocks.agg(F.sum("tokens")).first()[0] or 0
    if target.budget_share is not None:
        target = replace(target, budget=target.budget_share * total, budget_share=None)
    sources = stored(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")).withColumn("total", F.lit(float(total))), "mix-sources")
    a = exponent(sources, target)
    weighed = sources.withColumn("w", F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.col("total"), F.lit(a))).otherwise(F.lit(0.0)))
    norm = weighed.agg(F.sum("w"), F.max(F.when(F.col("w") > 0, F.col("tokens") / F.col("w")))).first()
    z, most = (norm[0] or 1.0), (norm[1] or 0.0)
    budget = float(target.budget) if target.budget is not None else most * z
    quota = F.when(F.col("tokens") > 0, F.round(F.lit(budget) * F.col("w") / F.lit(z))).otherwise(F.lit(0)).cast("long")
    sources = weighed.select("source", "tokens", (F.col("w") / F.lit(z)).alias("weight"), F.lit(a).alias("exponent"), quota.alias("quota"))
    none = F.lit(1 if target.budget is None else 0)
    sources = sources.withColumn("passes", F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(none).cast("long"))
    sources = sources.withColumn("rest", F.when(F.col("tokens") > 0, F.col("quota") - F.col("passes") * F.col("tokens")).otherwise(F.lit(0)))
    edge = _crossing(blocks.withColumnRenamed("tokens", "t").join(sources.select("source", F.col("rest").alias("need")), "source"), "block")
    edge = stored(edge.withColumnRenamed("at", "edge_block"), "mix-edges")  # one row a source, as the next two
    inner = slim.join(edge, "source").where(F.col("block") == F.col("edge_block")).select("source", "edge_block", "need", "place", "t")
    inner = inner.withColumn("range", F.shiftright("place", 64 - RANGE_BITS))
    ranges = stored(_crossing(inner.groupBy("source", "need", "range").agg(F.sum("t").alias("t")), "range"), "mix-ranges")
    last = inner.drop("need").join(ranges.withColumnRenamed("at", "edge_range"), "source").where(F.col("range") == F.col("edge_range"))
    places = _crossing(last.groupBy("source", "need", "place").agg(F.sum("t").alias("t")), "place")
    ends = edge.select("source", "edge_block").join(places.select("source", F.col("at").alias("edge_place")), "source")
    out = stored(sources.join(ends, "source", "left"), "mix-plan")
    for frame in (slim, blocks, edge, ranges):
        discard(frame)
    return out


def _crossing(parts: DataFrame, order: str) -> DataFrame:
    """(source, at, need): of the ``parts`` (source, ``order``, t, need) of a source in ``order``, the one whose tokens bring
    the sum to ``need`` or more, and what is needed of it."""
    so_far = F.sum("t").over(Window.partitionBy("source").orderBy(order))
    cross = parts.withColumn("before", so_far - F.col("t")).where((F.col("before") < F.col("need")) & (F.col("before") + F.col("t") >= F.col("need")))
    first = cross.groupBy("source").agg(F.min(F.struct(F.col(order).alias("at"), (F.col("need") - F.col("before")).alias("need"))).alias("first"))
    return first.select("source", "first.at", "first.need")


def copies(placed: DataFrame, sources: DataFrame) -> DataFrame:
    """``placed`` with the number of times each row is shown."""
    more = (F.col("block") < F.col("edge_block")) | ((F.col("block") == F.col("edge_block")) & (F.col("place") <= F.col("edge_place")))
    joined = placed.join(sources.select("source", "weight", "passes", "edge_block", "edge_place"), "source")
    return joined.withColumn("shown", (F.col("passes") + F.coalesce(more, F.lit(False)).cast("long")).cast("int"))


def mix(docs: DataFrame, target: Target, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, source, weight, pass, block, place): each row of ``docs`` once for each pass that shows it.

    (pass, block, place) is the order of the mixture: the pass, the block's rank among the permuted
    blocks of all sources (a hash), and the place in the block. The last pass of a source ends where its quota is met.
    """
    sources = plan(docs, target, source_col, id_col, text_col)
    shown = copies(_placed(docs, source_col, id_col, target.seed), sources).where("shown > 0")
    return shown.select("row", "source", "weight", F.explode(F.sequence(F.lit(1), F.col("shown"))).alias("pass"), "block", "place")


def mixed_rows(docs: DataFrame, target: Target, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their own columns only, as often as the mixture shows them; not in its order, which only ``mix`` has."""
    return mix(docs, target, source_col, id_col, text_col).select("row.*")
