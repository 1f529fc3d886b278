"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stored


def _unsettled(edges: DataFrame) -> bool:
    """Whether a node has two neighbours above it, or one above and one below: the edges are not all stars yet."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e"))
    counts = ends.groupBy("e.id").agg(F.sum("e.up").alias("up"), F.sum("e.down").alias("down"))
    return not counts.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def by_key(rows: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """(``key``, ``name``): an aggregate per key, to be joined with the rows it comes from.

    Grouped by the key in a struct, its rows lie elsewhere than the join wants them. So the join
    shuffles both its sides itself, and only then may Spark split a key that holds many rows;
    an aggregate on the plain key would leave all rows of a key to one task.
    """
    return rows.groupBy(F.struct(F.col(key).alias("k")).alias("s")).agg(value.alias(name)).select(F.col("s.k").alias(key), name)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b); component is the smallest id reachable.

    Each round is two joins on the node with its smallest neighbour, which Spark can split for a
    node with many edges; rounds grow with the logarithm of the longest path, not with its length.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while _unsettled(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = by_key(both, "a", F.min("b"), "m").select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        root = by_key(large, "a", F.min("b"), "m")
        small = large.join(root, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionByName(root.select("a", F.col("m").alias("b"))).distinct(), name)
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
