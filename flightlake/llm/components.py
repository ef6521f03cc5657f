"""Connected components of an edge list, as DataFrame jobs.

Alternating large-star and small-star steps: every node hands its larger
neighbours to its smallest one, then its smaller ones. Each step is one
grouping (with partial minima) and one join on the node; a hub's edges are
spread by the join's skew handling. The edge list is written to the shared
folder after each round and never grows beyond its first size (both ways).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v -> every larger neighbour of a node points to the
    smallest in the node's neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u > v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v -> the smaller neighbours of a node, and itself, point
    to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and a checksum of the edge set (two numbers)."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.shiftright(h, 20))).first())


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """(node, component): each node that an edge names and the smallest node
    that it is linked with. Loops, repeated edges and both directions may
    occur; edges with a null end are ignored. Nodes of any ordered type."""
    pairs = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"),
                         (F.col(src).isNotNull() & F.col(dst).isNotNull()).alias("ok")).filter("ok").drop("ok")
    nodes = pairs.filter("u = v").select("u")
    current = materialise(pairs.filter("u > v").distinct(), "edges")
    seen = _fingerprint(current)
    for _ in range(max_rounds):
        current = materialise(_small_star(_large_star(current)), "edges")
        before, seen = seen, _fingerprint(current)
        if seen == before:  # stars only: a further round changes nothing
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    labels = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    alone = nodes.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return labels.union(roots).union(alone).groupBy("node").agg(F.min("component").alias("component"))
