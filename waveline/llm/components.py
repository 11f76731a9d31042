"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waveline.llm.common import checkpoint


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to its smallest neighbour (itself included)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Sums are stored before they are joined back: a join of two plain shuffles is split where a
    # hub is hot, one whose side still aggregates isn't.
    least = checkpoint(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them. After a large star a
    node's smaller neighbours are few, so its sum isn't stored."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def joined_components(known: DataFrame, more: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of the graph of ``known`` components and ``more`` edges, which are few:
    components are nodes of a smaller graph."""
    ends = checkpoint(more.select(F.col(a).alias("a"), F.col(b).alias("b")))
    for c in "ab":
        of = known.select(F.col("node").alias(c), F.col("component").alias(f"_{c}"))
        ends = ends.join(of, c, "left").withColumn(f"_{c}", F.coalesce(f"_{c}", c))
    merged = checkpoint(connected_components(ends, "_a", "_b"))
    nodes = known.unionByName(ends.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(known, "node", "left_anti").select("node", F.col("node").alias("component")))
    to = merged.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    return nodes.join(to, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge, component the smallest node reachable.

    Nodes are longs. Loops, repeated edges and either direction are fine; edges with a null end
    are ignored; no edges give no rows. A round costs shuffles of the edges only; joins on a hub
    are plain equi-joins, which adaptive execution splits. Rounds end when the edges stay the
    same, after O(log^2 n) of them; each is checkpointed, so lost executors repeat one round.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    now = checkpoint(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(u.alias("u"), v.alias("v")).distinct())
    state = F.struct(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").bitwiseAND(0xFFFFFFFF)))
    before = now.agg(state.alias("s")).head()[0]
    while before[0]:
        now = checkpoint(_small_star(checkpoint(_large_star(now))))
        after = now.agg(state.alias("s")).head()[0]
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
