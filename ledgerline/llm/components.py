"""Connected components by alternating large-star and small-star.

Edges are rows (u, v) of node ids. *Large-star* links each node's larger
neighbours to the smallest node of its neighbourhood; *small-star* links its
smaller neighbours and itself to the smallest of them. Both keep components,
and alternating them ends in stars around each component's smallest node, in
O(log^2 n) rounds. Every step is a map-side combined minimum, a join and a
distinct over written tables, so a hub with a large part of all edges can be
split by the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.storage import materialise

MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialise(both.groupBy("u").agg(F.min("v").alias("m"))
                        .select("u", F.least("u", "m").alias("m")), "least")
    return (both.filter(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = materialise(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    return (edges.join(least, "u").filter(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node points to one other and no node pointed to points."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    odd = (ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
           .filter((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("in") == 1))))
    return odd.limit(1).count() == 0


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest node id reachable, for every node of an
    edge but the components' smallest nodes themselves. Rows with a null end
    or two equal ends link nothing; repeated and reversed edges count once."""
    state = materialise(
        edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .filter(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(u) != F.col(v)))
        .distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _is_stars(state):
            return state.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = materialise(_large_star(state), "edges")
        state = materialise(_small_star(state), "edges")
    raise RuntimeError(f"no stars after {MAX_ROUNDS} rounds")
