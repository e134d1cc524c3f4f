"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salted_join, stage

MAX_ROUNDS = 60


def _minima(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is linked to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = salted_join(both, _minima(both), ["u"], F.xxhash64("v"), "inner")
    return found.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its lesser neighbours are linked to the least of them."""
    least = _minima(edges)
    found = salted_join(edges, least, ["u"], F.xxhash64("v"), "inner")
    lesser = found.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lesser.unionByName(least.select("u", F.col("m").alias("v")))


def _settled(state: DataFrame) -> bool:
    """Whether the links are stars: every node has one link to a lesser one, or is what others are linked to."""
    ends = state.selectExpr("u as node", "1 as up").unionByName(state.selectExpr("v as node", "0 as up"))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n"))
    return not seen.agg(F.bool_or((F.col("up") > 1) | (F.col("up") > 0) & (F.col("n") > F.col("up")))).first()[0]


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` long pairs to ``(node, root)``, root the least node that can be reached.

    Only nodes with a link to another appear.  Each round is a written table, so lineage stays short and
    a lost executor costs no earlier round.  Nulls and loops are ignored; an empty table gives none.
    The driver sees only whether a round's links are stars.
    """
    a, b = F.col("a"), F.col("b")
    state = edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    state = stage(state, "components")
    for _ in range(MAX_ROUNDS):
        if _settled(state):
            break
        state = stage(_small_star(_large_star(state)).distinct(), "components")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
