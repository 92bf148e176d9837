"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.tables import Workspace


def _state(edges: DataFrame) -> tuple:
    """Equal for equal edge sets; a sum does not depend on row order."""
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    joined = edges.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return joined.union(least.select("a", F.col("low").alias("b"))).distinct()


def component_roots(links: DataFrame, ws: Workspace, name: str, known: DataFrame | None = None) -> DataFrame:
    """``node, root`` for every linked node: ``root`` is the smallest node of its component.

    ``links`` has bigint columns ``a`` and ``b`` in any order, repeated or not; rows with
    a null or with ``a = b`` link nothing. ``known`` are roots found before, which the links
    add to: a component counts with one edge a node, not with all the links that made it. An edge leaves as many rows as it takes, so a
    node with many links costs no more than its links; nodes' minima are combined in the
    tasks first, and the join on a node with many links is one that Spark can split.
    """
    if known is not None:
        links = links.union(known.select(F.col("node").alias("a"), F.col("root").alias("b")))
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, step = ws.stage(edges, f"{name}-0"), 0
    before = _state(edges)
    while True:
        step += 1
        after = ws.stage(_small_star(_large_star(edges)), f"{name}-{step}")
        ws.drop(f"{name}-{step - 1}")
        edges, state = after, _state(after)
        if state == before:
            # Stars: every node but a root has one edge, to its root.
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
        before = state
