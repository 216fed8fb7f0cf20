"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careloom.llm.runtime import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang the neighbours of every node, larger or smaller ones, on the node's least neighbour.

    The least neighbour is an aggregate with partial sums and its join leaves a plain side, so a node with very
    many neighbours is split by adaptive execution and never gathered.
    """
    around = _both_ways(edges) if larger else edges
    least = around.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    met = around.join(least, "a")
    if larger:
        hung = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return hung.where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``; the root is the least node that is reachable.

    Alternating large and small stars (Kiveris et al. 2014): the number of rounds grows with the logarithm of the
    longest path.  Each round is written to the shared folder, which ends its lineage.  Null ends and links of a
    node to itself are no links; no links give no rows.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(edges)
    while True:
        edges = stage(_star(_star(edges, True), False), "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
