"""Connected components of links by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm import common


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of the node and its neighbours; rows may repeat."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("b"), F.col("m").alias("a"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these. ``edges`` have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").where("a > m").select(F.col("a").alias("b"), F.col("m").alias("a"))
    return moved.union(least.select("b", F.col("m").alias("a"))).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every component is its smallest node and links to it: no node has two smaller ones, or one and a larger."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("below")).union(edges.select("b", F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("below").alias("smaller"), F.min("below").alias("least"))
    return nodes.where("smaller > 1 OR (smaller = 1 AND least = 0)").count() == 0


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (a, b) but the roots: the smallest node each can reach.

    The rounds grow with the logarithm of the longest chain. Each round's edges are written to
    the shared folder. Counts per node combine before the shuffle, and the joins are plain
    equi-joins whose hot keys AQE splits; no group is gathered in one task. Links from a node to
    itself and nulls are left out; repeated links count once; without links the result is empty.

    With ``rounds``, no more rounds than that are made: nodes of one root then still are connected, but a
    component may have several roots.
    """
    edges = common.stored(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    if rounds is not None:
        for _ in range(rounds):
            edges = _small_star(_large_star(edges)).select("a", "b")
        return common.stored(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "roots")
    while not _all_stars(edges):
        edges = common.stored(_small_star(_large_star(edges)).select("a", "b"), "links")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
