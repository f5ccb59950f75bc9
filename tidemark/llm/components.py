"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (``a``, ``b``, 64-bit): root is its component's smallest node.

    The edges shrink to stars, each round stored; no component is ever gathered in one place. Each node's
    smallest neighbour is stored too, so that both sides of the joins are fresh exchanges, in which adaptive
    execution splits a hub. Loops and repeated edges do no harm; no edges give no rows.
    """
    edges = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        edges = _small_star(_large_star(edges))
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node are tied to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = kept(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "large-star")
    tied = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return kept(tied.where("a <> b").distinct(), "large-star")


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and itself, are tied to the smallest of them."""
    least = kept(edges.groupBy("a").agg(F.min("b").alias("least")), "small-star")
    tied = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return kept(tied.unionByName(least.select("a", F.col("least").alias("b"))).distinct(), "small-star")
