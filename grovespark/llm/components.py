"""Connected components of a link table by alternating large-star and small-star steps (all in DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.llm.common import Workspace


def _minima(both: DataFrame) -> DataFrame:
    return both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the node's smallest neighbour (or the node)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.where("v > u").join(_minima(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, link to the smallest."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    low = _minima(down)
    return down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u > v")


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); the component is its smallest node.

    Each round is written to the shared folder. Nodes meet only their neighbours' minimum, so no node's links are
    gathered in one place; the number of rounds grows with the logarithm of the number of nodes.
    """
    now = work.save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        nxt = work.save(_small(_large(now)).distinct(), "star")
        work.drop(now)
        now = nxt
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = mark
