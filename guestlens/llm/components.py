"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) reaches.

    Large-star and small-star steps in turns until only stars are left: each links
    neighbours to the smallest one around. A node's neighbours are aggregated by
    partial minima and joined with one row per node, so a node with very many
    neighbours meets in no single task, and edges never multiply: a large-star
    step keeps one row per edge, a small-star step adds one per node.
    """
    links = materialize(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    while not _only_stars(links):
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        large = both.join(materialize(least, "star"), "a").where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        large = materialize(large.where("a != b"), "large-star")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("_m")), "star")
        small = large.join(least, "a").where("b != _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        links = materialize(small.union(least.select("a", F.col("_m").alias("b"))).distinct(), "small-star")
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def _only_stars(links: DataFrame) -> bool:
    """Whether each node that has a smaller neighbour has no other one."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("_up")).union(links.select("b", F.lit(0)))
    ends = ends.groupBy("node").agg(F.sum("_up").alias("_n"), F.min("_up").alias("_least"))
    return ends.where("_n > 1 OR (_n = 1 AND _least = 0)").count() == 0
