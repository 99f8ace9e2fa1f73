"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, materialise


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node that has a smaller neighbour has one only, and that one has none."""
    several = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    inner = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
    return several.unionByName(inner).isEmpty()


def connected(links: DataFrame) -> DataFrame:
    """id, label of every end of links (a, b), where label is the smallest id reachable.

    Each step only joins edges to per-node minima that are aggregated before they
    are shuffled. A step's edges are written, so a lost executor repeats one step.
    """
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _are_stars(edges):
        # large star: the larger neighbours of a node go to its smallest
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = materialise(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        # small star: the smaller neighbours of a node, and the node, go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        small = materialise(small.where("u <> v").distinct(), "small-star")
        discard(large)
        discard(edges)
        edges = small
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
