"""Connected components of links between documents by alternating star contraction (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import pinned


def star_round(edges: DataFrame) -> DataFrame:
    """Hang every node below the smallest one it can see: first larger neighbours, then smaller ones. Both steps need a
    minimum per node and a join with it, never a node's list of neighbours."""
    both = edges.union(edges.select("lo", "hi")).toDF("node", "other")
    lowest = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("top"))
    raised = (both.where("other > node").join(lowest, "node").where("other <> top")
              .select(F.col("other").alias("hi"), F.col("top").alias("lo")).distinct())
    heads = raised.groupBy("hi").agg(F.min("lo").alias("top"))
    rest = raised.join(heads, "hi").where("lo <> top").select(F.col("lo").alias("hi"), F.col("top").alias("lo"))
    return rest.union(heads.select("hi", F.col("top").alias("lo"))).distinct()


def settled(edges: DataFrame) -> bool:
    """Whether every node hangs below one node that hangs below none: one aggregation over the ends of the edges."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select("lo", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above")).where("below > 1 or below = 1 and above = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; ``links`` are (a, b) pairs in any direction, the component is the smallest
    node that can be reached.

    Each round is written to the shared folder; the loop ends when all edges are stars, which links around one hub are
    from the start. A node with very many links is a hot key of joins only, which adaptive execution splits.
    """
    edges = pinned(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    while not settled(edges):
        edges = pinned(star_round(edges))
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
