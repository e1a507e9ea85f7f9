"""Records that share an identity key, directly or through other records, become one object."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pinned


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; both only need a minimum per node, never a list of its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    centre = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (both.where(F.col("v") > F.col("u")).join(centre, "u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct())
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    hung = large.join(lowest, "u")
    return (hung.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct())


def _is_star_forest(edges: DataFrame) -> bool:
    children = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    roots = edges.select(F.col("v").alias("u")).distinct()
    wrong = (children.where("n > 1").select("u")
             .unionByName(children.join(roots, "u", "left_semi").select("u")))
    return wrong.isEmpty()


def identity_components(keys: DataFrame, record: str, key: str) -> DataFrame:
    """(record, component): the component is the smallest record id. ``keys`` has one row per record and key.

    Each key first contracts to a star around its smallest record, so a key held by a third of all records yields
    one edge per record. Alternating star steps (Kiveris et al., 2014) then need O(log^2 n) rounds; every
    round is written to the shared folder, and so are the keys, which may be hashes of large texts.
    """
    keys = pinned(keys.select(record, key))
    pairs = keys.where(F.col(key).isNotNull()).select(F.col(record).alias("u"), F.col(key).alias("_key")).distinct()
    hubs = pairs.groupBy("_key").agg(F.min("u").alias("v"))
    edges = pinned(pairs.join(hubs, "_key").where(F.col("u") != F.col("v")).select("u", "v").distinct())
    # every round hangs some node lower, so the loop ends
    while not _is_star_forest(edges):
        edges = pinned(_round(edges))
    records = keys.select(F.col(record)).distinct()
    return (records.join(edges.select(F.col("u").alias(record), "v"), record, "left")
            .select(record, F.coalesce("v", record).alias("component")))
