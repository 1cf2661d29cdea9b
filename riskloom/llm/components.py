"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.sources.store import materialise


def _checksum(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an undirected link table (u, v).

    A large star ties every larger neighbour to the smallest node of its
    neighbourhood, a small star does so with the smaller ones; repeated, each
    component becomes one star. Every round is two aggregates and two joins on the
    links, written below the shared folder; a node with very many links is a hot join
    key, which adaptive execution splits. Self links and rows with a null are ignored,
    repeated links count once; an empty table gives an empty result.
    """
    edges = materialise(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    before = None
    while (now := _checksum(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("w"), "m").where("w <> m")
        edges = materialise(small.select(F.col("w").alias("u"), F.col("m").alias("v")).distinct(), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
