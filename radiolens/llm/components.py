"""Connected components of an edge table, smallest node as label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _toward_least(e: DataFrame, both_ways: bool) -> DataFrame:
    """Each node's neighbours (its larger ones, or with ``both_ways`` False its
    smaller ones) are linked to the least of the node and its neighbours."""
    up = e.select(F.col("b").alias("u"), F.col("a").alias("v"))
    sym = up.unionByName(e.select(F.col("a").alias("u"), F.col("b").alias("v"))) if both_ways else up
    least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = sym.where(F.col("v") > F.col("u")) if both_ways else sym.unionByName(
        least.select("u", F.col("u").alias("v")))
    linked = moved.join(least, "u")
    return (linked.select(F.least("v", "m").alias("a"), F.greatest("v", "m").alias("b"))
            .where(F.col("a") != F.col("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``edges`` (columns ``src``, ``dst``).

    Rounds of linking to the least neighbour, each written to the shared folder,
    until the edge set stays the same.
    """
    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.hash("a", "b"))).first())

    e = staged(edges.where(F.col("src") != F.col("dst"))
               .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct(), "links")
    seen = mark(e)
    while seen[0]:
        e = staged(_toward_least(_toward_least(e, True), False), "links")
        now = mark(e)
        if now == seen:
            break
        seen = now
    roots = e.groupBy("b").agg(F.min("a").alias("component")).select(F.col("b").alias("node"), "component")
    return roots.unionByName(e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
