"""Connected components of a link table, by repeated star contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ombuds.session import shared_dir


def _to_least(pairs: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Each neighbour that ``keep`` selects, linked to the node's least neighbour or the node itself; and that one."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = pairs.where(keep).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved, least


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``links(a, b)``: the least node it can reach.

    Each round links the larger neighbours of every node to its least one, then the smaller ones; a chain shortens
    to its logarithm's square. Rounds are cut by ``checkpoint()``, so a lost executor never reaches back further than
    one. The grouped side of each join has one row per node, so a node with very many links can be split. Links of a
    node to itself are allowed, links with a null are left out, and no links give no nodes.
    """
    shared_dir(links.sparkSession)
    known = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    edges = known.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    loops = edges.where("u = v")
    edges = edges.where("u > v")
    nodes = loops.select("u").union(edges.select("u")).union(edges.select("v")).distinct().checkpoint()
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger, _ = _to_least(both, F.col("v") > F.col("u"))
        stars = larger.where("u > v").distinct()
        smaller, least = _to_least(stars, F.lit(True))
        edges = smaller.union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct().checkpoint()
        # Order-free digest of the links; equal to the last one when nothing moved any more.
        digest = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if digest == before:
            break
        before = digest
    return (
        nodes.join(edges.groupBy("u").agg(F.min("v").alias("v")), "u", "left")
        .select(F.col("u").alias("node"), F.coalesce("v", "u").alias("component"))
    )
