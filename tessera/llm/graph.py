"""Connected components of an edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import write_stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(least, F.col("u") == F.col("c"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
    moved = edges.join(least, F.col("u") == F.col("c")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the least node reachable) of every node of ``edges`` (``u``, ``v``, both long).

    Self-loops and repeated edges are allowed, nulls are not.  Each round is
    written to the checkpoint folder, so a lost executor costs one round.  A
    round needs the least neighbour of a node only, never its neighbour list.
    Nodes of a group of any size meet their root in about log2(diameter)
    rounds; the loop ends when a round changes nothing.
    """
    links = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = write_stage(links, "links")
    before = _digest(links)
    while before[0]:
        links = write_stage(_small_star(write_stage(_large_star(links), "large-star")), "small-star")
        after = _digest(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
