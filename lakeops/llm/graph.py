"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.work import stored


def _lowest(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour. It is written, so that the join below can split a node with very many links."""
    return stored(edges.groupBy("u").agg(F.min("v").alias("low")), "lowest")


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each node of `links`, which has long columns a and b in any order and may repeat.

    Returns node, component. Nodes without a link to another node are not in the result. Each step replaces links by
    links to smaller nodes; it ends when every node links to the smallest one of its component alone. A node with many links
    is aggregated before the shuffle, and its join partition is split at run time.
    """
    edges = stored(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
        .distinct(),
        "links",
    )
    while True:
        # Large star: every larger neighbour of a node links to the node's smallest neighbour (or itself).
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(both).select(F.col("u").alias("n"), F.least("u", "low").alias("low"))
        large = both.join(low, both.u == low.n).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = stored(large.filter("u > v").distinct(), "large")
        # Small star: a node and its smaller neighbours link to the smallest of them.
        low = _lowest(edges).select(F.col("u").alias("n"), "low")
        moved = edges.join(low, edges.u == low.n).filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = stored(moved.unionByName(low.select(F.col("n").alias("u"), F.col("low").alias("v"))).distinct(), "small")
        # Done if all is stars: no node links to two others, and none that is linked to links on.
        roles = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into"))
        roles = roles.unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        roles = roles.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if not roles.filter("out > 1 or (out > 0 and into > 0)").head(1):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
