"""Connected components of a graph of links, by alternating star contractions.

Every round hangs each node's neighbours on the smallest one it knows (first the larger
neighbours, then the smaller ones); links only ever shrink towards stars around each
component's smallest node.  Rounds end when nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of links (a, b): root is the smallest node reachable.

    Repeated links, links in both directions and links from a node to itself are allowed.
    """
    edges = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "links")
    seen = _mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter(F.col("a") != F.col("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(small, "a").filter(F.col("b") != F.col("m")).select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        edges = materialize(hung.unionByName(small.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
