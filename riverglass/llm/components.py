"""Connected components of a graph given as links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riverglass.session import reliable


def _toward_smallest(directed: DataFrame, with_self: bool) -> DataFrame:
    """Each neighbour `b` of `a` is linked to the smallest of a's neighbours and a itself."""
    least = directed.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    moved = directed.join(least, "a")
    if not with_self:  # large star: only neighbours above a
        return moved.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    ends = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return ends.unionByName(least.withColumnRenamed("least", "b"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b: long); root is the component's smallest node.

    Each round hangs every neighbourhood under its smallest node, first looking at larger
    neighbours, then at smaller ones, until no link moves. Rounds are written to the shared
    folder; only a count and a checksum per round reach the driver.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = reliable(edges), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _toward_smallest(both, with_self=False).where("a <> b").distinct()
        small = _toward_smallest(large, with_self=True).where("a <> b").distinct()
        edges = reliable(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
