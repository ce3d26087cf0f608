"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``: root is the smallest node reachable.

    Alternates large-star and small-star steps, each a partial minimum by node and a join, until
    the links no longer change. Every step is staged, so lineage stays short. Nodes on both ends
    are longs; loops and repeated links are allowed, and an empty table gives an empty result.
    """
    edges = stage(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    previous = None
    while True:
        # Large star: every neighbour above a node goes to the least of the node's neighbours.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        # Small star: lower neighbours, and the node itself, go to the least of them.
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(floor, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                      F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .where("a <> b")
            .distinct()
        )
        edges = stage(small, "links")
        # Links are stars of minima when nothing changed: the pair of sums is a fingerprint.
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.xxhash64("b", "a") % 998_244_353)
        ).first()
        if now == previous:
            break
        previous = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
