"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.frames import stage
from hourgrid.session import release


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (long columns ``a``, ``b``); root is the smallest node.

    Edges stay distributed; only a row count and a checksum per round reach the
    driver. Neighbours are never collected: each step joins a node's smallest
    neighbour to its edges, a join that Spark can split for a hub.
    """
    links = stage(_ordered(edges))
    before = None
    while True:
        old, links = links, stage(_small_star(_large_star(links)))
        release(old)
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 1_000_003)).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pairs.where("a > b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return _ordered(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to its smallest neighbour."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.unionByName(least.select("a", F.col("m").alias("b"))))
