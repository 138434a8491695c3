"""Connected components of a link table by alternating large and small stars.

The smallest neighbours reach their joins by plain shuffles (the rebalance hint), so that Spark
can split a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour, or to the node."""
    both = _both_ways(links)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).hint("rebalance")
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these. Links have a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).hint("rebalance")
    others = links.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def labels(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b): the smallest node it can reach.

    Links are undirected and may repeat; a link from a node to itself is ignored. Each round
    is written to the shared folder, so neither lineage nor memory grows with the rounds.
    """
    now = links.where(F.col("a") != F.col("b"))
    now = store.written(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = F.struct(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))))
    before = None
    while (after := now.agg(state.alias("s")).first()["s"]) != before:
        before = after
        now = store.written(_small_star(_large_star(now)), "links")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
