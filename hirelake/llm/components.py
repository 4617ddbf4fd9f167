"""Connected components of a graph of links, as alternating star rounds on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour instead."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("v != m").select(
        F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of links(a, b).

    The number of rounds grows with the logarithm of the longest chain; each round is written
    to the shared folder. Node degrees may be as large as the graph: minima are combined on the
    map side, and joins on a hub can be split.
    """
    links = stage(links.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        links = stage(_small_star(_large_star(links)), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
