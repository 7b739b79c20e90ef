"""Connected components by alternating large and small stars, as joins and aggregates.

Every round replaces links by links to smaller nodes; the number of rounds grows with the logarithm of the longest
chain.  Neighbours of a node are never gathered: a node's least neighbour is an aggregate with map-side combine,
and the join back can be split where a node is hot.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (longs ``a``, ``b``); label is the least node of the component."""
    digest = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    now = stage(links.where("a <> b").select("a", "b").distinct(), "links")
    before = None
    while True:
        now = stage(_small_star(_large_star(now)).distinct(), "links")
        after = tuple(now.agg(*digest).first())
        if after == before or after[0] == 0:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
