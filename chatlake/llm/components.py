"""Connected components by alternating large and small stars.

Every round is two aggregations by node, which combine map-side, and two joins;
its result is written to the shared scratch folder. Stars halve the depth of the
trees, so the number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest node that the node knows."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return both.where("v > u").join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    linked = edges.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return linked.unionByName(least.select("u", F.col("low").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v); the root is the smallest node of its component."""
    directed = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stored(directed, "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == before:
            break
        before = state
        large = _large_star(now).distinct()
        now = stored(_small_star(large).distinct(), "edges")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
