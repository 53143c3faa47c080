"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import discard, materialise, maybe_broadcast

BROADCAST_ROWS = 200_000


def _joined_min(pairs: DataFrame) -> DataFrame:
    """(u, v, m): the smallest of u and its listed neighbours beside every pair.

    A node with very many pairs is pre-aggregated for its minimum; its pairs meet the one row by
    broadcast where the table is small, else in a join whose skewed side Spark splits.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("m"))
    return pairs.join(maybe_broadcast(least, least.count(), BROADCAST_ROWS), "u")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node of each component, for every node that has an edge.

    Self-links and repeated edges change nothing; an empty table gives none.
    """
    now = materialise(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialise(_joined_min(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "large-star")
        small = _joined_min(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        before, now = now, materialise(small, "small-star")
        discard(before, large)
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == seen:
            break
        seen = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
