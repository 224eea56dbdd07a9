"""Connected components of an edge table by star contraction.

Large-star and small-star steps alternate until the edges are stars: each
node points to the smallest node of its component.  A step is one aggregate
(combined before the shuffle) and one join per direction; a centre with very
many neighbours is a hot join key, which adaptive execution splits.  Every
round is written to the shared folder, so lost executors cost one round, and
only a row count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import stored


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)).alias("n"), F.sum(
        F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; longs), root
    being the smallest node reachable.  Null ends and loops are ignored."""
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter(F.col("a") != F.col("b")).distinct(), "edges")
    before = _state(edges)
    while before["n"]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b"), F.col("a")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("a"), F.least("m", "u").alias("b"))
                 .filter(F.col("a") != F.col("b")).distinct())
        large = stored(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter(F.col("a") != F.col("b"))
                 .union(least.select("a", F.col("m").alias("b"))).distinct())
        edges = stored(small, "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b"), F.col("b"))).distinct()
