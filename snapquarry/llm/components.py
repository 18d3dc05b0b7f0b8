"""Connected components of an edge list, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapquarry.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges`` (a, b: bigint).

    Alternating large-star and small-star rounds: each is one shuffle of the edge list
    with a minimum for each node, which Spark combines before the shuffle; the number of
    rounds grows with the logarithm of the longest chain, and ends when all edges hang on
    roots. Every round's edges are written to the shared folder, so neither lineage nor
    driver memory grows. The joins of a round are plain inner ones of a list of two numbers
    with one row a node, so that adaptive execution can split a node that holds very many
    edges. An empty list gives an empty result.
    """
    now = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    while not starred(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        now = materialise(small)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def starred(edges: DataFrame) -> bool:
    """Whether every node is either a root or has one edge, to a root."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("low"), F.lit(0).alias("high")).union(edges.select("v", F.lit(0), F.lit(1)))
    return not ends.groupBy("x").agg(F.sum("low").alias("low"), F.max("high").alias("high")).filter("low > 1 or low = 1 and high = 1").limit(1).count()
