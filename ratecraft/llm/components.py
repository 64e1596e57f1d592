"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of (a, b) edges the smallest node that it reaches.

    Each round hangs a node's neighbours below the smallest of them; rounds grow
    with the logarithm of the longest path.  Every step is an aggregation and a
    join of written tables, so a node with very many edges can be split between
    tasks.  NULL ends are ignored.  Rounds end when the number of pairs and the sum
    of 32 bits of each pair's hash stay the same.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, state = materialise(pairs, "cc-edges"), None
    while True:
        seen = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit(0xFFFFFFFF)))).first()
        if seen == state:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = seen
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "cc-least")
        # large star: the larger neighbours of u go below the smallest of u and its neighbours
        large = materialise(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        # small star: so do u and its smaller neighbours
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
