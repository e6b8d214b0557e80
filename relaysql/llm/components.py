"""Connected components of a link table, by alternating large and small stars.

Every step aggregates the smallest neighbour per node (combined on the map side)
and joins it back from a written table, so that both join sides are plain
shuffles and a node with very many links is split by AQE. Links halve their
distance to the smallest id in each round; nothing is collected but one flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaysql.llm.common import release, written

MAX_ROUNDS = 60        # distances halve each round: far beyond what any table needs


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, component): the smallest id reachable, for every node that has a link."""
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    for _ in range(MAX_ROUNDS):
        # done when every node points at one node, and none points at a node that points on
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
        open_ = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least")).where("ups > 1 OR ups = 1 AND least = 0")
        if open_.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large.where("u <> v"), "cc-large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        new = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        release(edges, least, large, low)
        edges = new
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
