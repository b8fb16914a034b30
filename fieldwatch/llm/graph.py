"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import checkpointed


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b: long), root being the smallest node reachable.

    Every round links larger neighbours, then smaller ones, to a node's smallest neighbour; stars whose centre is the
    smallest node remain when nothing changes. A round is two joins on node keys with grouped minima; nothing is gathered by
    node, a hot node's rows are split by adaptive skew joins, and each round is checkpointed, so a lost executor repeats one
    round at most. Null ends and loops don't count. Rounds grow with the logarithm of the longest path.
    """
    now = checkpointed(edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpointed(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m")))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = checkpointed(large)
        least = checkpointed(large.groupBy("u").agg(F.min("v").alias("m")))
        linked = large.join(least, "u")
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = checkpointed(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
