"""Connected components of a frame of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import Working

MOST_ROUNDS = 60


def _least(edges: DataFrame, work: Working) -> DataFrame:
    return work.written(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least")), "least")


def components(edges: DataFrame, work: Working) -> DataFrame:
    """node and root, the smallest node reachable, for every node of edges a, b.

    Rounds of large stars (larger neighbours go to the least neighbour) and small stars
    (smaller ones and the node itself do) keep the edges few and halve distances; they end when
    every edge leads to a root. Each round is written, so no lineage grows, and the one before is
    dropped. The result reads one table of `work`.
    """
    pairs = edges.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).where("u <> v")
    now = work.written(pairs.distinct(), "edges")
    facts = None
    for _ in range(MOST_ROUNDS):
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        of_both = _least(both, work)
        large = both.join(of_both, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = work.written(large.where("u <> v").distinct(), "edges")
        of_large = _least(large, work)
        small = large.join(of_large, "u")
        small = small.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            small.select("u", F.col("least").alias("v"))
        )
        before, now = now, work.written(small.where("u <> v").distinct(), "edges")
        work.drop(before, of_both, large, of_large)
        seen = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_distinct("u")
        ).first()
        # Every node has one edge, and nothing moved.
        if seen == facts and seen[0] == seen[2]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        facts = seen
    raise RuntimeError("components did not settle")
