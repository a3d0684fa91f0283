"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.llm.workspace import Workspace


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest node reached.

    Alternates the large-star and small-star steps until no edge changes. Each
    step keeps one row per edge; minima are combined before the shuffle, so a
    node with very many neighbours sends one row per task.
    """
    u, v = F.greatest("a", "b"), F.least("a", "b")
    now = work.stage(edges.select(u.alias("u"), v.alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        state = tuple(now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        ).first())
        if state == seen:
            break
        seen = state
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = work.stage(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        work.drop(now)
        now = after
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
