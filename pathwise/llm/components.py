"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwise.llm.common import stage

MAX_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (smallest node reachable) for every node with an edge.

    Each round replaces a node's edges by edges to the smallest neighbour,
    first for larger neighbours, then for smaller ones; the table only ever
    holds node pairs and is written between rounds.  Minima are taken with
    partial aggregation and joined back, so that a node with very many
    neighbours is split.  Ends when a round changes nothing (logarithmic in
    the number of nodes; reaching MAX_ROUNDS is an error, not a result).
    """
    small, large = F.least(a, b), F.greatest(a, b)
    e = stage(edges.select(large.alias("u"), small.alias("v")).filter("u <> v").distinct(), "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        wide = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .filter("u <> v").distinct())
        wide = stage(wide, "edges-large")
        least = wide.groupBy("u").agg(F.min("v").alias("m"))
        near = wide.join(least, "u").select("u", "v", "m")
        e = stage(near.select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionByName(least.select("u", F.col("m").alias("v")))
                  .filter("u <> v").distinct(), "edges-small")
        now = e.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
