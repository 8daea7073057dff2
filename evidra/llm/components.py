"""Connected components of a link table, by alternating stars over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(links: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(node, root) of each node that occurs in links (a, b); the root is the component's least node.

    Large stars tie each node's larger neighbours to its least one, small stars the others; a round
    at least shortens every path, and the rounds end when the links no longer change. The least
    neighbours are written down before they are joined, so a hub's links are an ordinary skewed join
    side, which Spark splits.
    """
    edges = scratch.save(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges0")
    seen = None
    for i in range(1, rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.save(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), f"least{i}")
        large = scratch.save(both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), f"large{i}")
        least = scratch.save(large.groupBy("u").agg(F.min("v").alias("m")), f"small_least{i}")
        tied = large.join(least, "u")
        new = scratch.save(tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"edges{i}")
        scratch.drop(f"least{i}", f"large{i}", f"small_least{i}", f"edges{i - 1}")
        edges, now = new, new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
