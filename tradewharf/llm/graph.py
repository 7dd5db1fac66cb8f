"""Connected components of an edge table, without a graph in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewharf.llm.base import Scratch


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """node, component (the smallest node reachable) of all nodes of ``edges`` (a, b).

    Alternates large-star and small-star steps until nothing changes. A step is one minimum per
    node and one join back, so a node with very many neighbours is split like any join; each
    round is a written table and replaces the one before.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now, name, state = scratch.cut(pairs, f"{label}0"), f"{label}0", None
    step = 0
    while True:
        found = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if found == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = found
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        step += 1
        now = scratch.cut(small, f"{label}{step}")
        scratch.drop(name)
        name = f"{label}{step}"
