"""Connected components by alternating large and small stars."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilnote.llm.common import Scratch, written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of edges(a, b): root is the smallest node that can be reached.

    Each round reads and writes narrow pairs. The smallest neighbour is found by an aggregate with map-side combine and
    joined back, so a node with very many links doesn't meet in one task.
    """
    scratch = Scratch(edges.sparkSession)
    state = scratch.put(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m"))
                        .where("v <> m").distinct(), "stars")
    before = None
    while True:
        both = state.select(F.col("v").alias("u"), F.col("m").alias("w")).union(
            state.select(F.col("m").alias("u"), F.col("v").alias("w")))
        least = both.groupBy("u").agg(F.least(F.min("w"), F.first("u")).alias("m"))
        large = both.where("w > u").join(least, "u").select(F.col("w").alias("v"), "m").distinct()
        least = large.groupBy("v").agg(F.min("m").alias("least"))
        small = large.join(least, "v").select(
            F.explode(F.array(F.struct("v", F.col("least").alias("m")),
                              F.struct(F.col("m").alias("v"), F.col("least").alias("m")))).alias("e"))
        state = scratch.put(small.select("e.v", "e.m").where("v <> m").distinct(), "stars")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if now == before:
            roots = written(state.select(F.col("v").alias("node"), F.col("m").alias("root")).union(
                state.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct()), "components")
            scratch.drop("stars")
            return roots
        before = now
