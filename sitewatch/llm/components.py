"""Connected components of an edge table, by alternating large and small stars.

Every step is a grouped minimum (partial sums first) and a join on the node. Each
step's table is written to the shared folder: a lost executor costs one step at most,
and the join reads its two sides straight from tables, so that the engine can
broadcast the minima while they are small (their size is known) and split the edges of
a node with very many neighbours when they are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import written


def _least(edges: DataFrame) -> DataFrame:
    """u and the least v beside it."""
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def _hooked(edges: DataFrame, least: DataFrame, keep) -> DataFrame:
    """(v, least of u) for the edges (u, v) that ``keep`` holds for."""
    return (edges.join(least, "u").where(keep)
            .select(F.col("v").alias("u"), F.col("least").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (long columns a, b); root is the least node.

    Loops and repeated edges are harmless; a node without an edge to another node is
    not in the result. NULL ends are ignored.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                               F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(_least(both).withColumn("least", F.least("u", "least")), "edges-least")
        large = written(_hooked(both, least, F.col("v") > F.col("u")).distinct(), "edges-large")
        least = written(_least(large), "edges-least")
        small = _hooked(large, least, F.col("v") != F.col("least")) \
            .union(least.select("u", F.col("least").alias("v"))).distinct()
        now = written(small, "edges")
        repeats = now.groupBy("u").count().where("count > 1")
        chained = now.join(now.select(F.col("u").alias("v")), "v", "left_semi")
        if repeats.isEmpty() and chained.isEmpty():
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
