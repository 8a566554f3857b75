"""Connected components of an edge table by alternating large and small stars.

Every round is joins and aggregations over the edges, written to the checkpoint folder, so nothing of
the graph is on the driver and a lost executor costs a re-read.  A node with very many edges is a hot
key of a join whose other side has one row a node, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``comp`` (the smallest id of its component) of every node of the edges (a, b)."""
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "edges-least")
        large = stored(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "edges-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return e.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())


def _stars(e: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or is the smallest of all its neighbours."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return not ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up = 1 AND down = 1)").take(1)
