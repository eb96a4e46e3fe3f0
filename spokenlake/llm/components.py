"""Connected components by alternating large-star and small-star steps; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def connected(edges: DataFrame) -> DataFrame:
    """edges: a long, b long -> node, label: the smallest node of its component. Nodes without an edge are not returned.

    Each step replaces a node's edges by edges to the smallest neighbour, so the number of edges never grows by more than
    the nodes; the number of rounds grows with the logarithm of the longest path. Each round is written to the shared folder.
    It ends when the edges are stars around the smallest nodes: each larger end has one edge, and none is a smaller end.
    """
    pairs = lambda e: e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    now = written(pairs(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    while True:
        ends = now.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(now.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not ends.agg(F.count_if(F.expr("up + down > 1"))).first()[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m")), "least")
        large = written(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        lower = written(large.groupBy("u").agg(F.min("v").alias("m")), "lower")
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lower.select("u", F.col("m").alias("v")))
        after = written(pairs(small), "edges")
        for old in (now, least, large, lower):
            forget(old)
        now = after
