"""Joins by position: points in ranges, ranges in ranges, ordinals, and checks of two row sets against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions of one bucket of a range join.
WIDTH = 256


def _buckets(low: Column, high: Column, width: int) -> Column:
    """The buckets that [low, high) touches; none if it is empty."""
    return F.when(low < high, F.sequence(F.floor(low / width), F.floor((high - 1) / width))).otherwise(F.array().cast("array<bigint>"))


def points_in_ranges(points: DataFrame, ranges: DataFrame, key: str, point: str, low: str, high: str, width: int = WIDTH) -> DataFrame:
    """Each point with the ranges [low, high) of its key that hold it; null range columns where none does. Ranges are cut
    into buckets, so the join is one of equal keys and tests few pairs, also where one key has most rows."""
    cut = ranges.select("*", F.explode(_buckets(F.col(low), F.col(high), width)).alias("_bucket")).withColumnRenamed(key, "_key")
    at = points.withColumn("_bucket", F.floor(F.col(point) / width))
    on = (at[key] == cut["_key"]) & (at["_bucket"] == cut["_bucket"]) & (at[point] >= cut[low]) & (at[point] < cut[high])
    return at.join(cut, on, "left").drop("_key", "_bucket")


def ranges_in_ranges(inner: DataFrame, outer: DataFrame, key: str, low: str, high: str, start: str, stop: str, width: int = WIDTH) -> DataFrame:
    """Each inner range [low, high) with the outer ranges [start, stop) of its key that hold all of it."""
    cut = outer.select("*", F.explode(_buckets(F.col(start), F.col(stop), width)).alias("_bucket")).withColumnRenamed(key, "_key")
    at = inner.withColumn("_bucket", F.floor(F.col(low) / width))
    on = (at[key] == cut["_key"]) & (at["_bucket"] == cut["_bucket"]) & (at[low] >= cut[start]) & (at[high] <= cut[stop])
    return at.join(cut, on).drop("_key", "_bucket")


def zipped(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows paired by their keys, the last of which is an ordinal; ``paired`` is false where one side ends early."""
    both = left.withColumn("_l", F.lit(True)).join(right.withColumn("_r", F.lit(True)), keys, "full")
    return both.withColumn("paired", F.col("_l").isNotNull() & F.col("_r").isNotNull()).drop("_l", "_r")


def reconciled(requests: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """keys, outcome: ok if a request was answered once, else missing, repeated, or unexpected."""
    asked = requests.groupBy(*keys).agg(F.count("*").alias("_asked"))
    given = results.groupBy(*keys).agg(F.count("*").alias("_given"))
    outcome = F.when(F.col("_asked").isNull(), "unexpected").when(F.col("_given").isNull(), "missing").when(F.col("_given") > F.col("_asked"), "repeated").otherwise("ok")
    return asked.join(given, keys, "full").select(*keys, outcome.alias("outcome"))


def equal_sets(expected: DataFrame, actual: DataFrame, group: str, value: str) -> DataFrame:
    """group, equal, lacking, extra: whether both sides hold the same values of a group, and how many one side lacks."""
    sides = expected.select(group, value, F.lit(1).alias("e"), F.lit(0).alias("a")).unionByName(actual.select(group, value, F.lit(0).alias("e"), F.lit(1).alias("a")))
    each = sides.groupBy(group, value).agg(F.max("e").alias("e"), F.max("a").alias("a"))
    out = each.groupBy(group).agg(F.count_if(F.col("a") == 0).alias("lacking"), F.count_if(F.col("e") == 0).alias("extra"))
    return out.withColumn("equal", (F.col("lacking") == 0) & (F.col("extra") == 0))


def merged_partials(parts: DataFrame, group: str, order: str) -> DataFrame:
    """parts: group, order, text, deleted, source, deletions -> their sums, the texts in order with a blank line between,
    all deletions in order, and the share deleted (0 where there was nothing)."""
    listed = F.array_sort(F.collect_list(F.struct(order, "text", "deletions")))
    g = parts.groupBy(group).agg(listed.alias("l"), F.sum("deleted").alias("deleted"), F.sum("source").alias("source"))
    return g.select(
        group, F.array_join(F.transform("l", lambda x: x["text"]), "\n\n").alias("text"), "deleted", "source",
        F.flatten(F.transform("l", lambda x: x["deletions"])).alias("deletions"), F.coalesce(F.try_divide("deleted", "source"), F.lit(0.0)).alias("ratio"),
    )
