"""Trees given as rows with a parent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spokenlake.streaming.incremental import new_home


def tree_paths(nodes: DataFrame, tree: str, node: str, parent: str) -> DataFrame:
    """Path labels (1.2.1) and depths; siblings count from 1 in node order. Rows without a way to a root are left out.

    Level by level: one join on (tree, parent) for each, until a level is empty. Rows and levels are tables in the shared
    folder, so no level is computed twice, plans stay short, and lost executors cost only their tasks.
    """
    spark, home = nodes.sparkSession, new_home(nodes.sparkSession)

    def kept(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{home}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{home}/{name}")

    place = F.row_number().over(W.partitionBy(tree, parent).orderBy(node)).cast("string")
    rows = kept(nodes.select(tree, node, F.col(parent).alias("_parent"), place.alias("_place")), "rows")
    level = kept(rows.where("_parent is null").select(tree, node, F.col("_place").alias("path"), F.lit(1).alias("depth")), "level-1")
    paths, schema = [], level.schema
    while not level.isEmpty():
        paths.append(f"{home}/level-{len(paths) + 1}")
        above = level.select(F.col(tree).alias("_t"), F.col(node).alias("_n"), "path", "depth")
        joined = rows.join(above, (rows[tree] == above["_t"]) & (rows["_parent"] == above["_n"]))
        level = kept(joined.select(tree, node, F.concat("path", F.lit("."), "_place").alias("path"), (F.col("depth") + 1).alias("depth")), f"level-{len(paths) + 1}")
    return spark.read.schema(schema).parquet(*paths) if paths else level.select(tree, node, "path", "depth")


def render(paths: DataFrame, tree: str) -> DataFrame:
    """paths: tree, path, depth, author, created_at, text -> comments: two lines for each, indented by depth, in the order
    of the paths' numbers."""
    # The heads of comments and replies.
    head = F.when(F.col("depth") == 1, F.lit("评论 ")).otherwise(F.lit("回复 "))
    indent = F.repeat(F.lit("  "), F.col("depth") - 1)
    lines = F.concat(indent, head, "path", F.lit("｜作者："), "author", F.lit("｜时间："), "created_at", F.lit("\n"), indent, "text")
    keys = F.transform(F.split("path", r"\."), lambda x: x.cast("int"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(keys.alias("keys"), lines.alias("lines")))), lambda x: x["lines"])
    return paths.groupBy(tree).agg(F.array_join(ordered, "\n").alias("comments"))
