"""Mentions: guards, first-occurrence de-duplication, blacklists, summaries, evidence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spokenlake.functions import text as T


def guarded(mentions: DataFrame) -> DataFrame:
    """Rows whose name and evidence are not blank."""
    return mentions.where((T.strip(F.col("name")) != "") & (T.strip(F.col("evidence")) != ""))


def first_per_name(mentions: DataFrame) -> DataFrame:
    """The first mention of each folded name in a group, as a partial aggregate (no window, no sort)."""
    rest = [c for c in mentions.columns if c not in ("grp", "pos")]
    first = mentions.groupBy("grp", T.fold(F.col("name")).alias("name_key")).agg(F.min(F.struct("pos", *rest)).alias("m"))
    return first.select("grp", "name_key", "m.*")


def flag_blacklisted(mentions: DataFrame, names: list[str]) -> DataFrame:
    """names: a configured list; duplicates are gone before this, so a name counts once for each group."""
    return mentions.withColumn("blacklisted", F.col("name_key").isin(sorted({n.strip().lower() for n in names if n.strip()})))


def summary(mentions: DataFrame) -> DataFrame:
    """Occurrences by stripped, case-sensitive name, most frequent first: a row for each, in the groups' order, with the
    name's count. A name's occurrences never meet in one row or task, however many they are."""
    named = mentions.select(T.strip(F.col("name")).alias("name"), "grp", "pos")
    counts = named.groupBy("name").agg(F.count("*").alias("occurrence_count"))
    return named.join(counts, "name").select("name", "occurrence_count", "grp", "pos").orderBy(F.desc("occurrence_count"), "name", "grp", "pos")


def distinct_excerpts(mentions: DataFrame, k: int = 2, find: Callable[[Column, Column], Column] = T.find_name) -> DataFrame:
    """The first k distinct excerpts of each folded name in a group. find: what tells the name's place, which white space
    does not hide from ``find_name``, and which ``find_verbatim`` looks for as it is written."""
    cut = mentions.select("grp", T.fold(F.col("name")).alias("name_key"), "pos", T.excerpt(F.col("evidence"), F.col("name"), find=find).alias("excerpt"))
    once = cut.groupBy("grp", "name_key", "excerpt").agg(F.min("pos").alias("pos"))
    rank = F.row_number().over(W.partitionBy("grp", "name_key").orderBy("pos"))
    return once.withColumn("k", rank).where(F.col("k") <= k).select("grp", "name_key", F.col("k").cast("long").alias("k"), "excerpt")


def validate_evidence(mentions: DataFrame, sources: DataFrame) -> DataFrame:
    """sources: grp, source. A mention holds if some source of its group contains its evidence (white space aside), and the
    evidence its name (white space and case aside)."""
    bare = sources.select("grp", T.ws_remove(F.col("source")).alias("bare"))
    named = F.contains(F.lower(T.ws_remove(F.col("evidence"))), F.lower(T.ws_remove(F.col("name"))))
    asked = mentions.select("grp", F.struct("pos", T.ws_remove(F.col("evidence")).alias("evidence"), named.alias("named")).alias("m"))
    asked = asked.groupBy("grp").agg(F.collect_list("m").alias("ms"))  # the lines of one group, which its source holds too
    tested = asked.join(bare, "grp", "left").select("grp", F.explode(F.transform("ms", lambda m: F.struct(m["pos"].alias("pos"), (m["named"] & F.coalesce(F.contains(F.col("bare"), m["evidence"]), F.lit(False))).alias("ok")))).alias("t"))
    return tested.groupBy("grp", F.col("t.pos").alias("pos")).agg(F.bool_or("t.ok").alias("valid"))


def validate_merged(results: DataFrame, candidates: DataFrame) -> DataFrame:
    """A merged name must be a candidate's, and its evidence part of one of that name's evidences."""
    key = lambda t: t.select("grp", T.fold(F.col("name")).alias("name_key"), T.ws_remove(F.col("evidence")).alias("bare"))
    r, c = key(results), key(candidates).withColumnRenamed("bare", "source")
    return r.join(c, ["grp", "name_key"], "left").groupBy("grp", "name_key", "bare").agg(F.coalesce(F.bool_or(F.contains("source", "bare")), F.lit(False)).alias("valid")).select("grp", "name_key", "valid")
