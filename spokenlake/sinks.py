"""Sinks: manifests, reports and checkpoints as JSON, with Spark's commit protocol for atomic writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_json(rows: DataFrame, path: str, overwrite: bool = True) -> None:
    """All files appear at once; without ``overwrite`` a path that is there is an error."""
    rows.write.mode("overwrite" if overwrite else "errorifexists").json(path)


def ordered(order: str, *columns: str) -> Column:
    """The rows of a group as structs, in order. For groups of bounded size, such as the episodes of one feed."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_order"), *columns))), lambda x: F.struct(*[x[c].alias(c) for c in columns]))


def status_counts(kinds: tuple[str, ...]) -> list[Column]:
    return [F.count_if(F.col("status") == k).alias(f"{k}_count") for k in kinds]


def feed_manifest(entries: DataFrame, list_only: bool = False) -> DataFrame:
    """entries: feed_url, pos, episode_id, status, audio_length_bytes -> one manifest a feed."""
    kinds = ("downloaded", "skipped", "failed", "pending")
    return entries.groupBy("feed_url").agg(
        F.count("*").alias("episode_count"), F.sum(F.coalesce("audio_length_bytes", F.lit(0))).alias("declared_total_bytes"), F.lit(list_only).alias("list_only"), *status_counts(kinds), ordered("pos", "episode_id", "status", "audio_length_bytes").alias("episodes")
    )


def quality_report(segments: DataFrame, limit: float = 0.05) -> DataFrame:
    """segments: key, index, start_ms, end_ms, confidences -> counts, and a record of each affected segment only."""
    s = segments.withColumn("low", F.size(F.filter("confidences", lambda c: c < limit))).withColumn("n", F.size("confidences"))
    record = F.when(F.col("low") > 0, F.struct("index", "start_ms", "end_ms", "low"))
    return s.groupBy("key").agg(
        F.count("*").alias("segment_count"), F.sum("n").alias("evaluated"), F.sum("low").alias("suspicious"), F.count_if(F.col("low") > 0).alias("affected_count"), F.count_if(F.col("low") == 0).alias("clean_count"), F.array_sort(F.collect_list(record)).alias("segments")
    )


def batch_report(results: DataFrame) -> DataFrame:
    """results: feed, pos, episode, ok, error -> totals and the episodes in order; the error only where there is one."""
    g = results.groupBy("feed").agg(F.count("*").alias("total"), F.count_if("ok").alias("success"), ordered("pos", "episode", "ok", "error").alias("results"))
    return g.withColumn("fail", F.col("total") - F.col("success"))


def extraction_reports(mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """mentions: feed, episode, name, evidence -> (a detail row for each episode, a summary row for each feed and name)."""
    detail = mentions.groupBy("feed", "episode").agg(F.count("*").alias("companies_count"), F.array_sort(F.collect_list(F.struct("name", "evidence"))).alias("companies"))
    summary = mentions.groupBy("feed", "name").agg(F.count("*").alias("occurrence_count"), F.count_distinct("episode").alias("episodes"))
    return detail, summary


def write_reports(mentions: DataFrame, path: str) -> None:
    detail, summary = extraction_reports(mentions)
    write_json(detail, f"{path}/detail")
    write_json(summary, f"{path}/summary")


def segment_manifest(segments: DataFrame) -> DataFrame:
    """segments: source, index, start_ms, end_ms -> source, segment_count, segments."""
    return segments.groupBy("source").agg(F.count("*").alias("segment_count"), ordered("index", "index", "start_ms", "end_ms").alias("segments"))


def console(rows: DataFrame, most: int = 1000) -> str:
    """The rows as JSON lines, for a command's output; more than ``most`` rows are an error, not cut."""
    lines = [r.j for r in rows.select(F.to_json(F.struct("*")).alias("j")).limit(most + 1).collect()]
    if len(lines) > most:
        raise ValueError(f"more than {most} rows: write them to a table")
    return "\n".join(lines)
