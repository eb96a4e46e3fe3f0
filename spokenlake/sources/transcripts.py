"""Transcript manifests, segment checkpoints and reports, as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokenlake.functions import text as T

TIMED = "ARRAY<STRUCT<text: STRING, start_ms: BIGINT, end_ms: BIGINT, confidence: DOUBLE>>"
SEGMENT = f"STRUCT<index: INT, start_ms: BIGINT, end_ms: BIGINT, text: STRING, character_timestamps: {TIMED}, sentences: {TIMED}, audio_path: STRING>"
MANIFEST = f"title STRING, created_at STRING, segment_count INT, text STRING, segments ARRAY<{SEGMENT}>, index INT, start_ms BIGINT, end_ms BIGINT"


def segments(spark: SparkSession, paths: str | list[str], pruned: bool = False, lines: bool = False) -> DataFrame:
    """Segments of manifests, or of single-segment files. ``pruned`` reads only index, times and text; ``lines`` reads one
    manifest a line, as ``write_manifest`` writes them, where files hold one each otherwise.

    Rows whose times are missing or not 0 <= start < end are returned with ``valid`` false, for the caller to refuse.
    """
    raw = spark.read.schema(MANIFEST).option("multiLine", not lines).json(paths).withColumn("path", F.input_file_name())
    single = F.array(F.struct("index", "start_ms", "end_ms", "text", F.lit(None).cast(TIMED).alias("character_timestamps"), F.lit(None).cast(TIMED).alias("sentences"), F.lit(None).cast("string").alias("audio_path")))
    rows = raw.select("path", "title", F.explode(F.coalesce("segments", single)).alias("s"))
    names = ["index", "start_ms", "end_ms", "text"] + ([] if pruned else ["character_timestamps", "sentences", "audio_path"])
    out = rows.select("path", "title", *[F.col(f"s.{n}").alias(n) for n in names]).withColumn("text", T.strip(F.col("text")))
    return out.withColumn("valid", F.coalesce((F.col("start_ms") >= 0) & (F.col("start_ms") < F.col("end_ms")) & F.col("index").isNotNull(), F.lit(False)))


def write_manifest(rows: DataFrame, path: str) -> None:
    """rows: title, index, start_ms, end_ms, text -> one JSON object a title, segments in order."""
    nested = rows.groupBy("title").agg(F.count("*").cast("int").alias("segment_count"), F.array_sort(F.collect_list(F.struct("index", "start_ms", "end_ms", "text"))).alias("segments"))
    whole = nested.withColumn("text", F.array_join(F.transform("segments", lambda s: s["text"]), "\n")).withColumn("created_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    whole.write.mode("overwrite").json(path)


def write_articles(rows: DataFrame, path: str) -> None:
    """rows: name, title, body -> Markdown text, partitioned by name."""
    rows.select("name", T.article(F.col("title"), F.col("body")).alias("value")).write.mode("overwrite").partitionBy("name").text(path)
