"""Event-time sessions, for batches and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """user_id, start, stop (last event plus the gap), n. On a stream, state older than ``late`` is closed and dropped."""
    timed = events.select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    if events.isStreaming:
        timed = timed.withWatermark("ts", late)
    found = timed.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return found.select("user_id", F.unix_seconds("w.start").alias("start"), F.unix_seconds("w.end").alias("stop"), "n")
