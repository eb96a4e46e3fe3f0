"""Incremental state: a file stream folded into a table of the newest state of each key."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_home(spark: SparkSession) -> str:
    """A folder for a stream's log and checkpoints that all executors share."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{found or 'file://' + tempfile.mkdtemp(prefix='spokenlake-stream-')}/upsert-{uuid.uuid4().hex}"


def upsert_latest(spark: SparkSession, source: str, home: str | None = None) -> DataFrame:
    """Reads what is new in ``source`` (availableNow), appends each batch's partial state to a log under its batch id, so a
    replayed batch replaces itself, and returns the state: the newest status of each user and the number of its updates.

    home: where the log and the stream's position are kept; a call with the home of an earlier one reads only new files.
    """
    home = home or new_home(spark)
    schema = spark.read.parquet(source).schema

    def fold(batch: DataFrame, epoch: int) -> None:
        newest = F.max(F.struct("ts", "event_id", F.col("event_type").alias("status"))).alias("newest")
        batch.groupBy("user_id").agg(newest, F.count("*").alias("updates"), F.max("event_id").alias("last_event")).write.mode("overwrite").parquet(f"{home}/log/epoch={epoch}")

    place = spark._jvm.org.apache.hadoop.fs.Path(source)
    reader = spark.readStream.schema(schema)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():  # a stream watches a folder
        reader, source = reader.option("pathGlobFilter", place.getName()), place.getParent().toString()
    rows = reader.parquet(source)
    rows.writeStream.foreachBatch(fold).option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    log = spark.read.parquet(f"{home}/log")
    return log.groupBy("user_id").agg(F.max("newest").alias("m"), F.sum("updates").alias("updates"), F.max("last_event").alias("last_event")).select("user_id", F.col("m.status").alias("status"), "updates", "last_event")
