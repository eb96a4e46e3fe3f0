"""Checkpoints as tables: an append-only log of states, what of it can be used, and checks across artefacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spokenlake.functions import text as T

# The states of a model call.
STATES = ("prepared", "success", "failed")
STATE_SCHEMA = "key string, status string, url string, prompt string, response string, companies array<struct<name: string, evidence: string>>, filtered_count int, error string, updated_at string"


def states(rows: DataFrame, status: str, **extra: Column) -> DataFrame:
    """rows: key, url, prompt, updated_at -> records of STATE_SCHEMA in one state. Only a success has companies, only a
    failure an error; a prepared call has no response yet."""
    if status not in STATES:
        raise ValueError(status)
    kinds = dict(x.split(" ", 1) for x in ("response string", "companies array<struct<name: string, evidence: string>>", "filtered_count int", "error string"))
    value = {n: extra.get(n, F.lit(None)).cast(k) for n, k in kinds.items()}
    if status == "prepared":
        value["response"] = F.lit(None).cast("string")
    if status != "success":
        value |= {"companies": F.array().cast(kinds["companies"]), "filtered_count": F.lit(0)}
    if status != "failed":
        value["error"] = F.lit(None).cast("string")
    columns = {"key": F.col("key"), "status": F.lit(status), "url": F.col("url"), "prompt": F.col("prompt"), **value, "updated_at": F.col("updated_at")}
    return rows.select(*[columns[x.split(" ")[0]].alias(x.split(" ")[0]) for x in ("key s", "status s", "url s", "prompt s", "response s", "companies s", "filtered_count s", "error s", "updated_at s")])


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def valid_state(rows: DataFrame) -> Column:
    """Whether a record can be read back: a known state, texts that are not blank, companies with both fields."""
    complete = F.forall(F.coalesce("companies", F.array().cast(rows.schema["companies"].dataType)), lambda c: (T.non_blank(c["name"]).isNotNull()) & (T.non_blank(c["evidence"]).isNotNull()))
    return F.coalesce(F.col("status").isin(*STATES) & T.non_blank(F.col("url")).isNotNull() & T.non_blank(F.col("updated_at")).isNotNull() & F.col("filtered_count").isNotNull() & complete, F.lit(False))


def load(spark: SparkSession, path: str) -> DataFrame:
    """The newest record of each key, without those that are invalid: such a key counts as absent."""
    return latest(spark.read.schema(STATE_SCHEMA).parquet(path))


def latest(log: DataFrame) -> DataFrame:
    rest = [c for c in log.columns if c not in ("key", "updated_at")]
    newest = log.groupBy("key").agg(F.max_by(F.struct(*rest, "updated_at"), "updated_at").alias("m")).select("key", "m.*").select(*log.columns)
    return newest.where(valid_state(newest))


def segment_hits(expected: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Expected segments with their stored text, where every key is the same, nulls included."""
    s = stored.select(*[F.col(k).alias(f"_{k}") for k in keys], "text")
    on = F.lit(True)
    for k in keys:
        on = on & expected[k].eqNullSafe(s[f"_{k}"])
    return expected.join(s, on).drop(*[f"_{k}" for k in keys])


def usable_segments(records: DataFrame, sources: DataFrame) -> DataFrame:
    """records: source, segment_count, index, start_ms, end_ms; sources: source, path -> source, usable: the source is the
    same, all segments are there, and their indexes run from 1 without gaps."""
    numbered = records.withColumn("_n", F.row_number().over(W.partitionBy("source").orderBy("index")))
    per = numbered.groupBy("source").agg(F.bool_and(F.col("_n") == F.col("index")).alias("contiguous"), F.count("*").alias("n"), F.min("segment_count").alias("least"), F.max("segment_count").alias("most"), F.bool_and((F.col("start_ms") >= 0) & (F.col("start_ms") < F.col("end_ms"))).alias("timed"))
    good = F.col("contiguous") & F.col("timed") & (F.col("n") == F.col("least")) & (F.col("least") == F.col("most"))
    return sources.join(per, "source", "left").select("source", F.coalesce(good, F.lit(False)).alias("usable"))


def completed(manifests: DataFrame, articles: DataFrame, reports: DataFrame, segments: DataFrame) -> DataFrame:
    """key, completed: manifest (key, segment_count, text), article (key, article), quality report (key, evaluated) and
    segment records (key, index, text) agree: counts, joined text, article body, contiguous indexes."""
    joined = segments.groupBy("key").agg(F.count("*").alias("n"), F.min("index").alias("first"), F.max("index").alias("last"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("index", "text"))), lambda s: s["text"]), "\n").alias("joined"))
    all_ = manifests.join(articles, "key", "left").join(reports, "key", "left").join(joined, "key", "left")
    good = (F.col("segment_count") == F.col("n")) & (F.col("first") == 1) & (F.col("last") == F.col("n")) & (F.col("text") == F.col("joined")) & F.contains("article", T.strip(F.col("text"))) & (F.col("evaluated") == F.col("n"))
    return all_.select("key", F.coalesce(good, F.lit(False)).alias("completed"))
