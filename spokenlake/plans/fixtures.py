"""Views of the driver's tables in the shapes that the engine's operators read, and the same views as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as timed segments, 60 ms a character."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "text"))
    before = F.sum(F.length("text")).over(W.partitionBy("doc_id").orderBy("p").rowsBetween(W.unboundedPreceding, -1))
    out = lines.select("doc_id", (F.col("p") + 1).alias("idx"), "text", (60 * F.coalesce(before, F.lit(0))).cast("long").alias("start_ms"))
    return out.withColumn("end_ms", F.col("start_ms") + 60 * F.greatest(F.lit(1), F.length("text")))


SEG = """lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS idx FROM documents),
seg AS (SELECT doc_id, CAST(idx AS INT) AS idx, text, CAST(60 * coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_ms,
CAST(60 * coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 60 * greatest(1, length(text)) AS BIGINT) AS end_ms FROM lines)"""


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a deterministic stand-in for the model extracts: a line's first capitalised word, with the line as evidence."""
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("grp"), F.posexplode(F.split("text", "\n")).alias("p", "evidence"))
    name = F.regexp_extract("evidence", "[A-Z][a-z]+", 0)
    odd = F.pmod(F.col("grp") * 31 + F.col("p") + 1, F.lit(7)) == 0
    return lines.select("grp", (F.col("p") + 1).alias("pos"), F.when(odd & (name != ""), F.concat(F.lit("  "), F.upper(name), F.lit(" "))).otherwise(name).alias("name"), "evidence")


WSC = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def strip_sql(expression: str) -> str:
    return f"regexp_replace({expression}, '^{WSC}+|{WSC}+$', '', 'g')"



MEN = r"""lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS idx FROM documents),
men AS (SELECT doc_id AS grp, CAST(idx AS INT) AS pos, CASE WHEN (doc_id * 31 + idx) % 7 = 0 AND regexp_extract(text, '[A-Z][a-z]+') <> '' THEN '  ' || upper(regexp_extract(text, '[A-Z][a-z]+')) || ' ' ELSE regexp_extract(text, '[A-Z][a-z]+') END AS name, text AS evidence FROM lines),
good AS (SELECT *, lower(trim(name)) AS name_key FROM men WHERE trim(name) <> '' AND """ + strip_sql("evidence") + """ <> ''),
once AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY grp, name_key ORDER BY pos) = 1)"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents as frames of a speech mask: speech without digits, dots, commas, bars and line ends."""
    words = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("p", "w"))
    return words.select("doc_id", F.col("p").cast("long").alias("frame"), (~F.col("w").rlike(r"[0-9.,|\n]") & (F.col("w") != "")).alias("is_speech"), F.pmod(F.length("w") * 13, F.lit(97)).cast("long").alias("energy"))


FRA = r"""fra AS (SELECT doc_id, frame, NOT regexp_matches(w, '[0-9.,|\n]') AND w <> '' AS is_speech, CAST((length(w) * 13) % 97 AS BIGINT) AS energy FROM
(SELECT doc_id, unnest(string_split(text, ' ')) AS w, CAST(generate_subscripts(string_split(text, ' '), 1) - 1 AS BIGINT) AS frame FROM documents))"""


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words as aligned tokens, 40 ms each, in clips of 50 frames."""
    return frames(spark, sf_dir).where("is_speech").select(
        "doc_id", F.floor(F.col("frame") / 50).cast("long").alias("clip"), "frame", (F.col("frame") * 40).alias("start_ms"), (F.col("frame") * 40 + 40).alias("end_ms"),
        (F.pmod(F.col("frame") * 37, F.lit(100)) / 100).alias("confidence"),
    )


ALI = FRA + """, ali AS (SELECT doc_id, CAST(frame // 50 AS BIGINT) AS clip, frame, frame * 40 AS start_ms, frame * 40 + 40 AS end_ms, ((frame * 37) % 100) / 100.0::DOUBLE AS confidence FROM fra WHERE is_speech)"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as attempts: coverage, gap and confidence from value and properties."""
    at = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select("user_id", "event_id", at.alias("attempt"), (F.pmod(F.col("event_id"), F.lit(11)) / 10).alias("coverage"), (k * 100).alias("gap_ms"), (F.pmod(F.col("event_id") * 7, F.lit(100)) / 100).alias("mean_conf"))


ATT = """att AS (SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS attempt, (event_id % 11) / 10.0::DOUBLE AS coverage,
CAST(json_extract_string(props, '$.k') AS BIGINT) * 100 AS gap_ms, ((event_id * 7) % 100) / 100.0::DOUBLE AS mean_conf FROM events)"""


def downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(s) for s in ("downloaded", "skipped", "failed", "pending", "downloaded")])
    p = table(spark, sf_dir, "pages")
    return p.select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("feed"), "page_id", F.element_at(kinds, F.pmod("page_id", F.lit(5)).cast("int") + 1).alias("status"), F.when(F.col("page_id") % 7 != 0, F.length("html").cast("long")).alias("bytes"))


DOW = """dow AS (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS feed, page_id, (['downloaded','skipped','failed','pending','downloaded'])[CAST(page_id % 5 AS INT) + 1] AS status, CASE WHEN page_id % 7 <> 0 THEN CAST(length(html) AS BIGINT) END AS bytes FROM pages)"""
