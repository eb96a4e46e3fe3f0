"""Corpus pipeline: language ID, near duplicates, personal data, mixing, encoding.

Each stage reads what the one before wrote and returns documents (doc_id, text, lang, source, n_chars); the last returns
token ids. Stages read these columns only, whatever others there are. Null and repeated ids are rows of their own in all
stages; null and empty texts are undetermined in language and go in the first; empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokenlake.llm import bpe, jaccard, language, mixing, pii
from spokenlake.llm.common import forget, temporary, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document stays unless its language cannot be told at all, or the best is less likely than this.
LEAST_SCORE = 0.5
ORACLE_SQL = None  # language ID, the join, pseudonyms and encoding have no SQL


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is undetermined (no text, no letters) or told with a score below LEAST_SCORE. Rows
    that repeat are told alike; without rows to learn from all are undetermined."""
    told = language.identify(docs.select(*COLUMNS), *language.learned(docs))
    return told.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def numbered(docs: DataFrame, label: str) -> DataFrame:
    """docs with a number for each row, written once so that all later reads see the same one: a doc_id can be null or
    repeated, and tells no rows apart."""
    return written(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), label)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps exactly one row of each group of linked documents, the one with the smallest doc_id; rows with a null doc_id
    come last, and of equal ids any one stays. Linking goes by rows, so repeated and null ids are documents of their own."""
    rows = numbered(docs, "numbered")
    linked = jaccard.link_documents(rows, id_column="row").select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))
    kept = linked.join(rows.select("row", "doc_id"), "row").groupBy("component").agg(first.alias("first")).select(F.col("first.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms of the same format, row by row, so nulls and repeats stay; n_chars is counted anew, as addresses of the
    internet protocol can change their length."""
    return pii.pseudonymise(docs.select(*COLUMNS), pii.key_of(spark)).select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes of each document as many whole copies as the mix takes words of it, by its size: 0, 1 or 2; what is left of a
    copy decides by a hash of the document's place in its source, so that sources come near their targets. Each row counts
    on its own, also when ids are null or repeat. Documents without words stay once."""
    rows = numbered(docs, "numbered")
    taken = written(mixing.mix_documents(rows, id_column="row")[0].select(F.col("doc_id").alias("row"), "size", "taken", F.xxhash64("source", "start", F.lit(mixing.SEED)).alias("draw")), "taken")
    rest = F.pmod("draw", F.lit(1_000_000)) / 1_000_000
    copies = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.col("size") + rest).cast("int"))
    many = taken.select("row", copies.alias("copies")).where("copies > 0")
    return rows.join(many, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with their digest and that of the decoded text; null texts have none."""
    return bpe.encode_documents(docs, *bpe.default_vocabulary(), ids=True)


STAGES = [("language", keep_languages), ("near_duplicates", drop_near_duplicates), ("personal_data", hide_personal_data), ("mixing", mix_sources), ("encoding", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder. A stage's tables go when its output is written, and that when the next
    one's is; the result still reads the last but one."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with temporary():
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
        if before is not None:
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
