"""What the operators of this subpackage share: written tables, two-level running totals, per-process caches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: ASCII white space, the word separator of the word-count contracts.
BETWEEN_WORDS = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. A local session without one gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    found = process_cache().setdefault("shared_dir", None) or "file://" + tempfile.mkdtemp(prefix="spokenlake-")
    process_cache()["shared_dir"] = found
    return found


def written(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and survives lost executors.

    Inside ``temporary()`` the table goes when the block ends; one that is to be kept goes with the block around it, if
    there is one.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/spokenlake/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    if len(_TEMPORARY) > keep:
        _TEMPORARY[-1 - keep].append(out)
    return out


#: Tables of the open ``temporary()`` blocks, on the driver.
_TEMPORARY: list[list[DataFrame]] = []


@contextlib.contextmanager
def temporary() -> Iterator[None]:
    """Removes the tables that were written inside, at the end: all that is read later must have been written and kept."""
    _TEMPORARY.append([])
    try:
        yield
    finally:
        for table in _TEMPORARY.pop():
            forget(table)


def forget(df: DataFrame) -> None:
    """Removes a table of written() that no later plan reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._written_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def process_cache(owner: str = "") -> dict:
    """A dict that lives as long as the Python process, also across tasks.

    With an owner, the dict of that operator: what others have kept is released first, as a reused worker runs the stages
    of a pipeline one after another.
    """
    kept = sys.modules.setdefault("_spokenlake_process_cache", types.ModuleType("_spokenlake_process_cache")).__dict__
    if not owner:
        return kept
    owned = kept.setdefault("owned", {})
    if owner not in owned:
        owned.clear()
        owned[owner] = {}
        release_memory()
    return owned[owner]


def release_memory() -> None:
    """Gives memory that is free in this process back to the system, where the C library can."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, BETWEEN_WORDS))).cast("long")


def running_total(df: DataFrame, group: list[str], key: str, value: str, total: str, buckets: int = 1024) -> DataFrame:
    """Adds the sum of ``value`` over the group's earlier rows, in two levels so that no task holds a whole group.

    Rows are dealt into ``buckets`` hash buckets of ``key``; the order inside a group is (bucket, key), which is fixed by
    the data. A group's bucket totals (at most ``buckets`` rows) are summed by one window, rows inside a bucket by another.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    rows = df.withColumn("_bucket", bucket)
    sums = rows.groupBy(*group, "_bucket").agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(*group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    renamed = sums.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_bucket").alias("_b"), "_start")
    on = [rows[g].eqNullSafe(renamed[f"_g{i}"]) for i, g in enumerate(group)] + [rows["_bucket"] == renamed["_b"]]
    inner = W.partitionBy(*group, "_bucket").orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value).over(inner), F.lit(0))
    joined = rows.join(renamed, on)
    return joined.withColumn(total, F.col("_start") + inside).drop("_bucket", "_b", "_start", *[f"_g{i}" for i in range(len(group))])
