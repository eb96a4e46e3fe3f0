"""The catalog of named feeds, a small TOML file, and references to it."""

from __future__ import annotations

import tomllib
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokenlake.functions import text as T

#: A catalog is configuration; beyond this many names it belongs in a table.
MOST_NAMES = 10_000


def read_catalog(path: str) -> dict[str, str]:
    """Names and urls of the table [podcasts]; blank or repeated names and urls that are not http(s) are refused."""
    with open(path, "rb") as f:
        given = tomllib.load(f).get("podcasts")
    if not isinstance(given, dict) or not given:
        raise ValueError(f"{path} has no podcasts")
    out: dict[str, str] = {}
    for name, url in given.items():
        key = name.strip()
        if not key or key in out or not isinstance(url, str) or urlsplit(url.strip()).scheme not in ("http", "https"):
            raise ValueError(f"{path}: bad entry {name!r}")
        out[key] = url.strip()
    return out


def catalog_table(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    if len(names) > MOST_NAMES:
        raise ValueError("the catalog is too large to broadcast")
    return spark.createDataFrame(sorted(names.items()), "catalog_name string, catalog_url string")


def resolve(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds feed_url: the reference itself if it is a url, else the catalog's; null if the name is unknown."""
    named = rows.join(F.broadcast(catalog), T.strip(F.col("reference")) == F.col("catalog_name"), "left")
    return named.withColumn("feed_url", F.when(F.lower(T.strip(F.col("reference"))).rlike("^https?://"), T.strip(F.col("reference"))).otherwise(F.col("catalog_url"))).drop("catalog_name", "catalog_url")
