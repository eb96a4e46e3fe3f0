"""RSS feeds: raw XML of a landing zone to typed episode rows. Fetching stays outside the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokenlake.functions import numbers as N
from spokenlake.functions import text as T

#: Elements are told by their local names; of several the first counts, also if it is empty, so all are read as arrays.
TEXTS = "ARRAY<STRING>"
ENCLOSURE = "ARRAY<STRUCT<_url: STRING, _type: STRING, _length: STRING>>"
ITEM = f"STRUCT<title: {TEXTS}, link: {TEXTS}, guid: {TEXTS}, pubDate: {TEXTS}, duration: {TEXTS}, enclosure: {ENCLOSURE}>"
SCHEMA = f"channel STRUCT<title: {TEXTS}, item: ARRAY<{ITEM}>>"


def feeds(spark: SparkSession, path: str) -> DataFrame:
    """One row for each stored feed document: feed_url (its path) and xml."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("feed_url"), F.col("value").alias("xml"))


def _first(values: Column) -> Column:
    return T.non_blank(F.get(values, 0))


def items(feeds: DataFrame) -> DataFrame:
    """Each item of each feed, and what is wrong with it or its feed (problem; null if nothing). A feed without items, or
    that is no feed, is one row with pos null."""
    parsed = feeds.select("feed_url", F.from_xml("xml", SCHEMA, {"ignoreNamespace": "true"}).alias("x"))
    found = parsed.select("feed_url", F.col("x.channel").alias("c"), F.posexplode_outer("x.channel.item").alias("pos", "i"))
    audio, kind = F.get("i.enclosure", 0)["_url"], F.get("i.enclosure", 0)
    guid = F.coalesce(_first(F.col("i.guid")), _first(F.col("i.link")), T.non_blank(audio))
    rows = found.select(
        T.hash_prefix(F.col("feed_url"), 16).alias("feed_id"), "feed_url", _first(F.col("c.title")).alias("feed_title"), "pos", T.episode_id(guid).alias("episode_id"), guid.alias("guid"), _first(F.col("i.title")).alias("title"),
        _first(F.col("i.link")).alias("link"), _first(F.col("i.pubDate")).alias("published_at"), _first(F.col("i.duration")).alias("duration"), T.non_blank(audio).alias("audio_url"),
        T.non_blank(kind["_type"]).alias("audio_type"), N.lenient_int(kind["_length"]).alias("audio_length_bytes"), T.audio_extension(T.non_blank(audio)).alias("extension"), F.col("c").isNotNull().alias("_feed"),
    )
    problem = F.when(~F.col("_feed"), "no_channel").when(F.col("feed_title").isNull(), "no_feed_title")
    given = F.when(F.col("title").isNull(), "no_title").when(F.col("audio_url").isNull(), "no_audio").when(F.col("extension").isNull(), "audio_type")
    return rows.withColumn("problem", F.coalesce(problem, F.when(F.col("pos").isNotNull(), given))).drop("_feed")


def problems(rows: DataFrame) -> DataFrame:
    """feed_url, pos, problem: what items() found, and identities that a feed has more than once (pos: the first place)."""
    again = rows.where("pos is not null and problem is null").groupBy("feed_url", "episode_id").agg(F.count("*").alias("n"), F.min("pos").alias("pos")).where("n > 1")
    return rows.where("problem is not null").select("feed_url", "pos", "problem").unionByName(again.select("feed_url", "pos", F.lit("repeated").alias("problem")))


def episodes(feeds: DataFrame, strict: bool = False) -> DataFrame:
    """feeds: feed_url, xml -> one row for each good item, in document order (pos). The identity is guid, else link, else
    audio url. ``strict`` leaves out every feed that has a problem, as one bad item or repeated identity stops its feed;
    ``problems`` lists them."""
    rows = items(feeds)
    good = rows.where("problem is null and pos is not null").drop("problem")
    return good.join(problems(rows).select("feed_url").distinct(), "feed_url", "left_anti") if strict else good
