"""Episode pages: the JSON block inside the HTML, as typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokenlake.functions import text as T
from spokenlake.functions.python_text import strip_html

# Fixed value: the block of a page that holds its data.
BLOCK = r'(?s)<script id="__NEXT_DATA__" type="application/json">(.*?)</script>'


def episode_pages(pages: DataFrame) -> DataFrame:
    """pages: page_id, html -> title, content, audio_url, podcast_title; null where the block or a value is missing.

    content is the cleaned description, else the text of the notes.
    """
    value = lambda path: F.get_json_object("json", f"$.props.pageProps.{path}")
    block = pages.select("page_id", F.nullif(F.regexp_extract("html", BLOCK, 1), F.lit("")).alias("json")).where(F.col("json").isNotNull())
    described = F.nullif(T.clean_text(value("episode.description")), F.lit(""))
    notes = T.clean_text(strip_html(F.when(described.isNull(), value("episode.shownotes"))))  # Python sees only notes that count
    return block.select(
        "page_id", value("episode.title").alias("title"), F.coalesce(described, notes, F.lit("")).alias("content"),
        T.non_blank(value("episode.enclosure.url")).alias("audio_url"), T.non_blank(value("episode.podcast.title")).alias("podcast_title"),
    )
