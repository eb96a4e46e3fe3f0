"""String expressions. All are Columns that stay inside code generation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.isspace knows it.
WS = r"[\p{IsWhite_Space}\x1c-\x1f]"
#: The Chinese numerals that stand for digits in acoustic text.
NUMERALS = "零一二三四五六七八九"
ZERO_WIDTH = "​‌‍﻿"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def ws_remove(c: Column) -> Column:
    return F.regexp_replace(c, WS, "")


def ws_collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, f"{WS}+", " "))


def fold(c: Column) -> Column:
    """Key of a name: stripped and lower-cased (full case folding differs for a few hundred code points, see README)."""
    return F.lower(strip(c))


def non_blank(c: Column) -> Column:
    """The stripped text; null if nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def clean_text(c: Column) -> Column:
    """Without zero-width signs, with LF line ends, at most one empty line in a row, stripped."""
    c = F.translate(c, ZERO_WIDTH, "")
    c = F.regexp_replace(c, r"\r\n|\r", "\n")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def content_length(c: Column) -> Column:
    """Characters that are neither white space nor punctuation."""
    return F.length(F.regexp_replace(c, r"[\p{IsWhite_Space}\x1c-\x1f\p{P}]", "")).cast("long")


def protected_count(c: Column) -> Column:
    """Digits and ASCII letters, which an editor may not remove."""
    return F.regexp_count(c, F.lit(r"[\p{Nd}A-Za-z]")).cast("long")


def has_speech(c: Column) -> Column:
    return c.rlike(r"[\p{L}\p{N}]")


def excerpt(evidence: Column, name: Column, size: int = 300, find: Callable[[Column, Column], Column] | None = None) -> Column:
    """At most ``size`` characters around the name's first place, moved back at the end; the beginning without a place.
    find: what tells the place, ``find_name`` if not given."""

    def cut(at: Column) -> Column:
        start = F.greatest(F.lit(0), F.least(F.length(evidence), F.greatest(F.lit(0), at - size // 2) + size) - size)
        return F.substring(evidence, F.when(at < 0, 0).otherwise(start) + 1, F.lit(size))

    # the place is looked for once, and only where the evidence has to be cut
    return F.when(F.length(evidence) <= size, evidence).otherwise(F.transform(F.array(F.coalesce((find or find_name)(evidence, name), F.lit(-1))), cut)[0])


def find_verbatim(source: Column, name: Column) -> Column:
    """Where the name, without white space around it, first stands in the source as it is written, case aside: a position
    from 0, or null. Signs are folded one to one (only U+0130 has a longer lower case), so positions are the source's."""
    wanted, folded = (F.lower(F.translate(c, "\u0130", "i")) for c in (strip(name), source))
    at = F.instr(folded, wanted) - 1
    return F.when((at >= 0) & (wanted != ""), at)


def find_name(source: Column, name: Column) -> Column:
    """Where the name first stands in the source, white space and case aside: a position from 0 in the source as it is, or
    null. The place is found in the folded text without white space and counted back over the source's words; where
    folding changes a length, over its signs."""
    wanted = F.lower(ws_remove(name))
    at = F.instr(F.lower(ws_remove(source)), wanted) - 1
    begin = F.struct(F.lit(0).alias("seen"), F.lit(0).alias("place"), F.lit(None).cast("int").alias("found"))

    def word(s: Column, w: Column) -> Column:
        size = F.length(w)
        here = F.when(s["found"].isNull() & (at < s["seen"] + size), s["place"] + at - s["seen"]).otherwise(s["found"])
        return F.struct((s["seen"] + size).alias("seen"), (s["place"] + size + 1).alias("place"), here.alias("found"))

    def sign(s: Column, c: Column) -> Column:
        size = F.length(ws_remove(F.lower(c)))
        here = F.when(s["found"].isNull() & (at < s["seen"] + size), s["place"]).otherwise(s["found"])
        return F.struct((s["seen"] + size).alias("seen"), (s["place"] + 1).alias("place"), here.alias("found"))

    by_words = F.reduce(F.split(source, WS), begin, word, lambda s: s["found"])
    by_signs = F.reduce(F.split(source, ""), begin, sign, lambda s: s["found"])
    return F.when((at >= 0) & (wanted != ""), F.when(F.length(F.lower(source)) == F.length(source), by_words).otherwise(by_signs))


def context_excerpt(text: Column, start: Column, stop: Column, size: int = 20) -> Column:
    """The signs around [start, stop): before, after, and whether the text goes on beyond them."""
    low, high = F.greatest(F.lit(0), start - size), F.least(F.length(text), stop + size)
    return F.struct(
        F.substring(text, (low + 1).cast("int"), (start - low).cast("int")).alias("before"), F.substring(text, (stop + 1).cast("int"), (high - stop).cast("int")).alias("after"),
        (low > 0).alias("prefix_truncated"), (high < F.length(text)).alias("suffix_truncated"),
    )


def segment_format(c: Column) -> Column:
    """mp3 or wav; null for any other name."""
    found = F.lower(strip(c))
    return F.when(found.isin("mp3", "wav"), found)


def plain_lines(c: Column) -> Column:
    """A Markdown answer as plain text: lines that are a code fence out, heading marks off."""
    c = F.regexp_replace(F.regexp_replace(c, r"\r\n?", "\n"), r"(?m)^[ \t]*```[A-Za-z0-9_-]*[ \t]*$\n?", "")
    return strip(F.regexp_replace(c, r"(?m)^[ \t]{0,3}#{1,6}[ \t]+", ""))


def split_names(c: Column) -> Column:
    """A configured list: names between commas (also full-width ones) and line ends, stripped, blank ones out."""
    return F.filter(F.transform(F.split(c, "[\n,，]+"), strip), lambda x: x != "")


def looks_like_markup(head: Column) -> Column:
    """Whether a body's first signs are those of HTML, XML or JSON, which an audio file never begins with."""
    return F.lower(F.regexp_replace(F.left(head, F.lit(64)), f"^{WS}+", "")).rlike(r"^(<!doctype html|<html|<\?xml|\{|\[)")


def strip_code_fence(c: Column) -> Column:
    inner = F.regexp_extract(strip(c), r"(?s)^```(?:json)?\s*(.*?)\s*```$", 1)
    return F.when(inner != "", inner).otherwise(strip(c))


def acoustic(c: Column) -> Column:
    """Numerals for digits, no white space, punctuation or symbols, ASCII letters in upper case."""
    c = F.translate(c, "0123456789abcdefghijklmnopqrstuvwxyz", NUMERALS + "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return F.regexp_replace(c, r"[\p{IsWhite_Space}\x1c-\x1f\p{P}\p{S}]", "")


def show_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\r\n|\r|\n", "↵")


def token_text(c: Column) -> Column:
    return F.replace(c, F.lit("▁"), F.lit(" "))


def is_control_token(c: Column) -> Column:
    return c.startswith("<") & c.endswith(">")


# Keys


def hash_prefix(c: Column, size: int) -> Column:
    return F.left(F.sha2(c, 256), F.lit(size))


def episode_id(guid: Column) -> Column:
    return F.when((F.length(guid) <= 120) & guid.rlike("^[A-Za-z0-9._-]+$"), guid).otherwise(hash_prefix(guid, 24))


def url_episode_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"^https?://[^/?#]*/episode/([0-9A-Za-z]{24})/*(?:[?#].*)?$", 1), F.lit(""))


def checkpoint_key(eid: Column, url: Column) -> Column:
    return F.coalesce(eid, F.concat(F.lit("url_"), hash_prefix(url, 16)))


def trace_id(index: Column, eid: Column) -> Column:
    return F.format_string("%03d-%s", index, F.when(F.length(eid) >= 8, F.right(eid, F.lit(8))).otherwise(F.rpad(eid, 8, "0")))


def audio_extension(url: Column) -> Column:
    """The suffix of an http(s) address of audio, in small letters; null for others."""
    # The audio suffixes.
    known = (".aac", ".aiff", ".ape", ".flac", ".m4a", ".mp3", ".mp4", ".ogg", ".wav", ".webm", ".wma")
    found = F.lower(F.regexp_extract(F.try_parse_url(url, F.lit("PATH")), r"[^/](\.[^./]+)$", 1))
    return F.when(url.rlike("(?i)^https?://[^/?#]") & found.isin(*known), found)


def media_type_ok(content_type: Column) -> Column:
    kind = F.trim(F.split_part(F.lower(content_type), F.lit(";"), F.lit(1)))
    return ~(kind.startswith("text/") | kind.rlike(r"[/+](json|xml)$"))


def article(title: Column, body: Column, default: str = "Transcript") -> Column:
    return F.concat(F.lit("# "), F.coalesce(F.nullif(ws_collapse(title), F.lit("")), F.lit(default)), F.lit("\n\n"), strip(body), F.lit("\n"))
