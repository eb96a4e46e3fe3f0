"""License scans by diagonal voting, with DataFrame operations only.

The hashes of all runs of ``GRAM`` words of a document join those of the templates. A hit at word i of the document and
word j of a template votes for the diagonal i - j, where the template would start. Neighbouring diagonals, as words that
were put in or left out make them, are merged. A merged span is verified: its runs must be the template's words, and only
those count that stand in the document in the template's order. A span that so covers enough of its template gives its
label, unless a better one covers the same words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import documents

GRAM = 3
#: Diagonals so close merge; and the share of a template's runs that a merged span must hold.
NEAR, COVER = 4, 0.6
#: What separates words: all ASCII but digits and letters. A word's letters A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The one sign whose lower case is an ASCII letter; it must not become one.
KELVIN = "\u212a"

# The base phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
# Texts of well-known public licenses and their notices, as words, and their labels.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
        "subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is "
        "without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors "
        "or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software", "mit",
    ),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in "
        "all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall "
        "the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or "
        "other tortious action arising out of or in connection with the use or performance of this software", "isc",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above "
        "copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and or other materials provided with the distribution", "bsd",
    ),
    (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in "
        "writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language "
        "governing permissions and limitations under the license", "apache-2",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the "
        "license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or "
        "fitness for a particular purpose see the gnu general public license for more details", "gpl-3",
    ),
    (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to "
        "anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", "zlib",
    ),
)


def plain_words(text: Column) -> Column:
    """The text's words with one blank between them."""
    return F.trim(F.regexp_replace(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit("\ufffd"))), BETWEEN, " "))


def grams(text: Column) -> Column:
    """All runs of GRAM words, in order, with one blank between words. Each match takes one word and looks ahead at the
    run after it, and begins at a word only and never goes back, so the text is read once; a first word is put in front for the run at the beginning."""
    run = " ".join(["[^ ]++"] * GRAM)
    return F.regexp_extract_all(F.concat(F.lit("^ "), plain_words(text)), F.lit(f"(?<![^ ])[^ ]++ (?=({run}))"), F.lit(1))


def template_table(spark: SparkSession, phrases: tuple = PHRASES, templates: tuple = TEMPLATES) -> DataFrame:
    """One row for each run of each template; its size is that of the fixed values."""
    rows = [(i, i < len(phrases), label, len(text.split()) - GRAM + 1, text) for i, (text, label) in enumerate((*phrases, *templates))]
    table = spark.createDataFrame(rows, "template int, base boolean, label string, runs int, text string")
    table = table.select("template", "base", "label", "runs", F.posexplode(grams(F.col("text"))).alias("place", "words"))
    return table.withColumn("gram", F.xxhash64("words"))


def in_order(hits: Column) -> Column:
    """covered, start, stop of hits (place, at) sorted by place: each place counts once, at the first spot that lies after
    those of the places before it; what stands out of order does not count. start is where the span begins."""
    begin = F.struct(F.lit(0).alias("covered"), F.lit(-1).alias("place"), F.lit(-1).alias("at"), F.lit(None).cast("int").alias("start"))

    def step(s: Column, h: Column) -> Column:
        after = (h["place"] > s["place"]) & (h["at"] > s["at"])
        return F.when(after, F.struct((s["covered"] + 1).alias("covered"), h["place"].alias("place"), h["at"].alias("at"), F.coalesce(s["start"], h["at"]).alias("start"))).otherwise(s)

    return F.reduce(hits, begin, step, lambda s: F.struct(s["covered"].alias("covered"), s["start"].alias("start"), s["at"].alias("stop")))


def best_spans(spans: Column) -> Column:
    """Without spans that a better one of another label meets: one that covers more runs, of equals more of its template."""
    better = lambda a, b: (a["covered"] > b["covered"]) | ((a["covered"] == b["covered"]) & (a["share"] > b["share"]))
    meets = lambda a, b: (a["start"] <= b["stop"]) & (b["start"] <= a["stop"]) & (a["label"] != b["label"])
    return F.filter(spans, lambda b: ~F.exists(spans, lambda a: meets(a, b) & better(a, b)))


def scan_documents(docs: DataFrame, phrases: tuple = PHRASES, templates: tuple = TEMPLATES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans; a row for each document.

    n_base counts the places where a base phrase stands; first_word and last_word are their smallest and largest starts
    (null without any). labels adds those of the spans found; score is the largest covered share of their templates, 1 with
    a base phrase, 0 without any. spans lists them: template, label, first word, last word, covered share, covered runs;
    of spans that meet the better one stays, and of equally good ones all. Null and empty texts have no words; texts are
    read whole. Rows that repeat give the same row again; other columns are not read; empty table: no rows. Only runs that
    hit a template leave the scan.
    """
    spark = docs.sparkSession
    text = docs[text_column]
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"))
    counted = rows.select("doc_id", "key", plain_words(F.col("text")).alias("words")).select("doc_id", "key", F.when(F.col("words") == "", 0).otherwise(F.size(F.split("words", " "))).cast("long").alias("n_words"))
    # outer, as for the other kind the optimizer tests the runs' number first and so makes them twice
    runs = rows.select("doc_id", "key", F.posexplode_outer(grams(F.col("text"))).alias("at", "found")).withColumn("gram", F.xxhash64("found"))
    # equal hashes are verified by their words
    hits = runs.join(F.broadcast(template_table(spark, phrases, templates)), "gram").where(F.col("found") == F.col("words"))
    votes = hits.groupBy("doc_id", "key", "template", "base", "label", "runs", (F.col("at") - F.col("place")).alias("diagonal")).agg(F.collect_set("place").alias("places"))
    line = W.partitionBy("doc_id", "key", "template").orderBy("diagonal")
    votes = votes.withColumn("apart", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > NEAR, F.lit(True)).cast("int")).withColumn("span", F.sum("apart").over(line))
    whole = F.col("base") & (F.size("places") == F.col("runs"))
    # of a hit its place in the template and in the document
    stands = F.transform("places", lambda p: F.struct(p.alias("place"), (F.col("diagonal") + p).alias("at")))
    spans = votes.groupBy("doc_id", "key", "template", "base", "label", "runs", "span").agg(
        F.array_sort(F.flatten(F.collect_list(stands))).alias("hits"), F.count_if(whole).alias("exact"), F.min(F.when(whole, F.col("diagonal"))).alias("first"), F.max(F.when(whole, F.col("diagonal"))).alias("last"),
    )
    spans = spans.withColumn("v", in_order(F.col("hits"))).select("*", F.col("v.covered").alias("covered"), F.col("v.start").alias("start"), (F.col("v.stop") + GRAM - 1).alias("stop")).drop("hits", "v")
    share = F.col("covered") / F.col("runs")
    kept = F.when(share >= COVER, F.struct("template", "label", "start", "stop", share.alias("share"), "covered"))
    found = spans.groupBy("doc_id", "key").agg(
        F.sum("exact").alias("n_base"), F.min("first").cast("long").alias("first_word"), F.max("last").cast("long").alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("exact") > 0, F.col("label")))).alias("base"), F.array_sort(F.collect_list(kept)).alias("all_spans"),
    )
    found = found.withColumn("spans", best_spans(F.col("all_spans"))).drop("all_spans")
    found = found.select(
        "doc_id", "key", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union("base", F.transform("spans", lambda s: s["label"]))), ",").alias("labels"),
        F.greatest(F.array_max(F.transform("spans", lambda s: s["share"])), F.when(F.col("n_base") > 0, 1.0)).alias("score"), "spans",
    )
    f = found.withColumnsRenamed({"doc_id": "_doc", "key": "_key"})
    joined = counted.join(f, counted["doc_id"].eqNullSafe(f["_doc"]) & (counted["key"] == f["_key"]), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), "spans",
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of each document of the table."""
    return scan_documents(documents(spark, sf_dir)).drop("spans")
