"""Sequence operators: validation, contexts, runs, sessions, packing."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spokenlake.functions import numbers as N
from spokenlake.functions import text as T


def by(*keys: str, order: str) -> W:
    return W.partitionBy(*keys).orderBy(order)


def previous_context(segments: DataFrame, size: int = 200, default: str = "无") -> DataFrame:
    before = F.lag("text").over(by("doc_id", order="idx"))
    return segments.withColumn("context", F.coalesce(F.nullif(F.right(T.ws_collapse(before), F.lit(size)), F.lit("")), F.lit(default)))


def validate_sequence(segments: DataFrame, most_overlap_ms: int = 800) -> DataFrame:
    w = by("doc_id", order="idx")
    last_idx, last_end = F.lag("idx").over(w), F.lag("end_ms").over(w)
    return segments.withColumn("ordered", F.coalesce((F.col("idx") > last_idx) & (last_end - F.col("start_ms") <= most_overlap_ms), F.lit(True))).withColumn("contiguous", F.row_number().over(w) == F.col("idx"))


def context_windows(segments: DataFrame, rows: int = 2, size: int = 800) -> DataFrame:
    w = by("doc_id", order="idx")
    joined = lambda lo, hi: F.array_join(F.collect_list("text").over(w.rowsBetween(lo, hi)), "\n")
    return segments.withColumn("before", F.right(joined(-rows, -1), F.lit(size))).withColumn("after", F.left(joined(1, rows), F.lit(size)))


def offsets(segments: DataFrame) -> DataFrame:
    """Half-open character ranges of the segments in their joined text (one separator between two)."""
    before = F.sum(F.length("text") + 1).over(by("doc_id", order="idx").rowsBetween(W.unboundedPreceding, -1))
    return segments.withColumn("start", F.coalesce(before, F.lit(0)).cast("long")).withColumn("stop", F.col("start") + F.length("text"))


def islands(frames: DataFrame, value: Column) -> DataFrame:
    """Runs of frames for which value holds: start, stop (beyond), size."""
    held = frames.where(value).withColumn("_g", F.col("frame") - F.row_number().over(by("doc_id", order="frame")))
    return held.groupBy("doc_id", "_g").agg(F.min("frame").alias("start"), (F.max("frame") + 1).alias("stop"), F.count("*").alias("size"), F.sum("energy").alias("energy")).drop("_g")


def longest_run(frames: DataFrame, value: Column) -> DataFrame:
    """The longest run; of equal ones the first."""
    best = islands(frames, value).groupBy("doc_id").agg(F.max(F.struct("size", (-F.col("start")).alias("back"))).alias("b"))
    return best.select("doc_id", (-F.col("b.back")).alias("start"), F.col("b.size").alias("size"))


def sessions(rows: DataFrame, key: str, at: Column, gap: int) -> DataFrame:
    """Groups of rows of a key without ``gap`` or more between neighbours: start, stop, n."""
    w = W.partitionBy(key).orderBy("_at")
    marked = rows.withColumn("_at", at).withColumn("_new", F.coalesce(F.col("_at") - F.lag("_at").over(w) >= gap, F.lit(True)).cast("int"))
    return marked.withColumn("session", F.sum("_new").over(w)).groupBy(key, "session").agg(F.min("_at").alias("start"), F.max("_at").alias("stop"), F.count("*").alias("n"))


def next_where(rows: DataFrame, key: str, order: str, flag: str, width: int = 4096) -> DataFrame:
    """The smallest later position (a whole number) at which flag holds. In two levels, so that a key with most rows is
    many tasks: inside runs of ``width`` positions, and over the runs' first such positions."""
    cut = rows.withColumn("_run", F.floor(F.col(order) / width))
    held = F.when(F.col(flag), F.col(order))
    after = lambda *keys: W.partitionBy(*keys).rowsBetween(W.unboundedPreceding, -1)  # noqa: E731 - a growing frame: linear
    inside = cut.withColumn("_here", F.last(held, ignorenulls=True).over(after(key, "_run").orderBy(F.desc(order))))
    firsts = cut.groupBy(F.col(key).alias("_key"), F.col("_run").alias("_at")).agg(F.min(held).alias("_first"))
    later = firsts.withColumn("_later", F.last("_first", ignorenulls=True).over(after("_key").orderBy(F.desc("_at")))).drop("_first")
    joined = inside.join(later, inside[key].eqNullSafe(later["_key"]) & (inside["_run"] == later["_at"]))
    return joined.withColumn("next", F.coalesce("_here", "_later")).drop("_run", "_here", "_key", "_at", "_later")


PACKED = "doc_id long, chunk long, first_idx long, last_idx long, n_chars long"


def pack(segments: DataFrame, most: int, overlap: bool) -> DataFrame:
    """Greedy packing of a document's segments into chunks of at most ``most`` characters, separators included.

    With overlap a chunk begins with the last segment of the one before, if both fit. What is packed next depends on the
    text before it, so a task streams through its documents' sorted rows and holds a few numbers. A segment longer than
    ``most`` is a chunk of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, chunk, first, last, chars, held, before = None, 0, 0, 0, 0, 0, 0
        for batch in batches:
            out: list[tuple] = []
            for d, i, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if d != doc:
                    if held:
                        out.append((doc, chunk, first, last, chars))
                    doc, chunk, first, chars, held = d, 1, i, 0, 0
                if held and chars + 1 + size > most:
                    out.append((doc, chunk, first, last, chars))
                    seeded = overlap and before + 1 + size <= most
                    chunk, first, chars, held = chunk + 1, last if seeded else i, before if seeded else 0, int(seeded)
                chars += size + (1 if chars else 0)
                last, before, held = i, size, held + 1
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(5)], names=["doc_id", "chunk", "first_idx", "last_idx", "n_chars"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (doc, chunk, first, last, chars)], names=["doc_id", "chunk", "first_idx", "last_idx", "n_chars"])

    sized = segments.select("doc_id", F.col("idx").cast("long"), F.length("text").cast("long"))
    return sized.repartition("doc_id").sortWithinPartitions("doc_id", "idx").mapInArrow(run, PACKED)


def boundary_records(boundaries: DataFrame, overlap: int) -> DataFrame:
    """boundaries: doc_id, stop, is_natural -> in order, where each segment begins, where its output begins (``overlap``
    frames earlier after a forced cut), and which boundary is the last."""
    w = by("doc_id", order="stop")
    start = F.coalesce(F.lag("stop").over(w), F.lit(0))
    forced = ~F.coalesce(F.lag("is_natural").over(w), F.lit(True))
    out = boundaries.withColumn("start", start).withColumn("output_start", F.greatest(F.lit(0), start - F.when(forced, overlap).otherwise(0)))
    return out.withColumn("is_terminal", F.lead("stop").over(w).isNull()).select("doc_id", "stop", "is_natural", "start", "output_start", "is_terminal")


def subtoken_tags(tokens: DataFrame, predictions: DataFrame, tags: list[str]) -> DataFrame:
    """tokens: doc_id, frame, parts; predictions: doc_id, predictions (tag numbers, one a part) -> the tag of the last part."""
    last = F.sum("parts").over(by("doc_id", order="frame").rowsBetween(W.unboundedPreceding, 0))
    at = tokens.withColumn("_last", last).join(predictions, "doc_id")
    names = F.array(*[F.lit(t) for t in tags])
    return at.select("doc_id", "frame", F.get(names, F.get("predictions", F.col("_last").cast("int") - 1)).alias("tag"))


def progress(rows: DataFrame, key: str, step: int = 10) -> DataFrame:
    """rows: key, done, total -> those at which another multiple of ``step`` per cent is crossed."""
    crossed = F.floor(F.col("done") * 100 / (F.col("total") * step))
    marked = rows.withColumn("_s", crossed).withColumn("_before", F.coalesce(F.lag("_s").over(by(key, order="done")), F.lit(0)))
    return marked.where("_s > _before").select(key, "done", "total", (F.col("_s") * step).cast("long").alias("crossed"))


def joined_islands(frames: DataFrame, value: Column, gap: int, least: int) -> DataFrame:
    """Runs that pauses shorter than ``gap`` frames join, with ``least`` or more frames that hold; a trailing pause is out."""
    w = by("doc_id", order="frame")
    held = frames.where(value).withColumn("_new", F.coalesce(F.col("frame") - F.lag("frame").over(w) - 1 >= gap, F.lit(True)).cast("int"))
    grouped = held.withColumn("_k", F.sum("_new").over(w)).groupBy("doc_id", "_k").agg(F.min("frame").alias("start"), (F.max("frame") + 1).alias("stop"), F.count("*").alias("speech"))
    return grouped.where(F.col("speech") >= least).drop("_k")


def sentences(lines: DataFrame, char_ms: int) -> DataFrame:
    """lines: doc_id, idx, text, start_ms; each character takes ``char_ms``. Sentences end after their marks; the rest of a
    line is one too. start_ms and end_ms are those of the first and last character that is no white space; a sentence
    without any is left out."""
    # The marks that end a sentence.
    parts = lines.select("doc_id", "idx", "start_ms", F.posexplode(F.split("text", "(?<=[。！？!?；;])")).alias("pos", "sentence"))
    before = F.coalesce(F.sum(F.length("sentence")).over(by("doc_id", "idx", order="pos").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    lead = F.length("sentence") - F.length(F.regexp_replace("sentence", f"^{T.WS}+", ""))
    tail = F.length(F.regexp_replace("sentence", f"{T.WS}+$", ""))
    found = parts.withColumn("_before", before).where(T.strip(F.col("sentence")) != "")
    return found.select("doc_id", "idx", T.strip(F.col("sentence")).alias("sentence"), (F.col("start_ms") + char_ms * (F.col("_before") + lead)).alias("start_ms"), (F.col("start_ms") + char_ms * (F.col("_before") + tail)).alias("end_ms"))


def assess(frames: DataFrame, covered: Column, frame_ms: int = 16, long_gap_ms: int = 2000) -> DataFrame:
    """frames: doc_id, frame, is_speech; covered: whether aligned text covers a frame -> one assessment a document: the
    share of speech between the first and last covered frame, the longest uncovered speech (of equal ones the first),
    and what follows from them."""
    marked = frames.withColumn("_c", covered)
    span = marked.where("_c").groupBy("doc_id").agg(F.min("frame").alias("lo"), (F.max("frame") + 1).alias("hi"))
    inside = F.col("is_speech") & (F.col("frame") >= F.col("lo")) & (F.col("frame") < F.col("hi"))
    share = marked.join(span, "doc_id", "left").groupBy("doc_id").agg(F.count_if("is_speech").alias("speech"), F.count_if(inside).alias("covered"), F.count("lo").alias("aligned"))
    gap = longest_run(marked, F.col("is_speech") & ~F.col("_c")).select("doc_id", (F.col("start") * frame_ms).alias("gap_start_ms"), (F.col("size") * frame_ms).alias("gap_ms"))
    out = share.join(gap, "doc_id", "left").withColumn("gap_ms", F.coalesce("gap_ms", F.lit(0))).withColumn("gap_start_ms", F.coalesce("gap_start_ms", F.lit(0)))
    status = F.when(F.col("speech") == 0, "no_speech").otherwise(N.coverage_status(F.lit(True), F.col("aligned") > 0, F.col("covered") / F.col("speech")))
    out = out.withColumn("status", status).withColumn("long_gap", F.col("gap_ms") > long_gap_ms)
    return out.select("doc_id", "speech", "covered", "gap_start_ms", "gap_ms", "status", N.anomalous(F.col("gap_ms"), F.col("status")).alias("anomalous"), N.needs_probe(F.col("gap_ms"), F.col("status")).alias("probe"))
