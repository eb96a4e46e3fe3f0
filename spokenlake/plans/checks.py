"""Queries of checkpoints, sinks, scans of what was written, model calls and schedules, with their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spokenlake import sinks
from spokenlake.functions import text as T
from spokenlake.operators import checkpoints as C
from spokenlake.operators import models as P
from spokenlake.operators import resume
from spokenlake.operators import sequences as S
from spokenlake.plans import fixtures as X
from spokenlake.plans.registry import _STATE, _state, query
from spokenlake.streaming.incremental import new_home


def _place(spark: SparkSession, name: str) -> str:
    return f"{new_home(spark)}/{name}-{uuid.uuid4().hex}"


# Checkpoints


@query("""SELECT 'k' || event_id AS key, CASE WHEN event_id % 3 = 0 THEN 'prepared' WHEN event_id % 3 = 1 THEN 'success' ELSE 'failed' END AS status, CASE WHEN event_id % 3 = 1 THEN 'r' || event_id WHEN event_id % 3 = 2 AND event_id % 2 = 0 THEN 'half' END AS response,
CASE WHEN event_id % 3 = 1 THEN 1 ELSE 0 END AS companies, CASE WHEN event_id % 3 = 2 THEN 'broken' END AS error, CASE WHEN event_id % 3 = 0 THEN '2024-01-01' ELSE '2024-01-02' END AS updated_at FROM events WHERE NOT (event_id % 3 = 1 AND event_id % 7 = 0)""")
def checkpoint_states(spark: SparkSession, d: str) -> DataFrame:
    """Each call is prepared; a third succeeds, a third fails. Successes with a blank name cannot be read back."""
    e = X.table(spark, d, "events").select(F.concat(F.lit("k"), F.col("event_id").cast("string")).alias("key"), F.lit("https://h/e").alias("url"), F.lit("ask").alias("prompt"), "event_id")
    path = _place(spark, "states")
    C.append(C.states(e.withColumn("updated_at", F.lit("2024-01-01")), "prepared"), path)
    name = F.when(F.col("event_id") % 7 == 0, " ").otherwise("N")
    done = e.where("event_id % 3 = 1").withColumn("updated_at", F.lit("2024-01-02"))
    C.append(C.states(done, "success", response=F.concat(F.lit("r"), F.col("event_id").cast("string")), companies=F.array(F.struct(name.alias("name"), F.lit("v").alias("evidence"))), filtered_count=F.lit(2)), path)
    broken = e.where("event_id % 3 = 2").withColumn("updated_at", F.lit("2024-01-02"))
    C.append(C.states(broken, "failed", response=F.when(F.col("event_id") % 2 == 0, "half"), error=F.lit("broken")), path)
    return C.load(spark, path).select("key", "status", "response", F.size("companies").alias("companies"), "error", "updated_at")


@query("SELECT event_id, event_id % 5 NOT IN (0, 1, 2) AS valid FROM events")
def checkpoint_guards(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 5
    e = X.table(spark, d, "events").select("event_id", F.when(k == 0, "done").otherwise("success").alias("status"), F.when(k == 1, "  ").otherwise("https://h/e").alias("url"), F.lit("2024").alias("updated_at"), F.when(k != 2, 0).alias("filtered_count"), F.array(F.struct(F.lit("N").alias("name"), F.lit("v").alias("evidence"))).alias("companies"))
    return e.select("event_id", C.valid_state(e).alias("valid"))


@query("SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'new' WHEN 1 THEN 'not_success' WHEN 2 THEN 'blank_prompt' WHEN 3 THEN 'blank_response' WHEN 4 THEN 'url_changed' ELSE CASE WHEN doc_id % 4 = 1 THEN 'signature_changed' ELSE 'reuse' END END AS reason FROM documents")
def reuse_reasons(spark: SparkSession, d: str) -> DataFrame:
    w = X.table(spark, d, "documents").select("doc_id", F.lit("u").alias("url"))
    k = F.col("doc_id") % 6
    state = w.where(k > 0).select(
        "doc_id", F.when(k == 1, "failed").otherwise("success").alias("status"), F.when(F.col("doc_id") % 4 == 1, "old").otherwise("sig").alias("signature"), F.when(k == 2, "\n").otherwise("p").alias("prompt"),
        F.when(k != 3, "r").alias("response"), F.when(k == 4, "v").otherwise("u").alias("saved_url"),
    )
    return resume.reuse_reason(w, state, "doc_id", "sig")


@query(f"WITH {X.SEG} SELECT doc_id, idx, 't' || idx AS text FROM seg WHERE idx % 3 <> 0")
def segment_checkpoint_hits(spark: SparkSession, d: str) -> DataFrame:
    """Segment checkpoints are hits where all keys are the same, an absent model (null) included."""
    s = X.segments(spark, d).select("doc_id", "idx", "start_ms", "end_ms", F.when(F.col("idx") % 2 == 0, "m").alias("model"))
    path = _place(spark, "segments")
    sinks.write_json(s.withColumn("end_ms", F.when(F.col("idx") % 3 == 0, F.col("end_ms") + 1).otherwise(F.col("end_ms"))).withColumn("text", F.concat(F.lit("t"), F.col("idx").cast("string"))), path)
    stored = spark.read.schema("doc_id long, idx int, start_ms long, end_ms long, model string, text string").json(path)
    return C.segment_hits(s, stored, ["doc_id", "idx", "start_ms", "end_ms", "model"]).select("doc_id", "idx", "text")


@query(f"WITH {X.SEG}, c AS (SELECT doc_id, count(*) AS n FROM seg GROUP BY 1) SELECT d.doc_id AS source, CASE WHEN d.doc_id % 5 = 0 THEN false WHEN d.doc_id % 5 = 1 THEN n < 2 WHEN d.doc_id % 5 = 2 THEN false ELSE true END AS usable FROM documents d JOIN c USING (doc_id)")
def speech_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    """Manifests of speech segments: absent, with a gap after the first, with a wrong count, or whole."""
    s = X.segments(spark, d).select(F.col("doc_id").alias("source"), F.col("idx").alias("index"), "start_ms", "end_ms")
    manifest = sinks.segment_manifest(s).withColumn("segment_count", F.col("segment_count") + F.when(F.col("source") % 5 == 2, 1).otherwise(0))
    records = manifest.where("source % 5 <> 0").select("source", "segment_count", F.explode("segments").alias("x")).select("source", "segment_count", (F.col("x.index") + F.when((F.col("source") % 5 == 1) & (F.col("x.index") > 1), 1).otherwise(0)).alias("index"), "x.start_ms", "x.end_ms")
    return C.usable_segments(records, X.table(spark, d, "documents").select(F.col("doc_id").alias("source")))


@query("SELECT doc_id AS key, doc_id % 4 = 0 AS completed FROM documents WHERE regexp_matches(text, '[a-z]')")
def completed_transcripts(spark: SparkSession, d: str) -> DataFrame:
    """Manifest, article, report and segments agree, but for three kinds of disagreement."""
    s = X.segments(spark, d).join(X.table(spark, d, "documents").where(F.col("text").rlike("[a-z]")).select("doc_id"), "doc_id").select(F.col("doc_id").alias("key"), F.col("idx").alias("index"), "text")
    whole = s.groupBy("key").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("index", "text"))), lambda x: x["text"]), "\n").alias("text"))
    k = F.col("key") % 4
    manifests = whole.select("key", (F.col("n") + F.when(k == 1, 1).otherwise(0)).alias("segment_count"), "text")
    articles = whole.select("key", T.article(F.lit(" A  b "), F.when(k == 2, F.concat(F.lit("~"), F.reverse(T.strip(F.col("text"))), F.lit("~"))).otherwise(F.col("text"))).alias("article"))
    reports = whole.where(k != 3).select("key", F.col("n").alias("evaluated"))
    return C.completed(manifests, articles, reports, s)


@query("SELECT source, count(*) FILTER (doc_id % 3 = 0) AS kept, count(*) FILTER (doc_id % 3 <> 0) AS skipped FROM documents GROUP BY 1")
def existing_transcripts(spark: SparkSession, d: str) -> DataFrame:
    work = X.table(spark, d, "documents").select("source", "doc_id")
    kept, left = resume.split(work, work.where("doc_id % 3 = 0").select("doc_id"), "doc_id")
    both = kept.select("source", F.lit(1).alias("k")).unionByName(left.select("source", F.lit(0).alias("k")))
    return both.groupBy("source").agg(F.count_if(F.col("k") == 1).alias("kept"), F.count_if(F.col("k") == 0).alias("skipped"))


# Sinks, read back


@query(f"WITH {X.DOW} SELECT feed AS feed_url, count(*) AS episode_count, CAST(sum(coalesce(bytes, 0)) AS BIGINT) AS declared_total_bytes, false AS list_only, count(*) FILTER (status = 'downloaded') AS downloaded_count, count(*) FILTER (status = 'failed') AS failed_count, string_agg(page_id || ':' || status, ',' ORDER BY page_id) AS episodes FROM dow GROUP BY 1")
def feed_manifest(spark: SparkSession, d: str) -> DataFrame:
    e = X.downloads(spark, d).select(F.col("feed").alias("feed_url"), F.col("page_id").alias("pos"), F.col("page_id").cast("string").alias("episode_id"), "status", F.col("bytes").alias("audio_length_bytes"))
    path = _place(spark, "manifest")
    sinks.write_json(sinks.feed_manifest(e), path, overwrite=False)
    m = spark.read.schema("feed_url string, episode_count long, declared_total_bytes long, list_only boolean, downloaded_count long, failed_count long, episodes array<struct<episode_id: string, status: string>>").json(path)
    return m.withColumn("episodes", F.array_join(F.transform("episodes", lambda x: F.concat(x["episode_id"], F.lit(":"), x["status"])), ","))


@query(f"WITH {X.ALI}, c AS (SELECT doc_id, clip, count(*) AS n, count(*) FILTER (confidence < 0.05) AS low FROM ali GROUP BY 1, 2) SELECT doc_id AS key, count(*) AS segment_count, CAST(sum(low) AS BIGINT) AS suspicious, count(*) FILTER (low > 0) AS affected_count, coalesce(string_agg(CAST(clip AS VARCHAR), ',' ORDER BY clip) FILTER (low > 0), '') AS segments FROM c GROUP BY 1")
def quality_report_sink(spark: SparkSession, d: str) -> DataFrame:
    c = X.alignments(spark, d).groupBy(F.col("doc_id").alias("key"), F.col("clip").alias("index")).agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.collect_list("confidence").alias("confidences"))
    path = _place(spark, "quality")
    sinks.write_json(sinks.quality_report(c), path)
    r = spark.read.schema("key long, segment_count long, suspicious long, affected_count long, segments array<struct<index: long, low: long>>").json(path)
    return r.withColumn("segments", F.array_join(F.transform("segments", lambda x: x["index"].cast("string")), ","))


@query("SELECT source AS feed, count(*) AS total, count(*) FILTER (doc_id % 7 <> 0) AS success, count(*) FILTER (doc_id % 7 = 0) AS fail, sha256(string_agg(doc_id || CASE WHEN doc_id % 7 = 0 THEN ':late' ELSE '' END, ',' ORDER BY doc_id)) AS results FROM documents GROUP BY 1")
def batch_report(spark: SparkSession, d: str) -> DataFrame:
    ok = F.col("doc_id") % 7 != 0
    results = X.table(spark, d, "documents").select(F.col("source").alias("feed"), F.col("doc_id").alias("pos"), F.col("doc_id").cast("string").alias("episode"), ok.alias("ok"), F.when(~ok, "late").alias("error"))
    path = _place(spark, "batch")
    sinks.write_json(sinks.batch_report(results), path)
    r = spark.read.schema("feed string, total long, success long, fail long, results array<struct<episode: string, ok: boolean, error: string>>").json(path)
    return r.withColumn("results", F.sha2(F.array_join(F.transform("results", lambda x: F.concat(x["episode"], F.when(x["error"].isNotNull(), F.concat(F.lit(":"), x["error"])).otherwise(""))), ","), 256))


_EXT = f"{X.MEN}, m AS (SELECT 'f' || grp % 3 AS feed, grp AS episode, trim(name) AS name FROM once)"


@query(f"WITH {_EXT} SELECT feed, name, count(*) AS occurrence_count, count(DISTINCT episode) AS episodes FROM m GROUP BY 1, 2")
def extraction_summary(spark: SparkSession, d: str) -> DataFrame:
    from spokenlake.operators import mentions as M

    m = M.first_per_name(M.guarded(X.mentions(spark, d))).select(F.concat(F.lit("f"), (F.col("grp") % 3).cast("string")).alias("feed"), F.col("grp").alias("episode"), T.strip(F.col("name")).alias("name"), "evidence")
    path = _place(spark, "reports")
    sinks.write_reports(m, path)
    return spark.read.schema("feed string, name string, occurrence_count long, episodes long").json(f"{path}/summary")


@query(f"WITH {X.SEG} SELECT doc_id, idx, {X.strip_sql('text')} AS text, start_ms, end_ms FROM seg WHERE doc_id % 10 = 0")
def manifest_scan(spark: SparkSession, d: str) -> DataFrame:
    """Manifests written as JSON and read back, pruned to indexes, times and texts."""
    from spokenlake.sources.transcripts import segments, write_manifest

    s = X.segments(spark, d).where("doc_id % 10 = 0")
    path = _place(spark, "manifests")
    write_manifest(s.select(F.col("doc_id").cast("string").alias("title"), F.col("idx").alias("index"), "start_ms", "end_ms", "text"), path)
    return segments(spark, path, pruned=True, lines=True).where("valid").select(F.col("title").cast("long").alias("doc_id"), F.col("index").alias("idx"), "text", "start_ms", "end_ms")


# Work items, order, models


@query("SELECT source, doc_id, pos FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM documents) WHERE pos < 5")
def work_items(spark: SparkSession, d: str) -> DataFrame:
    """The first five items of each feed, in input order."""
    pos = F.row_number().over(W.partitionBy("source").orderBy("doc_id")) - 1
    return X.table(spark, d, "documents").select("source", "doc_id", pos.cast("long").alias("pos")).where("pos < 5")


def stub(prompts: list[str]) -> list[str]:
    """A deterministic stand-in for a text model: refuses, fails for a while, or answers, by the prompt's number."""
    out = []
    for p in prompts:
        k = int(p.split()[1])
        if k % 5 == 4:
            raise P.Retryable("busy")
        if k % 7 == 6:
            raise ValueError("broken")
        out.append("bad" if k % 3 == 0 and "again" not in p else f"answer {k}")
    return out


def reserve(prompts: list[str]) -> list[str]:
    return [f"reserve {p.split()[1]}" for p in prompts]


def refused(answer: str) -> str | None:
    return "again" if answer == "bad" else None


P.register("stub", lambda: stub)
P.register("reserve", lambda: reserve)

_CALL = "CASE WHEN doc_id % 5 = 4 THEN {a} WHEN doc_id % 7 = 6 THEN {b} WHEN doc_id % 3 = 0 THEN {c} ELSE {e} END"


@query(f"SELECT doc_id, {_CALL.format(a='NULL', b='NULL', c="'answer ' || doc_id", e="'answer ' || doc_id")} AS answer, {_CALL.format(a=3, b=1, c=2, e=1)} AS attempts, doc_id % 5 <> 4 AND doc_id % 7 <> 6 AS ok, {_CALL.format(a="'busy'", b="'broken'", c='NULL', e='NULL')} AS error FROM documents")
def model_calls(spark: SparkSession, d: str) -> DataFrame:
    """A model is asked up to three times; what it answered wrongly goes into the next prompt."""
    rows = X.table(spark, d, "documents").select("doc_id", F.concat(F.lit("ask "), F.col("doc_id").cast("string")).alias("prompt"))
    return P.call(rows, [P.backend("stub")], refused, wait=_no_wait).select("doc_id", "answer", "attempts", "ok", "error")


def _no_wait(seconds: float) -> None:
    """Tests and benches do not wait between attempts."""


@query(f"SELECT doc_id, {_CALL.format(a="'reserve ' || doc_id", b="'reserve ' || doc_id", c="'answer ' || doc_id", e="'answer ' || doc_id")} AS answer, {_CALL.format(a=4, b=2, c=2, e=1)} AS attempts, true AS ok FROM documents")
def fallback_calls(spark: SparkSession, d: str) -> DataFrame:
    rows = X.table(spark, d, "documents").select("doc_id", F.concat(F.lit("ask "), F.col("doc_id").cast("string")).alias("prompt"))
    return P.call(rows, [P.backend(" Stub "), P.backend("reserve")], refused, tasks=4, per_minute=1e12, wait=_no_wait).select("doc_id", "answer", "attempts", "ok")


@query("""WITH c AS (SELECT doc_id, unnest(range(0, doc_id % 4)) AS pos FROM documents), a AS (SELECT doc_id, pos, (doc_id * 10 + pos) AS k FROM c)
SELECT d.doc_id, count(k) FILTER (k % 5 <> 4 AND k % 7 <> 6) AS answers, coalesce(bool_and(k % 5 <> 4 AND k % 7 <> 6), false) AS ok, arg_min(CASE WHEN k % 5 = 4 THEN 'busy' ELSE 'broken' END, pos) FILTER (k % 5 = 4 OR k % 7 = 6) AS error, count(k) > 1 AND count(k) FILTER (k % 5 <> 4 AND k % 7 <> 6) > 0 AS merge FROM documents d LEFT JOIN a USING (doc_id) GROUP BY 1""")
def chunk_fan_out(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of an episode are asked on their own and meet again in order; one that fails fails its episode only."""
    e = X.table(spark, d, "documents").select("doc_id")
    c = e.where("doc_id % 4 > 0").select("doc_id", F.explode(F.sequence(F.lit(0), (F.col("doc_id") % 4 - 1).cast("int"))).alias("pos"))
    c = c.withColumn("prompt", F.concat(F.lit("ask "), (F.col("doc_id") * 10 + F.col("pos")).cast("string")))
    got = P.extract(e, c, P.backend("stub"), refused, "doc_id", "pos", wait=_no_wait)
    return got.select("doc_id", F.coalesce(F.size(F.filter("answers", lambda a: a.isNotNull())), F.lit(0)).cast("long").alias("answers"), "ok", "error", "merge")


@query(f"WITH {_STATE} SELECT doc_id, status, CASE WHEN status = 'success' THEN 'done' ELSE 'open' END AS phase FROM st")
def two_phase_schedule(spark: SparkSession, d: str) -> DataFrame:
    """Two steps with a table between them."""
    path = _place(spark, "phase")

    def write(rows: DataFrame, k: int) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{path}/{k}")
        return spark.read.parquet(f"{path}/{k}")

    first = lambda rows: rows.select("doc_id", "status")
    second = lambda rows: rows.withColumn("phase", F.when(F.col("status") == "success", "done").otherwise("open"))
    return P.staged(_state(spark, d), [first, second], write)


@query(f"WITH {X.SEG} SELECT doc_id, sha256(string_agg(idx || ':' || length(text), ',' ORDER BY idx)) AS outcomes FROM seg GROUP BY 1")
def ordered_batches(spark: SparkSession, d: str) -> DataFrame:
    """Segments are worked on in any order and come out in theirs; each knows the one before it."""
    worked = X.segments(spark, d).repartition(F.xxhash64("doc_id", "idx")).select("doc_id", "idx", F.length("text").alias("n"))
    checked = worked.withColumn("last", F.lag("idx").over(S.by("doc_id", order="idx"))).where("last is null or last = idx - 1")
    return checked.groupBy("doc_id").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "n"))), lambda x: F.concat(x["idx"].cast("string"), F.lit(":"), x["n"].cast("string"))), ","), 256).alias("outcomes"))


# Audio


@query("""WITH b AS (SELECT page_id, CAST(page_id % 50 + 2 AS BIGINT) AS n FROM pages) SELECT page_id, n AS frames, n * 256 * 300 AS energy FROM b""")
def wav_frames(spark: SparkSession, d: str) -> DataFrame:
    """WAV files made from the rows (a square wave), decoded to frames of 16 ms."""
    from spokenlake.sources import audio as A

    n = (F.col("page_id") % 50 + 2).cast("int")
    wave = F.concat(F.lit("2C01"), F.lit("D4FE"))  # 300, -300 as little-endian 16-bit numbers
    size = lambda c: F.concat(*[F.lpad(F.hex(F.shiftright(c, s).bitwiseAND(F.lit(255))), 2, "0") for s in (0, 8, 16, 24)])
    head = F.concat(F.lit("52494646"), size(n * 512 + 36), F.lit("57415645666D74201000000001000100803E0000007D00000200100064617461"), size(n * 512))
    files = X.table(spark, d, "pages").select(F.col("page_id").cast("string").alias("path"), F.unhex(F.concat(head, F.repeat(wave, n * 128))).alias("content"))
    return A.frames(files).groupBy(F.col("path").cast("long").alias("page_id")).agg(F.count("*").alias("frames"), F.sum("energy").alias("energy"))


# Sentences, decoding, plug-ins


_MARK = "regexp_replace(text, '([。！？!?；;])', '\\1' || chr(1), 'g')"


@query(rf"""WITH {X.SEG}, p AS (SELECT doc_id, idx, start_ms, unnest(string_split({_MARK}, chr(1))) AS s, generate_subscripts(string_split({_MARK}, chr(1)), 1) AS pos FROM seg),
b AS (SELECT *, coalesce(sum(length(s)) OVER (PARTITION BY doc_id, idx ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p)
SELECT doc_id, idx, {X.strip_sql('s')} AS sentence, CAST(start_ms + 60 * (before + length(s) - length(regexp_replace(s, '^{X.WSC}+', ''))) AS BIGINT) AS start_ms, CAST(start_ms + 60 * (before + length(regexp_replace(s, '{X.WSC}+$', ''))) AS BIGINT) AS end_ms FROM b WHERE {X.strip_sql('s')} <> ''""")
def sentences(spark: SparkSession, d: str) -> DataFrame:
    return S.sentences(X.segments(spark, d), 60)


@query(f"WITH {X.FRA}, f AS (SELECT doc_id, CAST(frame // 12 AS BIGINT) AS clip, frame, energy % 7 AS t FROM fra), e AS (SELECT doc_id, clip, min(frame) FILTER (t = 0) AS stop FROM f GROUP BY 1, 2) SELECT f.doc_id, f.clip, coalesce(string_agg(CAST(t AS VARCHAR), ' ' ORDER BY frame) FILTER (stop IS NULL OR frame < stop), '') AS tokens FROM f JOIN e USING (doc_id, clip) GROUP BY 1, 2")
def greedy_decode(spark: SparkSession, d: str) -> DataFrame:
    f = X.frames(spark, d).select("doc_id", F.floor(F.col("frame") / 12).cast("long").alias("clip"), "frame", F.transform(F.sequence(F.lit(0), F.lit(6)), lambda k: F.when(k == F.col("energy") % 7, 0.9).otherwise(0.1)).alias("scores"))
    g = f.groupBy("doc_id", "clip").agg(F.transform(F.array_sort(F.collect_list(F.struct("frame", "scores"))), lambda x: x["scores"]).alias("scores"))
    return g.select("doc_id", "clip", F.array_join(F.transform(P.greedy(F.col("scores"), 0), lambda t: t.cast("string")), " ").alias("tokens"))


_GAPS = "g AS (SELECT doc_id, frame, frame - row_number() OVER (PARTITION BY doc_id ORDER BY frame) AS k FROM fra WHERE is_speech AND frame * 37 % 100 < 30), i AS (SELECT doc_id, min(frame) AS start, count(*) AS size FROM g GROUP BY doc_id, k QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, min(frame)) = 1)"


@query(f"""WITH {X.FRA}, {_GAPS}, s AS (SELECT doc_id, min(frame) AS lo, max(frame) + 1 AS hi FROM fra WHERE is_speech AND frame * 37 % 100 >= 30 GROUP BY 1),
a AS (SELECT f.doc_id, count(*) FILTER (is_speech) AS speech, count(*) FILTER (is_speech AND frame >= lo AND frame < hi) AS covered, count(lo) AS aligned FROM fra f LEFT JOIN s USING (doc_id) GROUP BY 1),
b AS (SELECT a.doc_id, speech, covered, coalesce(start * 16, 0) AS gap_start_ms, coalesce(size * 16, 0) AS gap_ms, CASE WHEN speech = 0 THEN 'no_speech' WHEN aligned = 0 THEN 'alignment_failed' WHEN covered / speech::DOUBLE < 0.6 THEN 'low_coverage' ELSE 'sufficient' END AS status FROM a LEFT JOIN i USING (doc_id))
SELECT *, gap_ms > 2000 OR status NOT IN ('no_speech', 'sufficient') AS anomalous, status = 'no_transcript' OR (status = 'low_coverage' AND gap_ms > 2000) AS probe FROM b""")
def assess_transcription(spark: SparkSession, d: str) -> DataFrame:
    return S.assess(X.frames(spark, d), F.col("is_speech") & (F.col("frame") * 37 % 100 >= 30))


@query(f"WITH {X.SEG} SELECT doc_id, CAST(idx AS BIGINT) AS idx, CASE WHEN idx % 4 = 0 THEN '100' ELSE CAST(idx % 4 + CASE WHEN idx >= 4 THEN 100 ELSE 0 END AS VARCHAR) END AS text FROM seg")
def sequential_transcription(spark: SparkSession, d: str) -> DataFrame:
    """Each segment is transcribed with the one before it; every fourth is cached."""
    s = X.segments(spark, d).select("doc_id", "idx", F.lit("next").alias("request"), F.when(F.col("idx") % 4 == 0, "100").alias("cached"))
    return P.transcribed(s, lambda request, before: str(int(before or 0) + 1))


@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS n FROM documents")
def worker_process(spark: SparkSession, d: str) -> DataFrame:
    """Requests and responses as JSON lines of a child process."""
    import sys

    program = "import json, sys\nfor line in sys.stdin:\n    r = json.loads(line)\n    print(json.dumps({'n': len(r['text'])}), flush=True)"
    rows = X.table(spark, d, "documents").select("doc_id", F.to_json(F.struct("text")).alias("request"))
    return P.piped(rows, [sys.executable, "-c", program]).select("doc_id", F.from_json("response", "n long")["n"].alias("n"))


@query("SELECT page_id, CASE WHEN page_id % 6 = 0 THEN NULL ELSE '<p>' || url || '</p>' END AS html, page_id % 6 <> 0 AS ok FROM pages")
def page_loading(spark: SparkSession, d: str) -> DataFrame:
    """Pages come from a loader that is plugged in; what cannot be loaded is a row that says so."""

    def loader(urls: list[str]) -> list[str]:
        if urls[0] == "":
            raise P.Retryable("timeout")
        return [f"<p>{u}</p>" for u in urls]

    rows = X.table(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 6 == 0, "").otherwise(F.col("url")).alias("url"))
    return P.call(rows, [loader], prompt="url", wait=_no_wait).select("page_id", F.col("answer").alias("html"), "ok")


@query("SELECT conv_id, turn, upper(role) || '.' AS text FROM conversations WHERE role <> 'system'")
def batch_model(spark: SparkSession, d: str) -> DataFrame:
    """A table-valued model, opened once a task: a stand-in for a punctuation restorer, which drops some rows."""

    def make():
        def punctuate(columns: dict) -> dict:
            kept = [k for k, r in enumerate(columns["role"]) if r != "system"]
            return {"conv_id": [columns["conv_id"][k] for k in kept], "turn": [columns["turn"][k] for k in kept], "text": [columns["role"][k].upper() + "." for k in kept]}

        return punctuate

    c = X.table(spark, d, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role")
    return P.table_model(c, make, "conv_id long, turn long, text string")
