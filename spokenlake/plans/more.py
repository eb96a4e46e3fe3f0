"""Queries of scalar rules, joins by position, sets, partial aggregates and JSON rules, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spokenlake.functions import json_rules as J
from spokenlake.functions import numbers as N
from spokenlake.functions import text as T
from spokenlake.operators import mentions as M
from spokenlake.operators import ranges as R
from spokenlake.operators import sequences as S
from spokenlake.plans import fixtures as X
from spokenlake.plans.registry import _RUN, query

_OFF = f"{X.SEG}, o AS (SELECT doc_id, idx, text, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, length(text) AS n FROM seg)"


# Joins by position, sets, partial aggregates


@query(f"WITH {_OFF}, p AS (SELECT doc_id, unnest(range(0, length(text) + 1, 97)) AS position FROM documents) SELECT p.doc_id, p.position, o.idx FROM p LEFT JOIN o ON p.doc_id = o.doc_id AND position >= start AND position < start + n")
def point_in_range(spark: SparkSession, d: str) -> DataFrame:
    points = X.table(spark, d, "documents").select("doc_id", F.explode(F.sequence(F.lit(0), F.floor(F.length("text") / 97))).alias("k")).select("doc_id", (F.col("k") * 97).alias("position"))
    ranges = S.offsets(X.segments(spark, d)).select("doc_id", "idx", "start", "stop")
    return R.points_in_ranges(points, ranges, "doc_id", "position", "start", "stop").select("doc_id", "position", "idx")


@query(f"WITH {X.FRA}, {_RUN.format('is_speech')}, t AS (SELECT doc_id, frame * 3 AS low, frame * 3 + 4 AS high FROM fra WHERE frame % 5 = 0) SELECT t.doc_id, low, high, start, stop FROM t JOIN r ON t.doc_id = r.doc_id AND low >= start AND high <= stop")
def interval_containment(spark: SparkSession, d: str) -> DataFrame:
    f = X.frames(spark, d)
    inner = f.where("frame % 5 = 0").select("doc_id", (F.col("frame") * 3).alias("low"), (F.col("frame") * 3 + 4).alias("high"))
    outer = S.islands(f, F.col("is_speech")).select("doc_id", "start", "stop")
    return R.ranges_in_ranges(inner, outer, "doc_id", "low", "high", "start", "stop").select("doc_id", "low", "high", "start", "stop")


@query("""WITH n AS (SELECT conv_id, role, turn, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) AS k FROM conversations), u AS (SELECT * FROM n WHERE role = 'user'), a AS (SELECT * FROM n WHERE role = 'assistant')
SELECT coalesce(u.conv_id, a.conv_id) AS conv_id, coalesce(u.k, a.k) AS k, u.turn AS asked, a.turn AS answered, u.k IS NOT NULL AND a.k IS NOT NULL AS paired FROM u FULL JOIN a ON u.conv_id = a.conv_id AND u.k = a.k""")
def positional_zip(spark: SparkSession, d: str) -> DataFrame:
    k = F.row_number().over(W.partitionBy("conv_id", "role").orderBy("turn", "text")).cast("long")
    n = X.table(spark, d, "conversations").withColumn("k", k)
    side = lambda role, name: n.where(F.col("role") == role).select("conv_id", "k", F.col("turn").alias(name))
    return R.zipped(side("user", "asked"), side("assistant", "answered"), ["conv_id", "k"])


@query(f"""WITH {X.SEG}, q AS (SELECT doc_id, idx FROM seg WHERE (doc_id + idx) % 23 <> 0), g AS (SELECT doc_id, idx FROM seg WHERE (doc_id + idx) % 17 <> 0 UNION ALL SELECT doc_id, idx FROM seg WHERE (doc_id + idx) % 29 = 0),
a AS (SELECT doc_id, idx, count(*) AS asked FROM q GROUP BY 1, 2), b AS (SELECT doc_id, idx, count(*) AS given FROM g GROUP BY 1, 2)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.idx, b.idx) AS idx, CASE WHEN asked IS NULL THEN 'unexpected' WHEN given IS NULL THEN 'missing' WHEN given > asked THEN 'repeated' ELSE 'ok' END AS outcome FROM a FULL JOIN b ON a.doc_id = b.doc_id AND a.idx = b.idx""")
def request_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    s = X.segments(spark, d).select("doc_id", "idx")
    k = F.col("doc_id") + F.col("idx")
    return R.reconciled(s.where(k % 23 != 0), s.where(k % 17 != 0).unionByName(s.where(k % 29 == 0)), ["doc_id", "idx"])


@query(f"""WITH {X.SEG}, e AS (SELECT DISTINCT doc_id, idx FROM seg WHERE idx % 31 <> 0), a AS (SELECT DISTINCT doc_id, idx FROM seg WHERE (doc_id + idx) % 37 <> 0), b AS (SELECT coalesce(e.doc_id, a.doc_id) AS doc_id, e.idx AS ei, a.idx AS ai FROM e FULL JOIN a ON e.doc_id = a.doc_id AND e.idx = a.idx)
SELECT doc_id, count(*) FILTER (ai IS NULL) AS lacking, count(*) FILTER (ei IS NULL) AS extra, count(*) FILTER (ai IS NULL) + count(*) FILTER (ei IS NULL) = 0 AS equal FROM b GROUP BY 1""")
def set_equality(spark: SparkSession, d: str) -> DataFrame:
    s = X.segments(spark, d).select("doc_id", "idx")
    return R.equal_sets(s.where("idx % 31 <> 0"), s.where((F.col("doc_id") + F.col("idx")) % 37 != 0), "doc_id", "idx")


@query("WITH n AS (SELECT DISTINCT source, k FROM documents, (SELECT unnest(['de','en','es','fr','it']) AS k)) SELECT source, coalesce(string_agg(k, ',' ORDER BY k) FILTER (NOT EXISTS (SELECT 1 FROM documents x WHERE x.source = n.source AND x.lang = n.k)), '') AS missing FROM n GROUP BY 1")
def missing_files(spark: SparkSession, d: str) -> DataFrame:
    """What a group lacks of a required list."""
    required = F.array(*[F.lit(x) for x in ("de", "en", "es", "fr", "it")])
    g = X.table(spark, d, "documents").groupBy("source").agg(F.collect_set("lang").alias("present"))
    return g.select("source", F.array_join(F.array_sort(F.array_except(required, "present")), ",").alias("missing"))


@query(rf"""WITH {X.SEG}, p AS (SELECT doc_id, (idx - 1) // 20 AS chunk, string_agg(text, chr(10) ORDER BY idx) AS text, sum(length(regexp_replace(text, '[^0-9]', '', 'g'))) AS deleted, sum(length(text)) AS source FROM seg GROUP BY 1, 2)
SELECT doc_id, sha256(string_agg(text, chr(10) || chr(10) ORDER BY chunk)) AS text_sha, CAST(sum(deleted) AS BIGINT) AS deleted, CAST(sum(source) AS BIGINT) AS source, string_agg(CAST(chunk AS VARCHAR), ',' ORDER BY chunk) AS deletions, CAST(CASE WHEN sum(source) = 0 THEN 0 ELSE floor(sum(deleted) * 1000000 / sum(source)) END AS BIGINT) AS millionths FROM p GROUP BY 1""")
def merge_partials(spark: SparkSession, d: str) -> DataFrame:
    s = X.segments(spark, d).withColumn("chunk", F.expr("(idx - 1) div 20"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]), "\n")
    parts = s.groupBy("doc_id", "chunk").agg(text.alias("text"), F.sum(F.regexp_count("text", F.lit("[0-9]"))).cast("long").alias("deleted"), F.sum(F.length("text")).alias("source")).withColumn("deletions", F.array("chunk"))
    m = R.merged_partials(parts, "doc_id", "chunk")
    return m.select("doc_id", F.sha2("text", 256).alias("text_sha"), "deleted", "source", F.array_join(F.transform("deletions", lambda x: x.cast("string")), ",").alias("deletions"), F.coalesce(F.floor(F.try_divide(F.col("deleted") * 1_000_000, F.col("source"))), F.lit(0)).cast("long").alias("millionths"))


@query(f"WITH {X.ALI}, c AS (SELECT DISTINCT doc_id, CAST(frame // 50 AS BIGINT) AS clip FROM fra) SELECT c.doc_id, c.clip, round(coalesce(avg(confidence), 0), 6) AS mean_confidence FROM c LEFT JOIN ali USING (doc_id, clip) GROUP BY 1, 2")
def mean_confidence(spark: SparkSession, d: str) -> DataFrame:
    clips = X.frames(spark, d).select("doc_id", F.floor(F.col("frame") / 50).cast("long").alias("clip"), F.when(F.col("is_speech"), F.pmod(F.col("frame") * 37, F.lit(100)) / 100).alias("confidence"))
    return clips.groupBy("doc_id", "clip").agg(F.round(F.coalesce(F.avg("confidence"), F.lit(0.0)), 6).alias("mean_confidence"))


@query(f"WITH {X.FRA} SELECT doc_id, CAST(sum(abs(energy - 48)) AS BIGINT) AS total, round(avg(abs(energy - 48)), 6) AS mean FROM fra GROUP BY 1")
def mean_absolute_energy(spark: SparkSession, d: str) -> DataFrame:
    x = F.abs(F.col("energy") - 48)
    return X.frames(spark, d).groupBy("doc_id").agg(F.sum(x).alias("total"), F.round(F.avg(x), 6).alias("mean"))


@query(f"""WITH {X.FRA}, {_RUN.format('NOT is_speech')}, e AS (SELECT doc_id, start, size, energy / size::DOUBLE AS mean, min(energy / size::DOUBLE) OVER (PARTITION BY doc_id) AS lo, max(energy / size::DOUBLE) OVER (PARTITION BY doc_id) AS hi FROM r)
SELECT doc_id, start, round(CASE WHEN start % 7 = 0 THEN 0.05::DOUBLE ELSE 0.05::DOUBLE + 0.75::DOUBLE * (1 - (2 / 3.0::DOUBLE * least(1, size / 19.0::DOUBLE) + 1 / 3.0::DOUBLE * CASE WHEN hi = lo THEN 1 ELSE 1 - (mean - lo) / (hi - lo) END)) END, 6) AS loss, round(0.25::DOUBLE * abs(size - 16) / 16.0::DOUBLE + greatest(0, (8 - size) / 8.0::DOUBLE), 6) AS segment_loss FROM e""")
def boundary_losses(spark: SparkSession, d: str) -> DataFrame:
    r = S.islands(X.frames(spark, d), ~F.col("is_speech")).withColumn("mean", F.col("energy") / F.col("size"))
    w = W.partitionBy("doc_id")
    quiet = N.quietness(F.col("mean"), F.min("mean").over(w), F.max("mean").over(w))
    return r.withColumn("quiet", quiet).select("doc_id", "start", F.round(N.boundary_loss(F.col("start") % 7 == 0, F.col("size"), F.col("quiet")), 6).alias("loss"), F.round(N.segment_loss(F.col("size"), 8, 24), 6).alias("segment_loss"))


@query(f"""WITH {X.FRA}, {_RUN.format('is_speech')}, k AS (SELECT doc_id, start, stop, size, CAST(ceil(size / 12.0) AS BIGINT) AS pieces FROM r),
b AS (SELECT doc_id, start + size * i // pieces AS stop, false AS is_natural FROM k, LATERAL (SELECT unnest(range(1, pieces)) AS i) UNION ALL SELECT doc_id, stop, true FROM k)
SELECT doc_id, stop, is_natural, coalesce(lag(stop) OVER w, 0) AS start, greatest(0, coalesce(lag(stop) OVER w, 0) - CASE WHEN coalesce(lag(is_natural) OVER w, true) THEN 0 ELSE 2 END) AS output_start, lead(stop) OVER w IS NULL AS is_terminal FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY stop)""")
def boundary_records(spark: SparkSession, d: str) -> DataFrame:
    """All boundaries of a document in order; a segment after a forced cut begins two frames earlier."""
    r = S.islands(X.frames(spark, d), F.col("is_speech")).withColumn("pieces", F.ceil(F.col("size") / 12).cast("long"))
    forced = r.where("pieces > 1").select("doc_id", "start", "size", "pieces", F.explode(F.sequence(F.lit(1).cast("long"), F.col("pieces") - 1)).alias("i")).select("doc_id", F.expr("start + size * i div pieces").alias("stop"), F.lit(False).alias("is_natural"))
    return S.boundary_records(forced.unionByName(r.select("doc_id", "stop", F.lit(True).alias("is_natural"))), 2)


@query(f"""WITH {X.FRA}, s AS (SELECT doc_id, frame, energy % 3 + 1 AS parts FROM fra), c AS (SELECT *, sum(parts) OVER (PARTITION BY doc_id ORDER BY frame ROWS UNBOUNDED PRECEDING) AS last FROM s)
SELECT doc_id, frame, CASE (last - 1) * 7 % 5 WHEN 0 THEN '' WHEN 1 THEN ',' WHEN 2 THEN '.' WHEN 3 THEN '?' ELSE '!' END AS tag FROM c""")
def subtoken_tags(spark: SparkSession, d: str) -> DataFrame:
    """The tag of each token is the one predicted for its last part."""
    tokens = X.frames(spark, d).select("doc_id", "frame", (F.col("energy") % 3 + 1).alias("parts"))
    predictions = tokens.groupBy("doc_id").agg(F.sum("parts").cast("int").alias("n")).select("doc_id", F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: i * 7 % 5).alias("predictions"))
    return S.subtoken_tags(tokens, predictions, ["", ",", ".", "?", "!"])


@query("""WITH n AS (SELECT user_id, event_id, row_number() OVER w AS done, count(*) OVER (PARTITION BY user_id) AS total FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), p AS (SELECT *, done * 10 // total AS step FROM n)
SELECT user_id, done, total, CAST(step * 10 AS BIGINT) AS crossed FROM p QUALIFY step > coalesce(lag(step) OVER (PARTITION BY user_id ORDER BY done), 0)""")
def progress_reports(spark: SparkSession, d: str) -> DataFrame:
    done = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    n = X.table(spark, d, "events").select("user_id", done.alias("done"), F.count("*").over(W.partitionBy("user_id")).alias("total"))
    return S.progress(n, "user_id")


@query(f"WITH {X.FRA}, s AS (SELECT doc_id, frame, frame - lag(frame, 1, -100) OVER (PARTITION BY doc_id ORDER BY frame) - 1 >= 4 AS fresh FROM fra WHERE is_speech), g AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY frame ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT doc_id, min(frame) AS start, max(frame) + 1 AS stop, count(*) AS speech FROM g GROUP BY doc_id, k HAVING count(*) >= 7")
def short_islands(spark: SparkSession, d: str) -> DataFrame:
    """Speech that pauses shorter than four frames join, with at least seven frames of it."""
    return S.joined_islands(X.frames(spark, d), F.col("is_speech"), 4, 7)


# Text


@query(f"""WITH {X.MEN}, t AS (SELECT grp, pos, evidence, left(trim(name), 2) || ' ' || upper(substring(trim(name), 3)) AS name FROM good),
k AS (SELECT *, list_filter(range(1, length(evidence) + 1), lambda i: NOT regexp_matches(evidence[i], '{X.WSC}')) AS kept, instr(lower(regexp_replace(evidence, '{X.WSC}', '', 'g')), lower(regexp_replace(name, '{X.WSC}', '', 'g'))) AS hit FROM t)
SELECT grp, pos, CAST(CASE WHEN hit > 0 THEN kept[hit] - 1 END AS INT) AS place FROM k""")
def find_in_text(spark: SparkSession, d: str) -> DataFrame:
    given = M.guarded(X.mentions(spark, d)).withColumn("name", F.concat(F.left(F.trim("name"), F.lit(2)), F.lit(" "), F.upper(F.substring(F.trim("name"), 3, 1000))))
    return given.select("grp", "pos", T.find_name(F.col("evidence"), F.col("name")).cast("int").alias("place"))


@query("""WITH s AS (SELECT doc_id, text, length(text) AS n, (doc_id * 37) % (length(text) + 1) AS a FROM documents), p AS (SELECT *, least(n, a + 5) AS b, greatest(0, a - 20) AS lo, least(n, least(n, a + 5) + 20) AS hi FROM s)
SELECT doc_id, substring(text, CAST(lo + 1 AS BIGINT), CAST(a - lo AS BIGINT)) AS before, substring(text, CAST(b + 1 AS BIGINT), CAST(hi - b AS BIGINT)) AS after, lo > 0 AS prefix_truncated, hi < n AS suffix_truncated FROM p""")
def context_excerpts(spark: SparkSession, d: str) -> DataFrame:
    t = X.table(spark, d, "documents").select("doc_id", "text", (F.col("doc_id") * 37 % (F.length("text") + 1)).alias("a"))
    return t.select("doc_id", T.context_excerpt(F.col("text"), F.col("a"), F.least(F.length("text"), F.col("a") + 5)).alias("e")).select("doc_id", "e.*")


_TREE = """c AS (SELECT conv_id, turn, min(role) AS role, min(text) AS text FROM conversations GROUP BY 1, 2), m AS (SELECT *, min(turn) OVER (PARTITION BY conv_id) AS root FROM c),
p AS (SELECT *, CASE WHEN turn = root THEN -1 ELSE (turn - 1) // 2 END AS parent FROM m), q AS (SELECT *, row_number() OVER (PARTITION BY conv_id, parent ORDER BY turn) AS place FROM p)"""


@query(f"""WITH RECURSIVE {_TREE}, t AS (SELECT conv_id, turn, role, text, CAST(place AS VARCHAR) AS path, [place] AS keys, 1 AS depth FROM q WHERE turn = root UNION ALL
SELECT q.conv_id, q.turn, q.role, q.text, t.path || '.' || q.place, list_append(t.keys, q.place), t.depth + 1 FROM q JOIN t ON q.conv_id = t.conv_id AND q.parent = t.turn AND q.turn <> q.root)
SELECT conv_id, 'T' || conv_id || chr(10) || string_agg(repeat('  ', CAST(depth - 1 AS BIGINT)) || CASE WHEN depth = 1 THEN '评论 ' ELSE '回复 ' END || path || '｜作者：' || role || '｜时间：' || turn || chr(10) || repeat('  ', CAST(depth - 1 AS BIGINT)) || text, chr(10) ORDER BY keys) AS rendered FROM t GROUP BY 1""")
def episode_text(spark: SparkSession, d: str) -> DataFrame:
    from spokenlake.operators.trees import render, tree_paths

    c = X.table(spark, d, "conversations").groupBy("conv_id", "turn").agg(F.min("role").alias("role"), F.min("text").alias("text"))
    nodes = c.select("conv_id", "turn", F.when(F.col("turn") != F.min("turn").over(W.partitionBy("conv_id")), F.expr("(turn - 1) div 2")).alias("parent"))
    paths = tree_paths(nodes, "conv_id", "turn", "parent").join(c, ["conv_id", "turn"])
    return render(paths.select("conv_id", "path", "depth", F.col("role").alias("author"), F.col("turn").cast("string").alias("created_at"), "text"), "conv_id").select("conv_id", F.concat(F.lit("T"), F.col("conv_id").cast("string"), F.lit("\n"), "comments").alias("rendered"))


@query(r"SELECT conv_id, turn, regexp_replace(text || chr(13) || chr(10) || role || chr(10), '\r\n|\r|\n', '↵', 'g') AS shown FROM conversations")
def newline_report(spark: SparkSession, d: str) -> DataFrame:
    return X.table(spark, d, "conversations").select("conv_id", "turn", T.show_newlines(F.concat("text", F.lit("\r\n"), "role", F.lit("\n"))).alias("shown"))


@query(f"WITH {X.FRA}, w AS (SELECT doc_id, frame, CASE energy % 4 WHEN 0 THEN '<' || energy || '>' WHEN 1 THEN '▁w' || energy ELSE 'w' || energy END AS token FROM fra) SELECT doc_id, frame, replace(token, '▁', ' ') AS text FROM w WHERE NOT (starts_with(token, '<') AND ends_with(token, '>'))")
def token_texts(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("energy").cast("string")
    w = X.frames(spark, d).select("doc_id", "frame", F.when(F.col("energy") % 4 == 0, F.concat(F.lit("<"), e, F.lit(">"))).when(F.col("energy") % 4 == 1, F.concat(F.lit("▁w"), e)).otherwise(F.concat(F.lit("w"), e)).alias("token"))
    return w.where(~T.is_control_token(F.col("token"))).select("doc_id", "frame", T.token_text(F.col("token")).alias("text"))


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'mp3' WHEN 1 THEN 'wav' END AS format, CASE page_id % 6 WHEN 0 THEN '.mp3' WHEN 1 THEN '.aiff' WHEN 2 THEN '.ape' END AS suffix, page_id % 5 <> 0 AND page_id % 5 <> 1 AND page_id % 5 <> 2 AS media, page_id % 4 < 2 AS markup FROM pages""")
def media_rules(spark: SparkSession, d: str) -> DataFrame:
    pick = lambda n, *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("page_id") % n + 1).cast("int"))
    return X.table(spark, d, "pages").select(
        "page_id", T.segment_format(pick(4, " MP3", "Wav\n", "ogg", "")).alias("format"),
        T.audio_extension(pick(6, "https://h/a.MP3?x=.wav", "http://h/b/c.aiff#f", "HTTPS://h/x.y.ape", "https://h/a.m4b", "ftp://h/a.mp3", "https://h.mp3")).alias("suffix"),
        T.media_type_ok(pick(5, "text/html; charset=utf-8", "application/JSON", "application/rss+xml", "audio/mpeg", "application/octet-stream")).alias("media"),
        T.looks_like_markup(pick(4, "  <!DOCTYPE HTML><p>", "\n{\"a\": 1}", "ID3\x04<html", "RIFF")).alias("markup"),
    )


@query(rf"""WITH {X.SEG} SELECT doc_id, idx, {X.strip_sql("text")} <> '' AS filled, coalesce(nullif({X.strip_sql("text")}, ''), 'doc ' || doc_id) AS resolved, regexp_matches(text, '[\p{{L}}\p{{N}}]') AS speech FROM seg""")
def blank_segments(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return X.segments(spark, d).select("doc_id", "idx", (T.strip(t) != "").alias("filled"), F.coalesce(T.non_blank(t), T.non_blank(F.concat(F.lit(" doc "), F.col("doc_id").cast("string")))).alias("resolved"), T.has_speech(t).alias("speech"))


@query("SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'a|b c|d' WHEN 1 THEN '' ELSE 'x' END AS names, CASE WHEN page_id % 3 = 2 THEN 'x' END AS setting FROM pages")
def configured_lists(spark: SparkSession, d: str) -> DataFrame:
    given = F.element_at(F.array(F.lit(" a,b c\n，d ,"), F.lit(" \n, "), F.lit("x")), (F.col("page_id") % 3 + 1).cast("int"))
    return X.table(spark, d, "pages").select("page_id", F.array_join(T.split_names(given), "|").alias("names"), F.when(F.col("page_id") % 3 == 2, T.non_blank(given)).alias("setting"))


@query("SELECT doc_id, 'Titel ' || doc_id || chr(10) || 'eins' || chr(10) || 'zwei # drei' AS plain FROM documents")
def plain_answers(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id").cast("string")
    return X.table(spark, d, "documents").select("doc_id", T.plain_lines(F.concat(F.lit("```markdown\n## Titel "), i, F.lit("\r\neins\n```\n # zwei # drei\n"))).alias("plain"))


# Numbers


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 408 ELSE CAST(400 + event_id % 200 AS BIGINT) END AS status, CASE WHEN event_id % 5 = 0 THEN 408 ELSE 400 + event_id % 200 END IN (408, 409, 429) OR CASE WHEN event_id % 5 = 0 THEN 408 ELSE 400 + event_id % 200 END BETWEEN 500 AND 599 AS retry, CAST(least(pow(2, event_id % 6), 8) AS DOUBLE) AS delay FROM events")
def retry_delays(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("event_id") % 5 == 0, F.lit(408).cast("long")).otherwise(400 + F.col("event_id") % 200)
    return X.table(spark, d, "events").select("event_id", status.alias("status"), N.retryable_status(status).alias("retry"), N.backoff(F.col("event_id") % 6 + 1).alias("delay"))


@query(f"WITH {X.ATT}, s AS (SELECT user_id, attempt, gap_ms * 25 AS gap, CASE WHEN coverage = 0 THEN 'no_transcript' WHEN coverage < 0.6 THEN 'low_coverage' ELSE 'sufficient' END AS status FROM att) SELECT user_id, attempt, gap > 2000 OR status NOT IN ('no_speech', 'sufficient') AS anomalous, status = 'no_transcript' OR (status = 'low_coverage' AND gap > 2000) AS probe FROM s")
def anomalies(spark: SparkSession, d: str) -> DataFrame:
    a = X.attempts(spark, d).withColumn("gap", F.col("gap_ms") * 25).withColumn("status", N.coverage_status(F.col("coverage") > 0, F.lit(True), F.col("coverage")))
    return a.select("user_id", "attempt", N.anomalous(F.col("gap"), F.col("status")).alias("anomalous"), N.needs_probe(F.col("gap"), F.col("status")).alias("probe"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at, strftime(ts, '%Y%m%d_%H%M%S') AS label FROM events")
def utc_labels(spark: SparkSession, d: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return X.table(spark, d, "events").select("event_id", N.utc_text(ts).alias("at"), N.utc_label(ts).alias("label"))


@query(f"WITH {X.FRA} SELECT doc_id, CAST(frame // 10 AS BIGINT) AS clip, round(exp(max(-energy / 100.0::DOUBLE)), 9) AS confidence FROM fra GROUP BY 1, 2")
def confidences(spark: SparkSession, d: str) -> DataFrame:
    f = X.frames(spark, d).groupBy("doc_id", F.floor(F.col("frame") / 10).cast("long").alias("clip")).agg(F.collect_list(-F.col("energy") / 100.0).alias("logs"))
    return f.select("doc_id", "clip", F.round(N.confidence(F.col("logs")), 9).alias("confidence"))


@query(f"WITH {X.FRA} SELECT doc_id, frame, CAST(greatest(-32768, least(32767, round_even((energy * 900 + (frame % 7) * 311 - 40000) / 2.0::DOUBLE, 0))) AS INT) AS sample FROM fra")
def mono_mix(spark: SparkSession, d: str) -> DataFrame:
    return X.frames(spark, d).select("doc_id", "frame", N.mono(F.array((F.col("energy") * 900).cast("double"), (F.col("frame") % 7 * 311 - 40_000).cast("double"))).alias("sample"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'unlimited' ELSE format('{:.2f}/min', page_id / 4.0::DOUBLE) END AS rate, CAST(round_even(page_id * 441 * 1000 / 44100.0::DOUBLE, 0) AS BIGINT) AS wav_ms FROM pages")
def rates_and_durations(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("page_id")
    return X.table(spark, d, "pages").select("page_id", N.format_rate(F.when(i % 3 != 0, i / 4.0)).alias("rate"), N.samples_to_ms(i * 441, 44_100).alias("wav_ms"))


# JSON


@query("""SELECT doc_id, sha256('{"doc_id":' || doc_id || ',"lang":' || coalesce('"' || lang || '"', 'null') || ',"n_chars":' || n_chars || ',"note":null,"source":"' || source || 'é"}') AS signature FROM documents""")
def canonical_json_hash(spark: SparkSession, d: str) -> DataFrame:
    t = X.table(spark, d, "documents")
    return t.select("doc_id", J.canonical_hash(source=F.concat("source", F.lit("é")), note=F.lit(None).cast("string"), n_chars=F.col("n_chars"), doc_id=F.col("doc_id"), lang=F.col("lang")).alias("signature"))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 1 THEN NULL ELSE CASE WHEN doc_id % 5 = 0 THEN 0 ELSE doc_id % 3 + 1 END END AS items FROM documents""")
def timed_text_parse(spark: SparkSession, d: str) -> DataFrame:
    """Arrays of timed texts; every fifth is null, every fifth has one wrong item of five kinds."""
    wrong = F.element_at(F.array(*[F.lit(x) for x in ('{"text":"a","start_ms":5,"end_ms":4}', '{"text":"a","start_ms":true,"end_ms":4}', '{"text":"","start_ms":1,"end_ms":4}', '{"text":"a","start_ms":1,"end_ms":4,"confidence":1.5}', '{"text":7,"start_ms":1,"end_ms":4}')]), (F.floor(F.col("doc_id") / 5) % 5 + 1).cast("int"))
    good = F.array_join(F.array_repeat(F.lit('{"text":"b","start_ms":4,"end_ms":4,"confidence":null}'), (F.col("doc_id") % 3 + 1).cast("int")), ",")
    body = F.when(F.col("doc_id") % 5 == 0, "null").when(F.col("doc_id") % 5 == 1, F.concat(F.lit("["), good, F.lit(","), wrong, F.lit("]"))).otherwise(F.concat(F.lit("["), good, F.lit("]")))
    return X.table(spark, d, "documents").select("doc_id", J.timed_texts(F.parse_json(body)).alias("t")).select("doc_id", F.when(F.col("t").isNotNull(), F.size("t").cast("long")).alias("items"))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'null' WHEN 2 THEN 'wrong_type' ELSE 'missing' END AS title, CASE WHEN doc_id % 4 = 3 THEN 'missing' WHEN doc_id % 2 = 0 THEN 'ok' ELSE 'wrong_type' END AS count FROM documents""")
def typed_guards(spark: SparkSession, d: str) -> DataFrame:
    body = F.element_at(F.array(*[F.lit(x) for x in ('{"a":{"title":"x","count":3}}', '{"a":{"title":null,"count":true}}', '{"a":{"title":{"k":1},"count":0}}', '{"b":1}')]), (F.col("doc_id") % 4 + 1).cast("int"))
    return X.table(spark, d, "documents").select("doc_id", F.parse_json(body).alias("v")).select("doc_id", J.guard(F.col("v"), "$.a.title", "STRING").alias("title"), J.guard(F.col("v"), "$.a.count", "BIGINT").alias("count"))


@query(f"""WITH {X.ATT} SELECT user_id, attempt, CASE event_id % 4 WHEN 0 THEN 'alignment_failed' WHEN 1 THEN CASE WHEN coverage <= 0 THEN 'no_transcript' WHEN event_id % 3 = 0 THEN 'low_coverage' ELSE 'sufficient' END WHEN 2 THEN 'sufficient' END AS status, CASE WHEN event_id % 4 < 3 THEN gap_ms END AS gap_end_ms FROM att""")
def diagnostics_parse(spark: SparkSession, d: str) -> DataFrame:
    """States that are given, inferred from older records, and, for every fourth, invalid."""
    a = X.attempts(spark, d)
    status = F.element_at(F.array(F.lit(',"speech_coverage_status":"alignment_failed"'), F.lit(""), F.lit(',"speech_coverage_status":"sufficient"'), F.lit(',"speech_coverage_status":"unknown"')), (F.col("event_id") % 4 + 1).cast("int"))
    low = F.when(F.col("event_id") % 3 == 0, ',"has_low_speech_coverage":true').otherwise("")
    body = F.concat(F.lit('{"selected_attempt":1,"attempts":[{"attempt":'), F.col("attempt").cast("string"), F.lit(',"assessment":{"speech_coverage_ratio":'), F.col("coverage").cast("string"), status, low, F.lit(',"has_long_uncovered_speech":false,"longest_uncovered_speech_ms":'), F.col("gap_ms").cast("string"), F.lit("}}]}"))
    parsed = a.select("user_id", "attempt", J.diagnostics(F.parse_json(body))["attempts"][0].alias("x"))
    return parsed.select("user_id", "attempt", F.col("x.status").alias("status"), F.col("x.gap_end_ms").alias("gap_end_ms"))


@query("""SELECT doc_id, '{"doc_id":' || doc_id || CASE WHEN doc_id % 2 = 0 THEN ',"lang":"' || lang || '"' ELSE '' END || CASE WHEN doc_id % 3 = 0 THEN ',"marks":[1,2]' ELSE '' END || '}' AS body FROM documents""")
def optional_keys_json(spark: SparkSession, d: str) -> DataFrame:
    marks = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array().cast("array<int>"))
    return X.table(spark, d, "documents").select("doc_id", J.sparse_json(doc_id=F.col("doc_id"), lang=F.when(F.col("doc_id") % 2 == 0, F.col("lang")), marks=J.filled(marks)).alias("body"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS kept, CASE WHEN doc_id % 3 = 0 THEN 9 ELSE 3 END AS last_ms FROM documents")
def lenient_alignment_parse(spark: SparkSession, d: str) -> DataFrame:
    body = F.when(F.col("doc_id") % 3 == 0, '[{"text":"a","start_ms":1,"end_ms":3},{"text":"b","start_ms":3,"end_ms":9},{"start_ms":1,"end_ms":2}]').otherwise('[{"text":"a","start_ms":1,"end_ms":3},{"text":"b","start_ms":3,"end_ms":3},{"text":"c","start_ms":"x","end_ms":9}]')
    kept = X.table(spark, d, "documents").select("doc_id", J.lenient_alignments(F.parse_json(body)).alias("k"))
    return kept.select("doc_id", F.size("k").alias("kept"), F.array_max(F.transform("k", lambda x: x["end_ms"])).cast("int").alias("last_ms"))
