"""Sequential algorithms, sources and text functions on small fixtures."""

import collections
import difflib
import itertools
import json
import os
import random
import wave

import numpy as np
import pytest

from pyspark.sql import functions as F

from spokenlake import cli, sinks
from spokenlake.functions import numbers
from spokenlake.functions import python_text as P
from spokenlake.functions import text as T
from spokenlake.operators import audit, dynamic, mentions, models, sequences
from spokenlake.plans import registry  # noqa: F401 - registers the backends
from spokenlake.sources import audio, catalog, rss, transcripts
from spokenlake.streaming import incremental, sessions


def test_best_partition_is_optimal():
    cost = np.random.default_rng(3).random(9)

    def total(ends):
        starts = (0, *ends[:-1])
        return sum((cost[e] if e < 9 else 0) + 0.25 * abs(e - s - 3) / 3 + max(0, 2 - (e - s)) / 2 for s, e in zip(starts, ends))

    ways = [(*c, 9) for k in range(9) for c in itertools.combinations(range(1, 9), k)]
    ways = [w for w in ways if all(e - s <= 4 for s, e in zip((0, *w[:-1]), w))]
    assert abs(total(dynamic.best_partition(cost, 2, 4)) - min(map(total, ways))) < 1e-9


def test_partition_ties_go_to_the_longer_last_segment():
    assert dynamic.best_partition(np.zeros(13), 4, 8) == [6, 13]
    natural = np.zeros(13, bool)
    natural[5] = True
    costs = dynamic.boundary_cost(np.zeros(13, bool), np.arange(13), natural)
    assert costs[5] == 0.05 and costs[6] > 0.05


def test_audit_is_difflib_on_the_whole_content():
    draw = random.Random(7)
    kinds = collections.Counter()
    for _ in range(4000):
        a = "".join(draw.choices("甲乙丙丁", k=draw.randint(0, 24)))
        b = "".join(c for c in a if draw.random() > 0.03) if draw.random() < 0.7 else "".join(draw.choices("甲乙丙丁", k=12))
        codes = [x for x in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if x[0] != "equal"]
        gone = sum(x[2] - x[1] for x in codes)
        want = "rewrite" if any(x[0] != "delete" for x in codes) else "valid" if gone <= 0.05 * len(a) else "too_much"
        got = audit.verdict(a, b)[0]
        assert got == want, (a, b)
        kinds[got] += 1
    assert len(kinds) == 3
    assert audit.verdict("甲乙", "```text\n## 甲乙\n```")[0] == "valid"


def test_audit_lists_deletions(spark):
    long = "一二三四五六七八九十" * 5
    pairs = [(1, 1, f"{long}，那、个，{long}", f"## {long}，{long}"), (1, 2, "ab", "ax"), (1, 3, None, "")]
    got = audit.audit(spark.createDataFrame(pairs, "doc_id long, idx int, original string, formatted string")).orderBy("idx").collect()
    assert [(r.verdict, r.deleted) for r in got] == [("valid", 2), ("rewrite", 0), ("valid", 0)]
    assert [(d.start, d.stop, d.text) for d in got[0].deletions] == [(51, 54, "那、个")] and not got[1].deletions


def test_viterbi_is_likeliest():
    logs = np.log(np.random.default_rng(5).dirichlet(np.ones(3), 6))
    tokens = [1, 1]
    spans = dynamic.viterbi(logs, tokens)

    def collapse(path):
        return [k for k, _ in itertools.groupby(path) if k]

    best = max((p for p in itertools.product(range(3), repeat=6) if collapse(p) == tokens), key=lambda p: sum(logs[i, s] for i, s in enumerate(p)))
    marks = [0] * 6
    for a, b in spans:
        marks[a:b] = [1] * (b - a)
    assert tuple(marks) == best
    assert dynamic.viterbi(logs[:2], tokens) == []


@pytest.mark.parametrize(("a", "b", "want"), [("ab, c.", "abc", "valid"), ("那个我们一二三四五六七八九十甲乙丙丁戊己庚辛", "那我们一二三四五六七八九十甲乙丙丁戊己庚辛", "valid"), ("a1", "a", "protected"), ("ab", "ax", "rewrite"), ("我们", "我", "too_much"), ("", "", "valid")])
def test_audit(a, b, want):
    assert audit.verdict(a, b)[0] == want


def test_html_and_names():
    assert P.html_text("<p>a &amp;lt; b</p><br>c<script>x</script>") == "\na < b\n\ncx"
    assert P.html_text("a &lt;b&gt; <DIV class='x>y'>c</DIV><!-- <p> -->&amp;amp;<style>p &amp; q</style>1 < 2<h4>z</h4>") == "a <b> \nc\n&p & q1 < 2z"
    assert P.safe_part(" a/b:c. ") == "a_b_c" and P.cut_bytes("é" * 200, 5) == "éé"
    assert P.folder_name(["...", None], "id/1") == "id_1"
    assert P.folder_name(["p" * 100, "n. " * 100], "e1", "eid") == "p" * 60 + "-" + ("n. " * 100)[:172].rstrip(" ._") + "-eid=e1"
    assert P.folder_name(["p" * 100], "x" * 300) == "x" * 240
    for name in ([["é" * 99, "b" * 300]], [["ab. " * 40, "c"]]):
        assert len(P.folder_name(*name, "id").encode()) <= 240


def test_rss(spark):
    good = "<rss><channel><title>F</title><item><title>T</title><link>https://x/1</link><enclosure url='https://c/a.mp3' length='12'/></item><item><title>no audio</title></item></channel></rss>"
    got = rss.episodes(spark.createDataFrame([("u1", good), ("u2", "<rss><channel><item/></channel></rss>"), ("u3", "not xml")], "feed_url string, xml string")).collect()
    assert [(r.title, r.guid, r.audio_length_bytes, r.extension) for r in got] == [("T", "https://x/1", 12, ".mp3")]


def test_rss_problems_stop_a_strict_feed(spark):
    item = lambda t, u, more="": f"<item><title>{t}</title><guid isPermaLink='false'>{t}</guid><enclosure url='{u}'/>{more}</item>"
    feed = lambda *items: "<rss xmlns:itunes='urn:i'><channel><itunes:title>i</itunes:title><title>F</title>" + "".join(items) + "</channel></rss>"
    feeds = [
        ("ok", feed(item("a", "https://c/a.mp3", "<itunes:duration>5</itunes:duration><itunes:duration>6</itunes:duration>"))), ("type", feed(item("a", "https://c/a.mp3"), item("b", "https://c/b.pdf"))),
        ("twice", feed(item("a", "https://c/a.mp3"), item("a", "https://c/b.mp3"))), ("bad", "<rss/>"), ("empty", feed()),
    ]
    table = spark.createDataFrame(feeds, "feed_url string, xml string")
    strict = rss.episodes(table, strict=True).collect()
    assert [(r.feed_url, r.title, r.guid, r.duration, r.feed_title) for r in strict] == [("ok", "a", "a", "5", "i")]
    assert rss.episodes(table).count() == 4
    found = {(r.feed_url, r.problem) for r in rss.problems(rss.items(table)).collect()}
    assert found == {("type", "audio_type"), ("twice", "repeated"), ("bad", "no_channel")}


def test_next_where_and_find_name(spark):
    rows = spark.createDataFrame([("k", i, i in (3, 6)) for i in range(8)], "key string, pos int, flag boolean")
    for width in (1, 2, 3, 4096):
        got = {r.pos: r.next for r in sequences.next_where(rows, "key", "pos", "flag", width).collect()}
        assert got == {0: 3, 1: 3, 2: 3, 3: 6, 4: 6, 5: 6, 6: None, 7: None}
    cases = [("the B ig Corp", "bigcorp", 4), ("İİ x Name", "name", 5), ("nothing", "name", None), ("a", " ", None), ("İn", "n", 1), (None, "n", None)]
    table = spark.createDataFrame(cases, "s string, n string, want int").select("want", T.find_name(F.col("s"), F.col("n")).alias("got"))
    assert all(r.want == r.got for r in table.collect())


def test_excerpts_of_names_as_written(spark):
    far = "x" * 400
    cases = [(f"lo s {far} Los {far}", " LOS ", 406, 0), (f"\u0130\u0130 {far} Los {far}", "los", 404, 404), (far, "los", None, None), (far, " ", None, None), (None, "los", None, None)]
    table = spark.createDataFrame(cases, "s string, n string, verbatim int, loose int")
    places = table.select("*", T.find_verbatim(F.col("s"), F.col("n")).alias("v"), T.find_name(F.col("s"), F.col("n")).alias("l")).collect()
    assert all((r.verbatim, r.loose) == (r.v, r.l) for r in places)
    given = spark.createDataFrame([(1, 1, " LOS ", cases[0][0])], "grp long, pos int, name string, evidence string")
    assert mentions.distinct_excerpts(given, find=T.find_verbatim).first().excerpt == cases[0][0][256:556]
    assert mentions.distinct_excerpts(given).first().excerpt == cases[0][0][:300]


def test_sizes_round_ties_to_even(spark):
    sizes = [0, 1023, 8448, 8499, 8550, 8652480, 8755609, 9.5 * 2**30, 8.25 * 2**40, 8.75 * 2**40, None]
    table = spark.createDataFrame([(None if s is None else int(s),) for s in sizes], "size long")

    def plain(size):
        for unit in ("B", "KiB", "MiB", "GiB"):
            if size < 1024:
                return f"{size:.1f} {unit}"
            size /= 1024
        return f"{size:.1f} TiB"

    got = table.select("size", numbers.format_size(F.col("size")).alias("text")).collect()
    assert [r.text for r in got] == [None if r.size is None else plain(float(r.size)) for r in got]
    assert plain(8448.0) == "8.2 KiB"


def test_stream_reads_only_new_files_and_replays(spark, tmp_path):
    source, home = str(tmp_path / "events"), str(tmp_path / "home")
    one = spark.createDataFrame([(1, 1, 5, "a"), (2, 1, 6, "b")], "event_id long, user_id long, s long, event_type string").select("event_id", "user_id", F.timestamp_seconds("s").alias("ts"), "event_type")
    one.write.parquet(source)
    first = incremental.upsert_latest(spark, source, home).collect()
    assert [(r.user_id, r.status, r.updates) for r in first] == [(1, "b", 2)]
    one.select((F.col("event_id") + 2).alias("event_id"), "user_id", F.timestamp_seconds(F.lit(9)).alias("ts"), F.lit("c").alias("event_type")).write.mode("append").parquet(source)
    for _ in range(2):  # the second call finds nothing new
        again = incremental.upsert_latest(spark, source, home).collect()
        assert [(r.user_id, r.status, r.updates, r.last_event) for r in again] == [(1, "c", 4, 4)]
    commits = sorted(p for p in os.listdir(f"{home}/checkpoint/commits") if p.isdigit())
    os.remove(f"{home}/checkpoint/commits/.{commits[-1]}.crc")
    os.remove(f"{home}/checkpoint/commits/{commits[-1]}")  # a batch whose commit was lost is replayed, and replaces itself
    replayed = incremental.upsert_latest(spark, source, home).collect()
    assert [(r.user_id, r.status, r.updates) for r in replayed] == [(1, "c", 4)]


def test_sessions_on_a_stream_drop_what_comes_too_late(spark, tmp_path):
    schema = "user_id long, s long"
    for k, rows_ in enumerate([[(1, 0), (1, 100)], [(4, 90_000)], [(4, 90_005)], [(1, 50), (2, 90_010)], [(3, 400_000)]]):
        spark.createDataFrame(rows_, schema).select("user_id", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.parquet(str(tmp_path / f"in/k={k}"))
    stream = spark.readStream.schema("user_id long, ts timestamp, k int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = sessions.event_sessions(stream, "1 hour", "2 hours").writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.user_id, r.start, r.stop, r.n) for r in spark.table("late").collect()}
    assert (1, 0, 3700, 2) in got and (2, 90_010, 93_610, 1) in got and (4, 90_000, 93_605, 2) in got
    batch = sessions.event_sessions(spark.createDataFrame([(1, 0), (1, 100)], schema).select("user_id", F.timestamp_seconds("s").alias("ts")), "1 hour").first()
    assert (batch.start, batch.stop) == (0, 3700)


def test_gate_and_calls(spark):
    clock, waits = [0.0], []
    gate = models.Gate(60, lambda: clock[0], lambda s: (waits.append(s), clock.__setitem__(0, clock[0] + s)))
    for _ in range(3):
        gate.enter()
    assert waits == [1.0, 1.0]
    assert [models.delay(a) for a in (1, 2, 3, 4, 9)] == [1, 2, 4, 8, 8]
    with pytest.raises(ValueError, match="no backend"):
        models.backend("none")
    got = models.call(spark.createDataFrame([(None,)], "prompt string"), [models.backend("reserve")]).first()
    assert (got.answer, got.attempts, got.ok) == (None, 0, False)
    tries = []

    def write(rows, k):
        tries.append(k)
        if len(tries) == 1:
            raise OSError
        return rows

    assert models.staged(spark.range(3), [lambda r: r, lambda r: r.where("id > 0")], write).count() == 2 and tries == [0, 0, 1]


def test_audio(spark, tmp_path):
    x = np.concatenate([np.zeros(8000), 9000 * np.sin(np.arange(8000) / 9), np.zeros(8000)]).astype("<i2")
    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setnchannels(2), w.setsampwidth(2), w.setframerate(16000)
        w.writeframes(np.repeat(x, 2).tobytes())
    files = audio.files(spark, str(tmp_path))
    frames = audio.frames(files).orderBy("frame").collect()
    assert len(frames) == -(-24000 // 256)
    speech = [r.frame for r in frames if r.is_speech]
    assert speech[0] == 31 and speech[-1] == 62 and len(speech) == 32
    segments = files.select("path", F.lit(1).alias("index"), F.lit(500).alias("start_ms"), F.lit(1000).alias("end_ms"))
    cut, rate = audio.decode(bytes(audio.cut_segments(files, segments, 100).first().content))
    assert rate == 16000 and len(cut) == 8000 + 2 * 1600 and (cut[1600:-1600] == x[8000:16000]).all() and not cut[:1600].any()
    mel = audio.mel_features(x)
    assert mel.shape == (148, 80) and mel[70].max() > mel[5].max() + 5
    assert np.allclose(audio.normalised(mel, mel.mean(0), 1 / mel.std(0)).mean(0), 0)
    assert [(r.token, r.id) for r in audio.token_table(spark, ["a 7", "b"]).collect()] == [("a", 7), ("b", 1)]
    assert (audio.decode((tmp_path / "a.wav").read_bytes())[0] == x).all() and len(audio.resample(x.astype(np.int64), 8000)) == 48000


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "j")
    sinks.write_json(spark.range(2), path, overwrite=False)
    with pytest.raises(Exception, match="already exists"):
        sinks.write_json(spark.range(2), path, overwrite=False)
    assert sorted(sinks.console(spark.range(2)).split()) == ['{"id":0}', '{"id":1}']
    with pytest.raises(ValueError, match="more than 1"):
        sinks.console(spark.range(2), 1)
    transcripts.write_articles(spark.createDataFrame([("n", " A  b ", "x\n"), ("m", "", "y")], "name string, title string, body string"), str(tmp_path / "md"))
    got = {r.name: r.value for r in spark.read.text(str(tmp_path / "md"), wholetext=True).collect()}
    assert got["n"].rstrip() == "# A b\n\nx" and got["m"].rstrip() == "# Transcript\n\ny"


def test_catalog(tmp_path):
    path = tmp_path / "c.toml"
    path.write_text('[podcasts]\none = " https://x/f "\n')
    assert catalog.read_catalog(str(path)) == {"one": "https://x/f"}
    path.write_text('[podcasts]\none = "ftp://x"\n')
    with pytest.raises(ValueError, match="bad entry"):
        catalog.read_catalog(str(path))


def test_transcripts(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"title": "t", "segments": [{"index": 1, "start_ms": 0, "end_ms": 5, "text": " x "}, {"index": 2, "start_ms": 5, "end_ms": 5, "text": "y"}]}))
    (tmp_path / "b.json").write_text(json.dumps({"index": 7, "start_ms": 1, "end_ms": 2, "text": "z"}))
    got = sorted((r["index"], r.text, r.valid) for r in transcripts.segments(spark, str(tmp_path), pruned=True).collect())
    assert got == [(1, "x", True), (2, "y", False), (7, "z", True)]
    rows = spark.createDataFrame([("t", 2, 5, 9, "b"), ("t", 1, 0, 5, "a")], "title string, index int, start_ms long, end_ms long, text string")
    transcripts.write_manifest(rows, str(tmp_path / "out"))
    assert [(r.text, r["index"]) for r in transcripts.segments(spark, str(tmp_path / "out"), pruned=True, lines=True).orderBy("index").collect()] == [("a", 1), ("b", 2)]


def test_cli(spark, capsys, tmp_path):
    assert cli.main(["batch_totals", "/root/testdata/sf0.001", "--rows", "2"]) == 0
    assert len(capsys.readouterr().out.splitlines()) == 2
    assert cli.main(["batch_totals", "/root/testdata/sf0.001", "--table", str(tmp_path / "t")]) == 0
    assert spark.read.json(str(tmp_path / "t")).count() == 20
    assert cli.main(["no_such_query", "x"]) == 1
    with pytest.raises(SystemExit):
        cli.main(["a", "b", "--rows", "0"])
