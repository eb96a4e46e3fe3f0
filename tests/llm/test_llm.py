"""Operators against brute force on a small fixture, and on hard inputs: nulls, empty and long texts, ties, repeats,
empty tables, extra columns."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spokenlake.llm import ann, bpe, components, fingerprint, jaccard, language, licenses, mixing, pii, sharding, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, shard string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DATA = "/root/testdata/sf0.001"


def rows():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["café", "naïve", "12", "don't"]
    out = []
    for i in range(60):
        out.append([i, " ".join(draw.choices(words, k=draw.randint(1, 80))), draw.choice(["en", "de", None]), draw.choice(["b", "a", None])])
    base = " ".join(draw.choices(words, k=120)).split()
    for i in range(60, 200):  # near copies in large number
        own = list(base)
        for _ in range(draw.randint(0, 4)):
            own[draw.randrange(len(own))] = draw.choice(words)
        out.append([i, " ".join(own), "en", "hot"])
    out += [[200 + i, " ".join(base), "en", "hot"] for i in range(30)]
    out += [[300, None, "en", "a"], [301, "", None, None], [302, " \t\n", "en", "a"], [303, "one two", "en", "b"], [304, "ONE two", "en", "b"], [None, "null id here now", "en", "a"], [305, "x" * 200_000, "en", "a"], [306, "word " * 20_000, "en", "a"], [307, "日本語のテキスト 🙂 \x1c\x85 end", "ja", "c"]]
    return [(*r, len(r[1] or ""), 7, "s") for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_bpe(docs, none):
    import base64

    import tiktoken

    path, pattern = bpe.default_vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    theirs = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in bpe.encode_documents(docs, path, pattern).collect()}
    for doc_id, text, *_ in rows():
        ids = theirs.encode_ordinary(text or "")
        r = got[doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert bpe.encode_documents(none, path, pattern).count() == 0
    own = bpe.Encoder(bpe.read_ranks(path), pattern)
    draw = random.Random(1)
    for _ in range(300):
        text = "".join(draw.choice(["a", "b", "th", "e", " ", "é", "ing", "\n", "1", "'s", "#", "\x1c", "　"]) for _ in range(60))
        assert own.encode(text) == theirs.encode_ordinary(text)
        assert own.decode(own.encode(text)) == text.encode()


def brute_components(data):
    sets = {}
    for k, (_, text, *_rest) in enumerate(data):
        w = WORDS.findall((text or "").translate(LOWER))
        sets[k] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k in sets:
        if data[k][0] is not None:
            least[root(k)] = min(least.get(root(k), data[k][0]), data[k][0])
    return collections.Counter((data[k][0], len(sets[k]), least.get(root(k))) for k in sets)


def test_jaccard(docs, none):
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link_documents(docs).collect())
    assert got == brute_components(rows())
    assert jaccard.link_documents(none).count() == 0
    twice = docs.where("doc_id < 5").unionByName(docs.where("doc_id < 5"))
    assert jaccard.link_documents(twice).count() == 10


def clustered(draw, groups, each, words=60):
    """Sets in groups of near copies, and what links them."""
    sets = []
    for g in range(groups):
        base = [g * 10_000 + i for i in range(words)]
        for k in range(each):
            own = list(base)
            for _ in range(draw.randint(0, 6)):
                own[draw.randrange(words)] = g * 10_000 + 5_000 + draw.randrange(2_000)
            sets.append(np.unique(np.array(own, np.uint64)))
    sets = [np.array(s, np.uint64) for s in sorted({tuple(s.tolist()) for s in sets})]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))]
    return sets, pairs


def labels_of(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(x) for x in range(n)]


def test_pivots_join_a_part():
    sets, pairs = clustered(random.Random(3), 4, 25)
    sizes, n = np.array([len(s) for s in sets]), len(sets)
    found, pivots, tests = jaccard.join_part(np.arange(n), sizes, sets, np.ones(n))
    assert labels_of(n, found) == labels_of(n, pairs)
    assert 4 <= pivots < n / 2 and tests + pivots * n < n * (n - 1) / 2


def test_pivots_and_bands_join_large_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    sets, pairs = clustered(random.Random(4), 5, 12)
    n = len(sets)
    members = spark.createDataFrame([(1, n, k, len(s), 1.0 + k % 7, s.astype("<u8").tobytes()) for k, s in enumerate(sets)], "region long, many long, class long, size long, weight double, data binary")
    star, rest = jaccard._level(members)
    found, left = [(r.a, r.b) for r in star.collect()], [r["class"] for r in rest.collect()]
    assert len(left) < n - 8  # the pivots' regions took more than the pivots
    inside = [(a, b) for a, b in pairs if a in left and b in left]
    assert labels_of(n, found + inside) == labels_of(n, pairs)
    bands = [(r.a, r.b) for r in jaccard._bands(members).collect()]
    assert labels_of(n, bands) == labels_of(n, pairs)


def test_links_are_written_by_small_jobs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words, f"t{k}"]) for k in range(30)] + [" ".join([*words[:50], *(f"g{g}x{i}" for i in range(7)), f"u{k}"]) for g in range(3) for k in range(12)]
    texts += [" ".join(f"s{g}x{i}" for i in range(40)) + f" e{k}" for g in range(4) for k in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    exchanges, kept = {}, jaccard.written

    def spied(df, label, keep=False):
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges[label] = max(exchanges.get(label, 0), plan.count("Exchange "))
        return kept(df, label, keep)

    monkeypatch.setattr(jaccard, "written", spied)
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link_documents(docs).collect())
    assert got == brute_components(list(enumerate(texts)))
    assert "cells" in exchanges and max(exchanges.values()) <= 10, exchanges


def test_sets_are_moved_in_few_bytes(spark):
    """Bytes shuffled for a shingle, without broadcasts, as in large tables."""
    draw = random.Random(8)
    texts = []
    for g in range(60):
        base = [f"{draw.randrange(1 << 30):x}" for _ in range(400)]
        for k in range(6):
            texts += [" ".join([*base, f"k{k}"])] * (1 + k % 2)
    texts += [" ".join(f"{draw.randrange(1 << 30):x}" for _ in range(400)) for _ in range(200)]
    data = list(enumerate(texts))
    docs = spark.createDataFrame(draw.sample(data, len(data)), "doc_id long, text string").repartition(4).localCheckpoint()

    def moved():
        context = spark.sparkContext._jsc.sc()
        context.listenerBus().waitUntilEmpty()
        found = context.statusStore().executorList(False)
        return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = moved()
        got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link_documents(docs).collect())
        after = moved()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    sizes = {k: len(t.split()) - 4 for k, t in data}
    assert got == collections.Counter((k, sizes[k], k - k % 9 if k < 540 else k) for k, _ in data)
    assert (after - before) / sum(sizes.values()) < 22, (after - before) / sum(sizes.values())


def test_packed_postings():
    draw = np.random.default_rng(1)
    number = np.concatenate([np.sort(draw.integers(0, 0x10000, n)) for n in (1, 300, 5)])
    values, times = draw.integers(0, 1 << 63, 306, np.uint64), draw.integers(1, 1 << 31, 306)
    packed = jaccard._packed(number, np.array([0, 1, 301]), (values, jaccard.NAMED_BYTES), (times, 4))
    rows = [packed[:, a:b].tobytes() for a, b in ((0, 1), (1, 301), (301, 306))]
    lengths, numbers, shingles, repeated = jaccard._unpacked(rows[::-1], jaccard.NAMED_BYTES, 4)
    order = np.concatenate([np.arange(301, 306), np.arange(1, 301), [0]])
    assert lengths.tolist() == [5, 300, 1] and numbers.tolist() == number[order].tolist()
    assert shingles.tolist() == (values[order] & np.uint64((1 << 48) - 1)).tolist() and repeated.tolist() == times[order].tolist()
    assert [len(x) for x in jaccard._unpacked([], 4)] == [0, 0, 0]


def test_chance_repetitions_only_keep_more(spark, monkeypatch):
    """Shingles that few bytes do not tell apart take nothing away."""
    monkeypatch.setattr(jaccard, "COUNTED_BYTES", 1)
    monkeypatch.setattr(jaccard, "NAMED_BYTES", 1)
    data = [r[:2] for r in rows()]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link_documents(docs).collect()) == brute_components(data)


def test_components(spark):
    draw = random.Random(2)
    pairs = [(draw.randrange(400), draw.randrange(400)) for _ in range(250)] + [(k, k + 1) for k in range(1000, 1100)]
    got = {r.node: r.label for r in components.connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    assert got == {x: root(x) for x in parent}


def brute_likeness(a, b):
    """Likeness from the texts themselves: seeds where both fingerprints agree, grown sign by sign."""
    if a == b:
        return 1.0
    x, y = fingerprint.Mark(a), fingerprint.Mark(b)
    size, left, right = min(fingerprint.WINDOW, len(a), len(b)), bytearray(len(a)), bytearray(len(b))
    if not size:
        return 0.0
    for s in np.flatnonzero((x.slots == y.slots) & (x.slots != fingerprint.EMPTY)):
        i, j = int(x.places[s]), int(y.places[s])
        if a[i : i + size] != b[j : j + size] or (left[i] and right[j] and len(a) > 50_000):
            continue
        low = 0
        while low < min(i, j) and a[i - low - 1] == b[j - low - 1]:
            low += 1
        high = size
        while i + high < len(a) and j + high < len(b) and a[i + high] == b[j + high]:
            high += 1
        left[i - low : i + high] = b"\x01" * (low + high)
        right[j - low : j + high] = b"\x01" * (low + high)
    return (sum(left) + sum(right)) / (len(a) + len(b))


def test_fingerprint_slots_and_hot_ids(spark):
    for text in ("", "ab", "abcdefgh", "the quick brown fox jumps over the lazy dog"):
        mark = fingerprint.Mark(text)
        size = min(8, len(text))
        spans = [fingerprint.PrefixHash(fingerprint.codes_of(text[i : i + size])).whole() for i in range(len(text) - size + 1)] if text else []
        least = {}
        for i, h in enumerate(spans):
            h = np.uint64(h)
            with np.errstate(over="ignore"):
                h = (h ^ (h >> np.uint64(29))) * fingerprint._MIX[0]
                h = (h ^ (h >> np.uint64(32))) * fingerprint._MIX[1]
            v = (int(h) >> 20 & 0xFFFFFF, i)
            least[int(h) >> 58] = min(v, least.get(int(h) >> 58, v))
        for s in range(fingerprint.SLOTS):
            assert mark.slots[s] == (least[s][0] % fingerprint.EMPTY if s in least else fingerprint.EMPTY)
            assert s not in least or mark.places[s] == least[s][1]
    a = "one two three four five six seven eight nine ten " * 9
    half = fingerprint.likeness(fingerprint.Mark(a[:200] + "x" * 200), fingerprint.Mark(a[:200] + "y" * 200))
    assert 0.45 < half <= 0.51
    data = [(None, f"text {i} of no id") for i in range(500)] + [(i, f"other {i}") for i in range(300)] + [(7, "again")] * 3
    got = fingerprint.fingerprint_documents(spark.createDataFrame(data, "doc_id long, text string").repartition(5)).collect()
    assert len(got) == 803 and sum(r.doc_id is None for r in got) == 500 and sum(r.doc_id == 7 for r in got) == 4
    by = {r.doc_id: r for r in got if r.doc_id not in (None, 7)}
    for i in (50, 299):
        after = f"other {i + 1}" if i < 299 else None
        text = f"other {i}"
        if after:
            assert by[i].edited_sha256 == hashlib.sha256((text[: len(text) - len(text) // 2] + after[: len(text) // 2]).encode()).hexdigest()


def test_fingerprint(docs, none):
    text = "abcabcabcx"
    h = fingerprint.PrefixHash(fingerprint.codes_of(text))
    for i in range(len(text)):
        for j in range(len(text)):
            n = next((k for k in range(len(text)) if i + k >= len(text) or j + k >= len(text) or text[i + k] != text[j + k]), len(text))
            assert fingerprint.longest_common_extension(h, i, h, j) == n
    got = {r.doc_id: r for r in fingerprint.fingerprint_documents(docs).collect()}
    order = sorted(((d if d is not None else -(1 << 63)), d, t or "") for d, t, *_ in rows())  # ids do not repeat here
    for k, (_, doc_id, text) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.common_prefix == next((i for i, (x, y) in enumerate(zip(text, edited)) if x != y), min(len(text), len(edited)))
        assert abs(r.near_next - brute_likeness(text, after)) < 1e-12 and (r.near_next == 1.0) == (text == after)
        assert abs(r.near_edited - brute_likeness(text, edited)) < 1e-12
    same = {got[i].fingerprint for i in range(200, 230)}
    assert len(same) == 1 and got[200].near_next == 1.0
    assert fingerprint.fingerprint_documents(none).count() == 0


def test_language(spark, docs, none):
    real = spark.read.parquet(f"{DATA}/documents.parquet")
    model = language.learned(real)
    got = language.identify(real, *model).where(language.fold_of("doc_id", 5) == 0)
    assert got.where("lang = lang_pred").count() >= 0.95 * got.count()
    hard = {r.doc_id: r for r in language.identify(docs, *model).collect()}
    assert [hard[i].lang_pred for i in (300, 301, 302)] == ["und"] * 3
    assert all(0 <= r.score <= 1 for r in hard.values())
    assert language.identify(none, *language.learned(none)).count() == 0
    assert {r.lang_pred for r in language.identify(docs, *language.learned(none)).collect()} == {"und"}


def test_forward_sums_all_segmentations():
    pieces = {"▁a": [0.1, 0.2], "b": [0.3, 0.1], "▁ab": [0.05, 0.01], "a": [0.2, 0.2], "▁": [0.1, 0.1], "bb": [0.01, 0.5]}
    trie, table = language.trie_of({p: i + 2 for i, p in enumerate(pieces)}), np.array([[0, 0], [language.UNKNOWN] * 2, *pieces.values()])

    def brute(w, k):
        return 1.0 if not w else sum((pieces[w[:j]][k] if w[:j] in pieces else language.UNKNOWN if j == 1 else 0.0) * brute(w[j:], k) for j in range(1, len(w) + 1))

    words = ["▁ab", "▁abb", "▁bbabx", "x", "▁"]
    assert np.allclose(np.exp(language.forward(words, trie, table, 3)), [[brute(w, k) for k in range(2)] for w in words], rtol=1e-9)
    for w in ("▁abbabab", "▁" + "ab" * 11):
        assert np.allclose(language.forward_long(w, trie, table), language.forward([w], trie, table, 3)[0], rtol=1e-12)
    endless = language.forward(["▁" + "abx" * 50_000], trie, table, 3)
    assert np.isfinite(endless).all() and endless[0, 0] < -1e5


def segmentations(w):
    return [[]] if not w else [[w[:j], *rest] for j in range(1, len(w) + 1) for rest in segmentations(w[j:])]


def test_expected_counts_cover_all_segmentations():
    pieces = {"▁a": 0.1, "b": 0.3, "▁ab": 0.05, "a": 0.2, "▁": 0.1, "bb": 0.01, "bab": 0.02}
    for word in ("▁ab", "▁abbab", "▁xbab", "b"):
        want, whole = collections.Counter(), 0.0
        for parts in segmentations(word):
            p = np.prod([pieces[x] if x in pieces else language.UNKNOWN if len(x) == 1 else 0.0 for x in parts])
            whole += p
            for x in parts:
                want[x] += p
        got = collections.Counter()
        language.expected(word, 2.0, language.trie_of(pieces), got)
        assert all(np.isclose(got[x], 2 * v / whole, rtol=1e-9) for x, v in want.items())
    long = collections.Counter()
    language.expected("▁" + "xab" * 3000, 1.0, language.trie_of(pieces), long)
    assert abs(sum(len(k) * v for k, v in long.items()) - 9001) < 1e-3


def test_toxicity(spark, docs, none):
    real = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    model = toxicity.learn(real, labels.where(fold != 1))
    held = toxicity.score_documents(real.join(labels, "doc_id").where(fold == 1), model)
    assert held.where("predicted = toxic").count() >= 0.9 * held.count()
    hard = toxicity.score_documents(docs, model).collect()
    assert len(hard) == docs.count() and all(0 <= r.score <= 1 for r in hard)
    assert {r.predicted for r in hard if r.doc_id in (300, 301, 302)} == {0}
    assert toxicity.score_documents(none, toxicity.learn(none, spark.createDataFrame([], "doc_id long, toxic int"))).count() == 0
    assert toxicity.fold("Id1ot, 1D10T! ѕtuріd st$ff") == " idiot  idiot  stupid stsff "


def test_toxicity_matches_against_brute_force(spark):
    draw = random.Random(11)
    letters = lambda n: "".join(draw.choices("ab", k=n))
    for _ in range(300):
        weights = {" " + letters(draw.randint(1, 3)): 1.0 + k for k in range(4)}
        phrases = [f" {letters(2)} {letters(2)} " for _ in range(3)]
        folded = f" {' '.join(letters(draw.randint(1, 3)) for _ in range(30))} "
        found = {at: max(w for e, w in weights.items() if folded.startswith(e, at)) for at in range(len(folded)) if any(folded.startswith(e, at) for e in weights)}
        spans = [(at, at + len(p) - 1) for p in phrases for at in range(len(folded)) if folded.startswith(p, at)]
        want = sorted((at, w) for at, w in found.items() if not any(a <= at < b for a, b in spans))
        assert sorted(toxicity.matches(toxicity.Model(weights, phrases).matcher(), folded)) == want
    start = time.time()
    assert toxicity.matches(toxicity.Model({" bad": 1.0}, [" bad can "]).matcher(), " " + "bad can " * 200_000) == []
    assert time.time() - start < 20
    assert toxicity.fold("x\u201cBad\u201d\u2014word\u00a0end_1") .split() == ["x", "bad", "word", "end", "i"]
    assert toxicity.features(" abcde fg ") == {" abcd", " abcde", " fg "}
    texts = [(i, 1, f"so{i} xq z{i}") for i in range(40)] + [(100 + i, 0, f"so{i} z{i} fine") for i in range(40)]
    table = spark.createDataFrame(texts, "doc_id long, toxic int, text string")
    model = toxicity.learn(table, table.select("doc_id", "toxic"))
    assert set(model.weights) == {" xq "}  # a word below four letters
    many = toxicity._select({f" {chr(97 + k // 676)}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}xy": (50, 0) for k in range(9000)}, 100, 100)
    assert len(many) == 9000


def test_exceptions_cover_their_entries():
    model = toxicity.Model({" trash": 2.0}, [" trash can "])
    m = model.matcher()
    assert toxicity.matches(m, toxicity.fold("a trash can")) == []
    assert len(toxicity.matches(m, toxicity.fold("a trash can of trash"))) == 1


def test_ann(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(900, 16))
    x[100:300] = x[100]  # ties
    data = [(int(i), [float(v) for v in r], 0, "c") for i, r in enumerate(x)]
    data += [(1000, None, 0, "c"), (1001, [0.0] * 16, 0, "c"), (1002, [float("nan")] * 16, 0, "c"), (1003, [None] * 16, 0, "c"), (None, [1.0] * 16, 0, "c")]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, score string")
    got = collections.defaultdict(list)
    for r in ann.search(table.where("vec_id % 20 = 0"), table).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    v, found = x.astype(np.float32).astype(np.float64), 0
    assert sorted(got) == [i for i in range(900) if i % 20 == 0]
    for q, hits in got.items():
        s = v @ v[q]
        best = [i for i in np.lexsort((np.arange(900), -s)) if i != q][:20]
        found += len(set(best) & {h[1] for h in hits})
        assert [h[0] for h in hits] == list(range(1, 21))
        assert all(abs(h[2] - s[h[1]]) < 1e-9 for h in hits)
        assert [(-h[2], h[1]) for h in hits] == sorted((-h[2], h[1]) for h in hits)
    assert found >= 0.9 * 20 * len(got)
    stray = table.where("vec_id < 40").unionByName(spark.createDataFrame([(2000, [1.0] * 17, 0, "c"), (2001, [1.0] * 17, 0, "c")], table.schema))
    assert ann.search(stray.where("vec_id in (0, 2000)"), stray).select("query_id").distinct().count() == 1
    again = ann.search(table.where("vec_id = 0"), table.unionByName(table.where("vec_id = 5").withColumn("embedding", F.transform("embedding", lambda x: (x * 0.5).cast("float"))))).collect()
    assert len(again) == 20 and len({r.vec_id for r in again}) == 20
    copies = table.where("vec_id = 5").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(200)))).drop("copy")  # more than leave a block
    crowd = ann.search(table.where("vec_id = 5").withColumn("vec_id", F.lit(-1).cast("long")), table.unionByName(copies)).collect()
    assert len(crowd) == 20 and len({r.vec_id for r in crowd}) == 20 and crowd[0].vec_id == 5
    few = ann.search(table.where("vec_id in (0, 1)"), table.where("vec_id in (0, 1)")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in few) == [(0, 1, 1), (1, 1, 0)]
    assert ann.search(table.where("false"), table.where("false")).count() == 0


def test_ann_cut_finely(spark, monkeypatch):
    """All lists probed: many blocks, groups of queries and pieces give what brute force gives, ties and ids included."""
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 40)
    draw = np.random.default_rng(5)
    x = draw.normal(size=(700, 12)).round(1)
    x[:230] = x[0]
    x = x.astype(np.float32).astype(np.float64)
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in ann.search(table.where("vec_id % 7 = 0"), table, probes=1000).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 700, 7))
    for q, hits in got.items():
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        assert hits == [(i, s[i]) for i in np.lexsort((np.arange(700), -s))[:20]]


def test_ann_finds_neighbours_among_near_copies(spark):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:2000] = x[0] + 0.05 / np.sqrt(32) * draw.normal(size=(2000, 32))
    x[:2000] /= np.linalg.norm(x[:2000], axis=1, keepdims=True)
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got, v, found = collections.defaultdict(set), x.astype(np.float32).astype(np.float64), 0
    for r in ann.search(table.where("vec_id % 50 = 0 and vec_id < 2000"), table).collect():
        got[r.query_id].add(r.vec_id)
    for q, hits in got.items():
        s = v @ v[q]
        s[q] = -9
        found += len(set(np.lexsort((np.arange(len(s)), -s))[:20].tolist()) & hits)
    assert len(got) == 40 and found >= 0.97 * 20 * len(got)


def test_sharding(docs, none):
    got = sharding.shard_documents(docs).collect()
    assert len(got) == docs.count()
    texts = {d: t or "" for d, t, *_ in rows()}
    shards, of = collections.defaultdict(list), collections.defaultdict(set)
    for r in got:
        shards[r.shard].append(r.slot)
        of[texts[r.doc_id]].add(r.shard)
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id].encode()) + 1, zlib.crc32(texts[r.doc_id].encode()))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert set(shards) <= set(range(16)) and all(len(s) == 1 for s in of.values())
    assert sharding.shard_documents(none).count() == 0


def test_a_heavy_text_has_a_shard_and_the_rest_is_even(spark):
    draw = random.Random(12)
    data = [(i, "same text here") for i in range(300)] + [(1000 + i, " ".join(draw.choices(["A.", "b,", "cc", "\n", "é"], k=draw.randint(1, 9)))) for i in range(700)]
    table = spark.createDataFrame(data, "doc_id long, text string")
    rows_ = sharding.shard_documents(table, 8).collect()
    sizes, of = collections.Counter(), collections.defaultdict(set)
    texts = dict(data)
    for r in rows_:
        sizes[r.shard] += r.size
        of[texts[r.doc_id]].add(r.shard)
    heavy = of.pop("same text here")
    assert len(heavy) == 1 and all(len(s) == 1 and not s & heavy for s in of.values())
    rest = [v for k, v in sizes.items() if k not in heavy]
    assert len(rest) == 7 and max(rest) < 1.35 * sum(rest) / 7
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.shard_documents(table.repartition(7), 8).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows_}
    one = sharding.shard_documents(table.where("doc_id < 300"), 8).collect()
    assert len({r.shard for r in one}) == 1 and sorted(r.slot for r in one) == list(range(300))


def test_cuts_are_weighted_medians(spark):
    """The first cut against brute force: the widest dimension, at half the bytes."""
    draw = random.Random(13)
    data = [(i, draw.choice(["x", ".", ",", " ", "é"]) * draw.randint(1, 400)) for i in range(400)]
    rows_ = sharding.points(spark.createDataFrame(data, "doc_id long, text string"))
    node = sharding.Node(2)
    sharding._cut(rows_, [node])
    got = rows_.collect()
    widths = {d: max(r[d] for r in got) // sharding.TIES - min(r[d] for r in got) // sharding.TIES for d in sharding.DIMENSIONS}
    assert widths[node.dim] == max(widths.values())
    weights = sorted((r[node.dim], r.size) for r in got)
    total, at, best = sum(w for _, w in weights), 0, None
    for key, w in weights:
        best = min(best or (total, 0), (abs(total / 2 - at), key))
        at += w
    left = sum(w for key, w in weights if key < node.cut)
    assert left == node.left and abs(left - total / 2) <= max(sharding.TOLERANCE * total, best[0])


def test_shards_are_even(spark):
    got = sharding.shard_documents(spark.read.parquet(f"{DATA}/documents.parquet")).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    sizes = [r.s for r in got]
    assert len(sizes) == 16 and max(sizes) < 1.2 * sum(sizes) / 16


def brute_targets(sizes):
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        share = left / sum(weight[n] for n in free)
        over = [n for n in free if share * weight[n] > 2 * sizes[n] - 1e-9]
        if not over:
            return target | {n: share * weight[n] for n in free}
        for n in over:
            target[n] = 2.0 * sizes[n]
            left -= 2 * sizes[n]
            free.remove(n)
    return target


def test_mixing(docs, none):
    out, slots = mixing.mix_documents(docs, block_words=8)
    got = out.collect()
    assert len(got) == docs.count()
    sizes = collections.Counter()
    for _, text, _, source, *_ in rows():
        sizes[source] += len(WORDS.findall(text or ""))
    want, taken = brute_targets(sizes), collections.Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 16 for s in sizes)
    again = mixing.mix_documents(docs.repartition(5), block_words=8)[0].collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))
    assert slots.groupBy("source", "position").count().where("count > 1").count() == 0
    assert mixing.mix_documents(none)[0].count() == 0


def test_multinomial(spark):
    drawn = spark.range(4000).select(mixing.multinomial(F.lit(200), 8, F.col("id")).alias("c")).collect()
    counts = np.array([r.c for r in drawn])
    assert counts.shape == (4000, 8) and (counts.sum(1) == 200).all()
    assert np.allclose(counts.mean(0), 25, atol=0.4) and np.allclose(counts.var(0), 200 / 8 * 7 / 8, rtol=0.12)
    assert abs(np.corrcoef(counts[:, 0], counts[:, 1])[0, 1] + 1 / 7) < 0.06
    none = spark.range(1).select(mixing.multinomial(F.lit(0), 4, F.col("id")).alias("c")).first().c
    assert none == [0, 0, 0, 0]


def test_slots_follow_the_draws(docs):
    taken, slots = mixing.mix_documents(docs, block_words=8)
    got = slots.collect()
    assert {r.shard for r in got} == set(range(mixing.SHARDS))
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append((r.position, r.shard, r.block))
    for rows_ in by.values():
        rows_.sort()
        assert [p for p, _, _ in rows_] == list(range(len(rows_)))
        blocks = max(b for _, _, b in rows_) + 1
        assert len({b for _, _, b in rows_[:blocks]}) == min(blocks, len(rows_))  # no block twice before all were taken


def test_permutation(spark):
    for n in (1, 2, 3, 7, 64, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(9)).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


def test_licenses(spark, docs, none):
    more = [(900, "Released Under the MIT License. apache license, version 2.0 under the mit-license; CC BY-NC cc by nc", "x"), (901, "permission is hereby granted free of charge to any person obtaining one copy of this software and its associated documentation files", "x"), (902, "workK under the mit licence", "x")]
    table = docs.select("doc_id", "text", "shard").unionByName(spark.createDataFrame(more, "doc_id long, text string, shard string"))
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    texts = {d: t or "" for d, t, *_ in [*rows(), *more]}
    for r in licenses.scan_documents(table).collect():
        w = word.findall(texts[r.doc_id].translate(LOWER))
        at, labels = [], set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            here = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            at += here
            labels |= {label} if here else set()
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1
        if r.doc_id == 901:
            assert r.labels == "mit" and r.n_base == 0
    nc = "This is a Creative Commons Attribution-NonCommercial 4.0 International License, all rights reserved"
    mit = next(x for x, label in licenses.TEMPLATES if label == "mit" and len(x) > 500)
    backwards = " ".join(reversed("licensed under the gnu general public license version 3".split()))
    shuffled = "international license 4 0 international noncommercial 4 0 attribution noncommercial 4 commons attribution noncommercial creative commons attribution"
    cases = [(nc, "cc-by-nc"), ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by"), ("All rights reserved.", ""), (mit, "mit"), (mit.replace("express", "expressly stated"), "mit"), (backwards, ""), (shuffled, ""), (mit + " and licensed under the gnu general public license version 3", "gpl-3,mit")]
    got = licenses.scan_documents(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.labels for r in got] == [label for _, label in cases]
    for r, (text, _) in zip(got, cases):
        w = word.findall(text.translate(LOWER))
        want = 0.0
        for span in r.spans or []:
            runs = [x.split() for x, _ in (*licenses.PHRASES, *licenses.TEMPLATES)][span.template]
            at, hit = span.start, 0
            for k in range(len(runs) - 2):  # greedy, as the runs stand in the template
                here = next((i for i in range(at, len(w) - 2) if w[i : i + 3] == runs[k : k + 3] and abs((i - k) - (at - k)) < 40), None)
                if here is not None:
                    hit, at = hit + 1, here + 1
            want = max(want, hit / (len(runs) - 2))
        assert abs(r.score - want) < 1e-9 or r.n_base
    assert licenses.scan_documents(none).count() == 0


def luhn(s):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def test_pii(spark, docs, none):
    texts = ["a 4111 1111 1111 1111 b 4111111111111111", "joe.doe_12@mail7.example.com x", "+1 (017) 555-7713 and +1-017-555-7713", "ip 97.51.17.173 10.0.0.256", "on 2024-02-29 and 29.02.2024 but 2023-02-30", "GB82 WEST 1234 5698 7654 32", "123-45-6789 000-11-2222", "9c8b45435718dcc700c184a7e303cdc64c6a8f7f", None, "", "plain 12, 3.5 and 2024", "X" * 100_000 + "@", "1234567890123456"]
    table = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n_private long")
    got = {r.doc_id: r for r in pii.pseudonymise(table, "k1").collect()}
    assert [got[i].n_private for i in range(len(texts))] == [2, 1, 2, 1, 2, 1, 1, 1, 0, 0, 0, 0, 1]
    for i in range(len(texts)):
        shape = lambda t: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", t))) if t is not None else None
        if i not in (3, 7):
            assert shape(got[i].text) == shape(texts[i])
        assert (got[i].text == texts[i]) == (got[i].n_private == 0)
    a, b = re.findall(r"\d[\d ]{14,17}\d", got[0].text)
    assert luhn(a.replace(" ", "").strip()) and a.replace(" ", "") == b.replace(" ", "")
    assert len(set(re.sub("[^0-9]", "", x) for x in got[2].text.split(" and "))) == 1
    iban = got[5].text.replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert got[4].text.split()[1] == "-".join(reversed(got[4].text.split()[3].split(".")))
    assert pii.pseudonymise(none, "k1").count() == 0
    assert pii.pseudonymise(docs, "k1").where(F.col("n_private") > 0).count() == 0


def test_pii_beside_other_words(spark):
    ibans = ["ES91 2100 0418 4502 0005 1332", "SE45 5000 0000 0583 9825 7466", "ES9121000418450200051332", "NO93 8601 1117 947"]
    texts = [f"to {i} {w}" for i, w in zip(ibans, ("EUR", "SEK", "BBVA", "AB12"))]
    texts += ["at 2024-02-29T10:00:00Z", "2024-01-05/2024-02-05", "on 12/31/2024.", "3782 822463 10005", "6759 6498 2643 8451 007", "4111 1111 1111 1111 123", "a/2024-01-05/b 2024/13/13 13/13/2024", "1111 222222 33333"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(table, "k1").collect()}
    assert [got[i].n_private for i in range(len(texts))] == [1, 1, 1, 1, 1, 2, 1, 1, 1, 1, 0, 0]
    for i, iban in enumerate(ibans):
        new = got[i].text[3 : 3 + len(iban)]
        assert new != iban and got[i].text[3 + len(iban) :] == texts[i][3 + len(iban) :]
        assert int("".join(str(int(c, 36)) for c in new[4:].replace(" ", "") + new[:4])) % 97 == 1
    assert got[0].text[3:32].replace(" ", "") == got[2].text[3:27]
    assert got[4].text.endswith("T10:00:00Z") and "2024-02-29" not in got[4].text
    a, b = got[5].text.split("/")
    assert a != "2024-01-05" and b != "2024-02-05"
    month, day, year = got[6].text[3:-1].split("/")
    assert 1 <= int(month) <= 12 < int(day) and (month, day, year) != ("12", "31", "2024")
    for i in (7, 8):
        assert luhn(got[i].text.replace(" ", "")) and got[i].text != texts[i]
    assert got[9].text.endswith(" 123") and luhn(got[9].text[:19].replace(" ", ""))


def brute_permute(value, key, tag, alphabets):
    """The Feistel network on a string, in plain Python."""
    half = len(value) // 2
    a, b = value[:half], value[half:]

    def turn(part, other, r):
        mask = hashlib.sha256("|".join([key, tag, str(r), str(len(value)), other]).encode()).digest()
        out = ""
        for i, c in enumerate(part):
            for alphabet in alphabets:
                if c in alphabet:
                    c = alphabet[(alphabet.index(c) + mask[i % 32]) % len(alphabet)]
                    break
            out += c
        return out

    for r in range(pii.ROUNDS):
        a, b = (turn(a, b, r), b) if r % 2 == 0 else (a, turn(b, a, r))
    return a + b


def test_pii_against_brute_force(spark):
    draw = random.Random(6)
    digits = lambda n: "".join(draw.choices("0123456789", k=n))
    numbers = [digits(n) for n in (13, 20, 31)]
    tokens = ["".join(draw.choices("0123456789abcdef", k=n)) for n in (32, 64, 128)] + ["".join(draw.choices("abcdef", k=40))]
    mails = ["Joe.Doe_12@Mail7.example.com", "joe.doe_12@mail7.example.com", "a" * 90 + "@x.y.z.a.b.c.d.e.f.g.org"]
    texts = [*(f"n {n} e" for n in numbers if not luhn(n) or len(n) > 19), *(f"t {x} e" for x in tokens), *(f"m {m} e" for m in mails)]
    table = spark.createDataFrame([(i, t, "f", 5) for i, t in enumerate(texts)], "doc_id long, text string, _found string, _new int")
    out = pii.pseudonymise(table, "k1")
    got = [r for r in out.orderBy("doc_id").collect()]
    assert out.columns == ["doc_id", "text", "_found", "_new", "n_private"] and {(r._found, r._new) for r in got} == {("f", 5)}
    for text, r in zip(texts, got):
        kind, value = text[0], text[2:-2]
        if kind == "m":
            body, last = value.rsplit(".", 1)
            want = brute_permute(body.lower(), "k1", "email", (pii.DIGITS, pii.LOWERS)) + "." + last
            assert r.text[2:-2].lower() == want and [c.isupper() for c in r.text[2:-2]] == [c.isupper() for c in value]
        else:
            assert r.text[2:-2] == brute_permute(value, "k1", {"n": "number", "t": "secret"}[kind], (pii.DIGITS if kind == "n" else pii.HEX,))
        assert r.n_private == 1
    plan = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "k1" not in re.sub(r"[0-9a-f]{32}", "", plan)
    phones = spark.createDataFrame([(1, "call 555 123 4567 or 5552234567; 1700000000 and 1999-12-31 or 3024-01-31")], "doc_id long, text string")
    moved = pii.pseudonymise(phones, "k1").first()
    assert moved.n_private == 4 and "1700000000" in moved.text
    assert pii.pseudonymise(table.unionByName(table), "k1").distinct().count() == len(texts)
    with pytest.raises(ValueError):
        pii.pseudonymise(table, "")


def test_feistel_is_a_permutation(spark):
    three = spark.range(1000).select(pii.permute_text(F.lpad(F.col("id").cast("string"), 3, "0"), F.lit("k"), "t").alias("p"))
    assert three.distinct().count() == 1000
    days = spark.range(35).select(pii.permute_number(F.col("id"), F.lit("k"), "t", 5, 7).alias("p")).collect()
    assert sorted(r.p for r in days) == list(range(35))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        docs = stage(spark, docs, DATA)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == corpus_pipeline.COLUMNS
            docs = corpus_pipeline.written(docs, "test")
        if k in (0, 2, 4):
            assert docs.count() >= 0.95 * before
    assert docs.where("n_tokens > 0").count() > 0


def test_pipeline_on_hard_rows(spark):
    """Nulls in every column, empty texts, repeated rows, other columns of clashing names, an empty table."""
    import corpus_pipeline

    real = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 60").select(*corpus_pipeline.COLUMNS)
    hard = spark.createDataFrame([(None, None, None, None, None), (None, "", None, None, 0), (5, " \n", "en", None, 3), (None, None, "en", "a", None)], real.schema)
    marked = real.unionByName(hard).unionByName(real.where("doc_id < 3")).withColumn("row", F.lit("x")).withColumn("score", F.lit(2)).withColumn("size", F.lit("y"))
    for start in (marked, marked.where("false")):
        docs, counts = start, [start.count()]
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.written(stage(spark, docs, DATA), name)
            assert docs.columns == corpus_pipeline.COLUMNS
            counts.append(docs.count())
        ids = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
        assert ids.count() == counts[-1]
        if not counts[0]:
            assert counts == [0] * 5
    kept = corpus_pipeline.keep_languages(spark, marked, DATA)
    assert kept.where("text is null or trim(text) = ''").count() == 0 and kept.count() >= real.count()
    moved = corpus_pipeline.hide_personal_data(spark, marked, DATA)
    assert moved.count() == marked.count() and moved.where("n_chars <> length(text)").count() == 0
    one = corpus_pipeline.drop_near_duplicates(spark, marked, DATA)
    want = {min((k is None, k) for k, _, c in got) for got in [[(r.doc_id, r.text, 0)] for r in marked.where("text is null").collect()]}
    assert one.where("text is null").count() == 2 and len(want) == 1  # rows without text are linked with nothing


def test_pipeline_run_leaves_no_tables(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    from spokenlake.llm import common

    spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 80").write.parquet(str(tmp_path / "in" / "documents.parquet"))
    monkeypatch.setattr(common, "shared_dir", lambda spark: "file://" + str(tmp_path / "shared"))
    got = corpus_pipeline.run(spark, str(tmp_path / "in"))
    assert got.count() > 0 and not common._TEMPORARY
    assert [p.name.rsplit("-", 1)[0] for p in (tmp_path / "shared" / "spokenlake").iterdir() if not p.name.startswith(".")] == ["pipeline-mixing"]


def test_pipeline_tells_rows_apart_without_ids(spark):
    import corpus_pipeline

    draw = random.Random(9)
    text = lambda n: " ".join(draw.choices([f"v{i}" for i in range(900)], k=n))
    near, pair, group = text(80), text(80), text(80)
    alone = [text(60) for _ in range(40)]
    data = [(None, t) for t in alone] + [(None, near), (None, near + " more"), (7, pair), (7, pair), (9, group), (8, group), (None, group)] + [(7, text(60))]
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in data], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = corpus_pipeline.written(corpus_pipeline.drop_near_duplicates(spark, docs, DATA), "test")
    got = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    assert sum(got[None, t] for t in (near, near + " more")) == 1
    assert got[7, pair] == 1 and got[8, group] == 1 and all(got[None, t] == 1 for t in alone)
    assert sum(got.values()) == len(alone) + 4
    sized = spark.createDataFrame([(None, "w " * n, "en", "a" if n < 40 else "b", 2 * n) for n in (3, 5, 8, 900, 1500)], docs.schema)
    mixed = collections.Counter(r.text for r in corpus_pipeline.mix_sources(spark, sized, DATA).collect())
    copies = {r.doc_id: r for r in mixing.mix_documents(sized.withColumn("n", F.col("n_chars") / 2), id_column="n")[0].collect()}
    assert all(abs(mixed["w " * n] - r.taken / r.size) < 1 for n, r in copies.items())
