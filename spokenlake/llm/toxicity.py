"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding maps look-alike letters and digit substitutions to plain letters, lower-cases, and turns every sign that is
neither a letter nor a digit, of any script, into a blank. The lexicon (word beginnings with the log odds of their document frequencies), the phrases in which its
entries are harmless, and the two numbers of a logistic curve are learned from a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, forget, process_cache, written

#: Labelled documents of each class to learn from, about: the bound on what is learned from, and so on the model's size.
SAMPLE_DOCUMENTS = 3000
#: Lengths of word beginnings that can enter the lexicon, shorter words whole; the least smoothed log odds, toxic documents,
#: and clean documents of an exception phrase.
SHORTEST, LONGEST = 4, 12
LEAST_ODDS, LEAST_DOCUMENTS = 3.0, 12
EXCEPTION_DOCUMENTS = 3
#: Exponent of the text's length (in thousands of words) by which the matched weight is divided.
LENGTH_POWER = 0.15

# Look-alikes of Latin letters, and digits and signs written for letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ɡ": "g", "ӏ": "l",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ｏ": "o", "ａ": "a", "ｅ": "e", "ｉ": "i", "ｓ": "s", "ｔ": "t",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}


def _table() -> dict[int, str]:
    table = {c: " " for c in range(128) if not chr(c).isalnum()}
    table |= {ord(k): v for k, v in (HOMOGLYPHS | {k: v for k, v in SUBSTITUTES.items() if k not in "$!"}).items()}
    return table


FOLDED = _table()
#: What is neither a letter nor a digit, in any script.
SIGNS = re.compile(r"[\W_]")


def fold(text: str) -> str:
    """Words of plain letters, a blank before each and after the last. Signs that also end sentences stay separators
    unless letters stand on both of their sides."""
    text = text.lower()
    if "$" in text or "!" in text:
        chars = list(text)
        for sign in "$!":
            at = text.find(sign)
            while at >= 0:
                if 0 < at < len(text) - 1 and text[at - 1].isalpha() and text[at + 1].isalpha():
                    chars[at] = SUBSTITUTES[sign]
                at = text.find(sign, at + 1)
        text = "".join(chars)
    text = text.translate(FOLDED)
    return f" {text if text.isascii() else SIGNS.sub(' ', text)} "


def features(folded: str) -> set[str]:
    """What a text offers to the lexicon: beginnings of its words, and words that are shorter."""
    return {f" {w[:k]}" for w in set(folded.split()) for k in range(SHORTEST, min(LONGEST, len(w)) + 1)} | {f" {w} " for w in set(folded.split()) if len(w) < SHORTEST}


@dataclass
class Model:
    weights: dict[str, float]  # a blank and a word's beginning -> weight
    exceptions: list[str]  # phrases with a blank at both ends
    slope: float = 1.0
    offset: float = 0.0

    def matcher(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        found = ahocorasick.Automaton()
        for w, v in self.weights.items():
            found.add_word(w, (len(w), v))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), 0.0))
        found.make_automaton()
        return found


def matches(matcher: ahocorasick.Automaton | None, folded: str) -> list[tuple[int, float]]:
    """Starts and weights of lexicon entries that no exception phrase covers; of several at a place the heaviest."""
    found: dict[int, float] = {}
    covered: list[tuple[int, int]] = []
    for end, (size, weight) in matcher.iter(folded) if matcher else ():
        at = end - size + 1
        if weight:
            found[at] = max(weight, found.get(at, 0.0))
        else:
            covered.append((at, end))
    out, spans, reach, k = [], sorted(covered), -1, 0
    for at in sorted(found):  # one walk over both, as spans that begin no later than a hit cover it if they reach beyond it
        while k < len(spans) and spans[k][0] <= at:
            reach, k = max(reach, spans[k][1]), k + 1
        if at >= reach:
            out.append((at, found[at]))
    return out


def strength(hits: list[tuple[int, float]], folded: str) -> float:
    """Matched weight, damped by the text's length."""
    if not hits:
        return 0.0
    return math.log1p(sum(w for _, w in hits)) / (1.0 + folded.count(" ") / 1000.0) ** LENGTH_POWER


def _select(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Word beginnings with high odds. A longer one replaces a shorter one that it nearly always continues; one whose
    beginning is already as telling adds nothing."""
    odds = {f: math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1)) for f, (t, c) in counts.items()}
    longer_of: dict[str, list[str]] = {}
    for g in odds:
        longer_of.setdefault(g[:-1], []).append(g)
    out: dict[str, float] = {}
    for f in sorted(odds, key=lambda f: (len(f), f)):
        if any(g in out and out[g] >= odds[f] - 1.0 for g in (f[:k] for k in range(2, len(f)))):
            continue
        while True:
            longer = max(longer_of.get(f, ()), key=lambda g: (counts[g][0], g), default=None)
            if longer is None or counts[longer][0] < 0.95 * counts[f][0]:
                break
            f = longer
        out[f] = odds[f]
    return dict(sorted(out.items()))


def _curve(points: list[tuple[float, int]]) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a weak pull towards 0."""
    a, b = 1.0, -1.0
    for _ in range(50):
        ga, gb, haa, hab, hbb = 0.01 * a, 0.01 * b, 0.01, 0.0, 0.01
        for x, y in points:
            p = 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, a * x + b))))
            w = p * (1 - p)
            ga, gb = ga + (p - y) * x, gb + (p - y)
            haa, hab, hbb = haa + w * x * x, hab + w * x, hbb + w
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - max(-2.0, min(2.0, da)), b - max(-2.0, min(2.0, db))
        if abs(da) + abs(db) < 1e-6:
            break
    return a, b


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, toxic), which holds only rows that may be learned from.

    About ``sample`` label rows of each class are taken by a hash; as their number is bounded they are broadcast to the
    documents. Of equal texts one is learned from. Feature counts are summed over the cluster; only features with the
    least odds reach the driver. Without toxic rows the model scores all texts low.
    """
    labels = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    sizes = {int(r.toxic): r.n for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1):
        return Model({}, [], 1.0, -4.0)
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    limit = F.when(F.col("toxic") == 1, min(1.0, sample / sizes[1])).otherwise(min(1.0, sample / max(1, sizes.get(0, 0))))
    taken = labels.where(share < limit).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(taken), "doc_id")
    rows = written(rows.groupBy(F.xxhash64("text").alias("h")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text")).select("toxic", "text"), "labelled")
    whole = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = whole.get(1, 0), whole.get(0, 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for f in features(fold(text)):
                    seen.setdefault(f, [0, 0])[1 - toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1] for v in seen.values()], pa.int64())], names=["f", "t", "c"])

    sums = rows.mapInArrow(count, "f string, t long, c long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    found = {r.f: (r.t, r.c) for r in sums.where((F.col("t") >= LEAST_DOCUMENTS) & (odds >= LEAST_ODDS)).collect()}
    model = Model(_select(found, toxic, clean), [])

    def phrases(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folded = " ".join(["", *fold(text).split(), ""])
                own = set()
                for at, _ in matches(matcher, folded):
                    end = folded.index(" ", at + 1)
                    before, after = folded.rfind(" ", 0, max(0, at)), folded.find(" ", end + 1)
                    own |= {folded[before : end + 1]} if before >= 0 else set()
                    own |= {folded[at : after + 1]} if after >= 0 else set()
                for f in own:
                    seen.setdefault(f, [0, 0])[1 - toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1] for v in seen.values()], pa.int64())], names=["f", "t", "c"])

    harmless = rows.mapInArrow(phrases, "f string, t long, c long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    model.exceptions = sorted(r.f for r in harmless.where((F.col("t") == 0) & (F.col("c") >= EXCEPTION_DOCUMENTS)).collect())

    def strengths(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in batches:
            folded = [fold(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([round(strength(matches(matcher, t), t), 6) for t in folded], pa.float64()), batch.column(0)], names=["x", "y"])

    model.slope, model.offset = _curve(sorted((r.x, r.y) for r in rows.mapInArrow(strengths, "x double, y int").collect()))
    forget(rows)
    return model


def score_documents(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """docs with score, predicted (score >= 0.7) and hits, the number of lexicon entries found.

    Null text counts as empty; texts are read whole, in time proportional to their length. Rows that repeat give a row
    each; an empty table gives none. Of several entries at one place the heaviest counts. Other columns pass through;
    columns score, predicted and hits are replaced.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted", "hits")]
    docs, at, token = docs.select(*kept), kept.index(text_column), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = process_cache("toxicity")
        if own.get("toxic_key") != token:
            own["toxic_key"], own["toxic"] = token, model.matcher()
        for batch in batches:
            scores, hits = [], []
            for text in batch.column(at):
                folded = fold(text.as_py() or "")
                found = matches(own["toxic"], folded)
                z = model.slope * strength(found, folded) + model.offset
                scores.append(1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z)))))
                hits.append(len(found))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.7) for s in scores], pa.int32()), pa.array(hits, pa.int64())], names=[*kept, "score", "predicted", "hits"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", score double, predicted int, hits long"
    return docs.mapInArrow(run, schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of each document, by a lexicon of labelled ones outside the held-out third; a null doc_id is not held
    out, and nothing is learned from it."""
    docs = documents(spark, sf_dir)
    fold_of = F.crc32(F.col("doc_id").cast("string")) % 3
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(fold_of != 1)
    rows = docs.select("doc_id", F.coalesce(fold_of == 1, F.lit(False)).alias("held_out"), "text")
    return score_documents(rows, learn(docs, labels)).select("doc_id", "held_out", "score", "predicted", "hits")
