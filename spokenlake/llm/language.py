"""Language ID with segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the sum over all its
segmentations into pieces, which a forward pass over the word's positions gives in one go; a text's is the product over
its words. The probabilities are learned by expectation-maximisation (forward-backward counts) from a bounded sample.
"""

from __future__ import annotations

import math
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, forget, process_cache, written

UNDETERMINED = "und"
#: Documents of each language to learn from, about; and rounds of expectation-maximisation.
SAMPLE_DOCUMENTS = 150
ROUNDS = 2
#: Probability of a code point that no piece covers, and the weight of each piece before any count.
UNKNOWN, PRIOR = 1e-9, 0.02
MEMO_WORDS = 300_000
#: Documents whose words are scored together.
SLICE = 256
#: Words up to so many code points are summed together as plain numbers; longer ones alone and as logarithms, so that
#: their small probabilities stay above zero. Both give the same sums.
PLAIN = 24


def public_pieces(path: str) -> list[str]:
    """The vocabulary's pieces; U+2581 marks the start of a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p.lower() for p in pieces})


def raw_words(text: str) -> Counter:
    return Counter(unicodedata.normalize("NFC", text).lower().split())


def letters_of(word: str) -> str:
    """The letters of a word; words without any tell nothing and are left out."""
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def marked(word: str) -> str:
    return "▁" + word


def trie_of(pieces: dict) -> dict:
    """Pieces by their code points; a piece's probabilities stand under None."""
    root: dict = {}
    for piece, p in pieces.items():
        node = root
        for c in piece:
            node = node.setdefault(c, {})
        node[None] = p
    return root


def forward(words: list[str], trie: dict, probabilities: np.ndarray, longest: int) -> np.ndarray:
    """For each word the logarithm of the summed probability of all its segmentations, by language. longest: code points of
    the longest piece.

    The trie gives the pieces' row numbers. Words of one length go forward together, position by position: the sum at a
    position adds, for each piece that ends there, the sum where it begins times its probability.
    """
    out = np.zeros((len(words), probabilities.shape[1]))
    by_size: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        if len(word) > PLAIN:
            out[k] = forward_long(word, trie, probabilities)
        else:
            by_size.setdefault(len(word), []).append(k)
    for n, group in by_size.items():
        most = min(n, longest)
        where, rows = [], []
        for w, k in enumerate(group):
            word, base = words[k], w * n * most
            for i in range(n):
                node, at = trie, base + i * most
                for c in word[i : i + most]:
                    node = node.get(c)
                    if node is None:
                        break
                    row = node.get(None)
                    if row is not None:
                        where.append(at)
                        rows.append(row)
                    at += 1
        table = np.zeros(len(group) * n * most, np.int32)  # row 0: no piece
        table[where] = rows
        table = table.reshape(len(group), n, most)
        table[:, :, 0][table[:, :, 0] == 0] = 1  # row 1: a code point without a piece of its own
        sums = np.zeros((n + 1, len(group), probabilities.shape[1]))
        sums[0] = 1.0
        for j in range(1, n + 1):
            for size in range(1, min(j, most) + 1):
                rows_ = table[:, j - size, size - 1]
                if rows_.any():
                    sums[j] += sums[j - size] * probabilities[rows_]
        out[group] = np.log(sums[n])
    return out


def forward_long(word: str, trie: dict, probabilities: np.ndarray) -> np.ndarray:
    """The same for one word of any length, in time and memory proportional to it; sums are kept as a number and the
    logarithm of a factor."""
    n = len(word)
    ahead: dict[int, np.ndarray] = {0: np.ones(probabilities.shape[1])}
    scale = np.zeros(probabilities.shape[1])
    for i in range(n):
        sums = ahead.pop(i)
        node, single = trie, False
        for j in range(i, n):
            node = node.get(word[j])
            if node is None:
                break
            row = node.get(None)
            if row is not None:
                single |= j == i
                part = sums * probabilities[row]
                ahead[j + 1] = ahead[j + 1] + part if j + 1 in ahead else part
        if not single:
            part = sums * probabilities[1]
            ahead[i + 1] = ahead[i + 1] + part if i + 1 in ahead else part
        if i % 16 == 15:  # what lies ahead, relative to the next position
            unit = ahead[i + 1]
            scale += np.log(unit)
            ahead = {k: v / unit for k, v in ahead.items()}
    return scale + np.log(ahead[n])


class Scorer:
    """Words' log probabilities by language, kept for up to MEMO_WORDS words of a process."""

    def __init__(self, langs: list[str], pieces: dict[str, list[float]]):
        self.langs = langs
        self.trie = trie_of({p: i + 2 for i, p in enumerate(pieces)})
        self.probabilities = np.array([[0.0] * len(langs), [UNKNOWN] * len(langs), *pieces.values()]) if langs else np.zeros((2, 0))
        self.longest = max(map(len, pieces), default=1)
        self.rows: dict[str, int] = {}
        self.logs = np.zeros((0, len(langs)))

    def learn(self, words: list[str]) -> None:
        if len(self.rows) + len(words) > MEMO_WORDS:
            self.rows, self.logs = {}, self.logs[:0]
        bare = [letters_of(w) for w in words]
        owner = [k for k, w in enumerate(bare) if w]
        new = np.zeros((len(words), len(self.langs)))
        if owner:
            new[owner] = forward([marked(bare[k]) for k in owner], self.trie, self.probabilities, self.longest)
        first = len(self.rows)
        self.rows.update((w, first + k) for k, w in enumerate(words))
        self.logs = np.concatenate([self.logs[:first], new])

    def score(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        counted = [raw_words(t or "") if self.langs else Counter() for t in texts]
        fresh = set().union(*counted).difference(self.rows) if counted else set()
        if fresh:
            if len(self.rows) + len(fresh) > MEMO_WORDS:
                fresh = set().union(*counted)
            self.learn(sorted(fresh))
        for seen in counted:
            rows = np.fromiter(map(self.rows.__getitem__, seen), np.int64, len(seen))
            logs, times = self.logs[rows], np.fromiter(seen.values(), np.float64, len(seen))
            told = logs[:, :1].any(1) if len(self.langs) else np.zeros(0, bool)  # words without letters have no log
            if not told.any():
                yield UNDETERMINED, 0.0
                continue
            sums = times @ logs
            best = int(sums.argmax())
            yield self.langs[best], float(1.0 / np.exp(sums - sums[best]).sum())


def edges_of(word: str, trie: dict) -> Iterator[tuple[int, int, float]]:
    """Begin, end and probability of each piece of the word, by begin; a code point without a piece of its own is one."""
    for i in range(len(word)):
        node, single = trie, False
        for j in range(i, len(word)):
            node = node.get(word[j])
            if node is None:
                break
            if None in node:
                single |= j == i
                yield i, j + 1, node[None]
        if not single:
            yield i, i + 1, UNKNOWN


def expected(word: str, weight: float, trie: dict, counts: Counter) -> None:
    """Adds the expected count of each piece over all segmentations of a word, by sums forward and backward."""
    if len(word) > PLAIN:
        expected_long(word, weight, trie, counts)
        return
    n = len(word)
    ahead, back = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    edges = list(edges_of(word, trie))
    for i, j, p in edges:
        ahead[j] += ahead[i] * p
    for i, j, p in reversed(edges):
        back[i] += p * back[j]
    for i, j, p in edges:
        counts[word[i:j]] += weight * (ahead[i] * p * back[j] / ahead[n])


def expected_long(word: str, weight: float, trie: dict, counts: Counter) -> None:
    """The same with a power of two for each position, so that sums over words of any length stay above zero."""
    n = len(word)
    ahead, back = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    up, down = [0] * (n + 1), [0] * (n + 1)

    def add(values: list[float], powers: list[int], at: int, value: float, power: int) -> None:
        value, more = math.frexp(value)
        power += more
        if values[at] == 0.0 or power > powers[at]:
            values[at], powers[at] = value + math.ldexp(values[at], max(-1000, powers[at] - power)), power
        else:
            values[at] += math.ldexp(value, max(-1000, power - powers[at]))

    edges = list(edges_of(word, trie))
    for i, j, p in edges:
        add(ahead, up, j, ahead[i] * p, up[i])
    for i, j, p in reversed(edges):
        add(back, down, i, p * back[j], down[j])
    for i, j, p in edges:
        counts[word[i:j]] += weight * math.ldexp(ahead[i] * p * back[j] / ahead[n], max(-1000, min(1000, up[i] + down[j] - up[n])))


def learn(rows: DataFrame, vocabulary: list[str], sample: int = SAMPLE_DOCUMENTS, rounds: int = ROUNDS) -> tuple[list[str], dict[str, list[float]]]:
    """Languages, and by piece its probability in each. rows: text, lang; both non-null.

    Learns from about ``sample`` distinct texts of each language: those whose hash is below the share that leaves so many.
    Each round's expected counts are summed over the cluster; only (language, piece) sums, bounded by the vocabulary, and
    the languages' counts come to the driver.
    """
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return [], {}
    share = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / 1_000_000
    limit = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, sample / sizes[lang]))])[F.col("lang")]
    taken = rows.where(share < limit).groupBy("lang", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w, n in raw_words(text).items():
                    if w := letters_of(w):
                        seen[lang, w] += n
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["lang", "word", "n"])

    words = written(taken.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    even = 1.0 / len(vocabulary)
    model = {lang: dict.fromkeys(vocabulary, even) for lang in langs}
    for _ in range(rounds):
        sent = rows.sparkSession.sparkContext.broadcast(model)

        def step(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            sums: dict[str, Counter] = {}
            tries: dict[str, dict] = {}
            for batch in batches:
                for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if lang not in tries:
                        tries[lang] = trie_of(sent.value[lang])
                    expected(marked(word), n, tries[lang], sums.setdefault(lang, Counter()))
            flat = [(lang, p, v) for lang, c in sums.items() for p, v in c.items() if p in sent.value[lang]]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in flat], t) for i, t in enumerate((pa.string(), pa.string(), pa.float64()))], names=["lang", "piece", "n"])

        got = words.mapInArrow(step, "lang string, piece string, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
        counts: dict[str, dict[str, float]] = {lang: {} for lang in langs}
        for r in sorted(got):
            counts[r.lang][r.piece] = round(r.n, 6)
        for lang in langs:
            whole = sum(counts[lang].values()) + PRIOR * len(vocabulary)
            model[lang] = {p: (counts[lang].get(p, 0.0) + PRIOR) / whole for p in vocabulary}
        sent.unpersist()
    forget(words)
    return langs, {p: [model[lang][p] for lang in langs] for p in vocabulary}


def identify(docs: DataFrame, langs: list[str], pieces: dict[str, list[float]], text_column: str = "text") -> DataFrame:
    """docs with lang_pred and score, the winner's posterior under equal priors.

    ``und`` with score 0 where the text is null, has no letter, or no language was learned. Ties go to the first language.
    Rows that repeat give a row each, and an empty table none; words and texts of any length are scored whole. All other
    columns pass through; columns lang_pred and score are replaced.
    """
    sent, token = docs.sparkSession.sparkContext.broadcast((langs, pieces)), uuid.uuid4().hex
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*kept)
    at = kept.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = process_cache("language")
        if own.get("language_model") != token:
            own.update(language_model=token, language_scorer=Scorer(*sent.value))
        for batch in batches:
            found: list[tuple[str, float]] = []
            for start in range(0, batch.num_rows, SLICE):
                found += own["language_scorer"].score(batch.column(at).slice(start, SLICE).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=[*kept, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", lang_pred string, score double"
    return docs.mapInArrow(run, schema)


def fold_of(id_column: str, folds: int) -> Column:
    return F.crc32(F.col(id_column).cast("string")) % folds


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def learned(docs: DataFrame, path: str | None = None) -> tuple[list[str], dict[str, list[float]]]:
    """The model of a documents table: learned from rows with text and lang outside the held-out fold."""
    rows = docs.where((fold_of("doc_id", 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    return learn(rows, public_pieces(path or default_vocabulary()))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, told by a model of those outside the held-out fifth; a null doc_id is not held out,
    and nothing is learned from it."""
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", F.coalesce(fold_of("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "text")
    return identify(rows, *learned(docs)).select("doc_id", "held_out", "lang_pred", "score")
