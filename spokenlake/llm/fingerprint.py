"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` holds, for a text of n code points, the sums of (code + 1) * B^i modulo a prime for two bases. A difference
of two prefix values, freed of its power of B, is the hash of a span, so spans compare in constant time and the longest
common extension of two positions is found by binary search. A fingerprint is the hash of the whole text and, for each of
``SLOTS`` slots, its smallest window hash. Slots that two fingerprints share are seeds: where their windows are equal spans
the extension to both sides gives a common span, and likeness is the share of both texts that common spans cover.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, partitions, process_cache, release_memory

PRIME = (1 << 31) - 1
BASES = (911_382_323, 972_663_749)
WINDOW = 8
SLOTS = 64
EMPTY = 0xFFFF
FIRST_KEY = -(1 << 63)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def _powers(n: int) -> list[np.ndarray]:
    """For each base its powers and inverse powers 0..n-1; kept by the process, doubled when a longer text comes."""
    kept = process_cache("fingerprint").get("poly_powers")
    if kept is None or len(kept[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        kept = []
        for base in BASES:
            for step in (base, pow(base, -1, PRIME)):
                out = np.ones(size, np.uint64)
                done = 1
                while done < size:  # out[done:2 * done] = out[:done] * step ** done
                    out[done : 2 * done] = out[:done] * np.uint64(pow(step, done, PRIME)) % PRIME
                    done *= 2
                kept.append(out)
        process_cache("fingerprint")["poly_powers"] = kept
    return kept


class PrefixHash:
    """Modular prefix arrays of an array of code points."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.powers = _powers(self.n + 1)
        self.prefix = []
        for k in range(2):
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum((codes + np.uint64(1)) * self.powers[2 * k][: self.n] % PRIME, out=sums[1:])
            self.prefix.append(sums % PRIME)

    def span(self, start: int, size: int) -> tuple[int, int]:
        """Hash of the code points start .. start + size - 1; equal spans have equal hashes wherever they stand."""
        return tuple((int(g[start + size]) - int(g[start])) % PRIME * int(self.powers[2 * k + 1][start]) % PRIME for k, g in enumerate(self.prefix))

    def windows(self, size: int) -> np.ndarray:
        """62-bit hashes of all windows of ``size`` code points; of the whole text if it is shorter; none if empty."""
        size = min(size, self.n)
        if not size:
            return np.zeros(0, np.uint64)
        many = self.n - size + 1
        both = [(g[size:] + np.uint64(PRIME) - g[:many]) % PRIME * self.powers[2 * k + 1][:many] % PRIME for k, g in enumerate(self.prefix)]
        return (both[0] << np.uint64(31)) | both[1]

    def whole(self) -> int:
        a, b = self.span(0, self.n)
        return a << 31 | b


def longest_common_extension(a: PrefixHash, i: int, b: PrefixHash, j: int, low: int = 0) -> int:
    """Length of the longest common span that starts at i in a and at j in b; ``low`` of it are known."""
    high = min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a.span(i, mid) == b.span(j, mid) else (low, mid - 1)
    return low


def longest_common_ending(a: PrefixHash, i: int, b: PrefixHash, j: int) -> int:
    """Length of the longest common span that ends before i in a and before j in b."""
    low, high = 0, min(i, j)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a.span(i - mid, mid) == b.span(j - mid, mid) else (low, mid - 1)
    return low


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


class Mark:
    """A text's prefix arrays and fingerprint: the whole text's hash, and of each slot the smallest window hash and its
    first place."""

    def __init__(self, text: str):
        self.hashed = PrefixHash(codes_of(text))
        h = self.hashed.windows(WINDOW)
        h = (h ^ (h >> np.uint64(29))) * _MIX[0]
        h = (h ^ (h >> np.uint64(32))) * _MIX[1]
        none = np.iinfo(np.uint64).max
        least = np.full(SLOTS, none, np.uint64)
        # 24 bits of the hash above 34 of the place
        np.minimum.at(least, (h >> np.uint64(58)).astype(np.intp), (h >> np.uint64(20) & np.uint64(0xFFFFFF)) << np.uint64(34) | np.arange(len(h), dtype=np.uint64))
        empty = least == none
        self.places = np.where(empty, np.uint64(0), least & np.uint64((1 << 34) - 1)).astype(np.int64)
        # The minimum of many values has few leading bits left, so a remainder, not a prefix, is kept of it.
        self.slots = np.where(empty, EMPTY, (least >> np.uint64(34)) % np.uint64(EMPTY)).astype(np.uint16)

    def text(self) -> str:
        return f"{self.hashed.whole():016x}" + self.slots.astype(">u2").tobytes().hex()


def covered(spans: list[tuple[int, int]]) -> int:
    total = reach = 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


def likeness(a: Mark, b: Mark) -> float:
    """The share of both texts that lies in common spans found from shared slots; 1 for equal texts, also empty ones."""
    x, y = a.hashed, b.hashed
    if x.n == y.n and x.whole() == y.whole():
        return 1.0
    size, found = min(WINDOW, x.n, y.n), []
    seeds = np.flatnonzero((a.slots == b.slots) & (a.slots != EMPTY)) if size else ()
    for i, j in sorted((int(a.places[s]), int(b.places[s])) for s in seeds):
        if any(p <= i < p + n and j - i == q - p for p, q, n in found):
            continue  # inside a span that is known
        if x.span(i, size) == y.span(j, size):
            back = longest_common_ending(x, i, y, j)
            found.append((i - back, j - back, back + longest_common_extension(x, i, y, j, size)))
    return (covered([(p, p + n) for p, _, n in found]) + covered([(q, q + n) for _, q, n in found])) / (x.n + y.n)


DEALT = "bucket int, tail boolean, key long, hash long, doc_id long, text string"
OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix long"


def bounds_of(rows: DataFrame, parts: int) -> np.ndarray:
    """(key, hash) where ranges begin. A key that fills several ranges is divided by its texts' hashes."""
    shares = [i / parts for i in range(1, parts)]
    found = sorted(rows.agg(F.percentile_approx("key", shares, 100 * parts).alias("q")).first().q or []) if parts > 1 else []
    out = [(FIRST_KEY, -(1 << 63))]
    for key in sorted(set(found)):
        times = found.count(key)
        out += [(key, -(1 << 63) + k * ((1 << 64) // times)) for k in range(times)]
    return np.array(sorted(set(out)), [("key", "<i8"), ("hash", "<i8")])


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of each document and of its text edited with the next document's beginning.

    Documents are in the order of doc_id (null before all others), of equal ids in the order of their texts' hashes, and
    the next document is the next row of it, after the last the first; so a single one is its own next. They are dealt by
    ranges of that order; the row that opens a range goes to the range before it as well, so each task streams through
    sorted rows, always has the next at hand, and keeps two texts at most, however many rows an id has. One shuffle of the
    texts. Null text counts as empty; texts are hashed whole. Other columns are not read. Empty table: no rows.
    """
    spark = docs.sparkSession
    text_ = F.coalesce(docs[text_column], F.lit(""))
    rows = docs.select(F.coalesce(docs[id_column].cast("long"), F.lit(FIRST_KEY)).alias("key"), F.xxhash64(text_).alias("hash"), docs[id_column].cast("long").alias("doc_id"), text_.alias("text"))
    bounds = bounds_of(rows, partitions(spark))

    def bucket_of(key: np.ndarray, hash_: np.ndarray) -> np.ndarray:
        at = np.empty(len(key), bounds.dtype)
        at["key"], at["hash"] = key, hash_
        low, high = np.searchsorted(bounds["key"], key, "left"), np.searchsorted(bounds["key"], key, "right")
        out = high - 1
        for k in np.flatnonzero(high - low > 1):  # a divided key
            out[k] = max(low[k] + int(np.searchsorted(bounds["hash"][low[k] : high[k]], hash_[k], "right")) - 1, 0)
        return out

    def opening(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[int, tuple[int, int]] = {}
        for batch in batches:
            key, hash_ = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            bucket = bucket_of(key, hash_)
            order = np.lexsort((hash_, key, bucket))
            for k in order[np.flatnonzero(np.diff(bucket[order], prepend=-1))]:
                here = (int(key[k]), int(hash_[k]))
                first[int(bucket[k])] = min(here, first.get(int(bucket[k]), here))
        yield pa.RecordBatch.from_arrays([pa.array(list(first), pa.int32()), pa.array([v[0] for v in first.values()], pa.int64()), pa.array([v[1] for v in first.values()], pa.int64())], names=["bucket", "key", "hash"])

    opens = rows.select("key", "hash").mapInArrow(opening, "bucket int, key long, hash long").groupBy("bucket").agg(F.min(F.struct("key", "hash")).alias("m")).collect()  # a row a range
    used = sorted(r.bucket for r in opens)
    before = {r.bucket: used[used.index(r.bucket) - 1] for r in opens}
    firsts = {(r.m["key"], r.m["hash"]): r.bucket for r in opens}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "tail", "key", "hash", "doc_id", "text"]
        for batch in batches:
            key, hash_ = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(key, hash_).astype(np.int32)), pa.array(np.zeros(len(key), bool)), *batch.columns], names=names)
            edge = [k for k, at in enumerate(zip(key.tolist(), hash_.tolist(), strict=True)) if at in firsts]
            # of equal rows each task sends one
            edge = list({(int(key[k]), int(hash_[k])): k for k in edge}.values())
            if edge:
                taken = batch.take(pa.array(edge, pa.int64()))
                to = [before[firsts[int(key[k]), int(hash_[k])]] for k in edge]
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array([True] * len(edge)), *taken.columns], names=names)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("common_prefix", pa.int64())])
        for batch in batches:
            made: list[tuple] = []
            for bucket, tail, _, _, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0] != bucket:
                    held = None
                if tail and not held:
                    continue  # of a range's tails the first is enough
                mark = Mark(text)
                if held:
                    _, own_id, own_text, own = held
                    n = len(own_text)
                    edited_text = own_text[: n - n // 2] + text[: n // 2]
                    edited = Mark(edited_text)
                    made.append((own_id, n, hashlib.sha256(edited_text.encode("utf-8", "surrogatepass")).hexdigest(), own.text(), edited.text(), likeness(own, edited), likeness(own, mark), longest_common_extension(own.hashed, 0, edited.hashed, 0)))
                held = None if tail else (bucket, doc_id, text, mark)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), schema.types, strict=True)], schema=schema)
        process_cache("fingerprint").clear()
        release_memory()

    dealt = rows.mapInArrow(deal, DEALT).repartitionById(len(bounds), F.col("bucket"))
    return dealt.sortWithinPartitions("bucket", "tail", "key", "hash").mapInArrow(edit, OUT)


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and likenesses of each document of the table."""
    return fingerprint_documents(documents(spark, sf_dir))
