"""Word-shingle sets of whole Arrow batches, hashed with array operations only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import process_cache

WORDS = 5
CHUNK_BYTES = 1 << 20
_BASE, _SEED = 0xD1342543DE82EF95, 20_240_517
_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Random numbers of the 256 bytes (A-Z have those of a-z), white space flags, powers of the base and their inverses."""
    kept = process_cache("shingles").get("shingle_tables")
    if kept is None or len(kept[2]) < n:
        byte = np.random.default_rng(_SEED).integers(1, _MASK, 256, np.uint64, endpoint=True)
        byte[65:91] = byte[97:123]
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        size = 1 << max(16, (n - 1).bit_length())
        powers = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            out, done = np.ones(size, np.uint64), 1
            while done < size:
                out[done : 2 * done] = out[:done] * np.uint64(pow(base, done, 1 << 64))
                done *= 2
            powers.append(out)
        kept = process_cache("shingles")["shingle_tables"] = (byte, space, *powers)
    return kept


def sets_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes: those of all runs of WORDS words, or of the whole sequence if it is
    shorter; none for null texts and texts without words. A word is a run without ASCII white space, A-Z lower-cased."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    missing = texts.is_null().to_numpy(zero_copy_only=False)
    first = 0
    while first < len(texts):
        last = first + 1
        while last < len(texts) and offsets[last + 1] - offsets[first] <= CHUNK_BYTES:
            last += 1
        yield from _chunk(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], missing[first:last])
        first = last


def _chunk(data: np.ndarray, offsets: np.ndarray, missing: np.ndarray) -> Iterator[np.ndarray]:
    n = len(data)
    byte, space, power, inverse = _tables(n + 1)
    none = np.zeros(0, np.uint64)
    if not n:
        yield from (none for _ in missing)
        return
    blank = space[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = True, blank[:-1]
    after[-1], after[:-1] = True, blank[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner], after[inner - 1] = True, True
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(byte[data] * power[:n], out=sums[1:])
    words = mix((sums[ends + 1] - sums[starts]) * inverse[starts])
    at = np.searchsorted(starts, offsets)
    runs = none
    if len(words) >= WORDS:
        runs = np.zeros(len(words) - WORDS + 1, np.uint64)
        for k in range(WORDS):
            runs = runs * np.uint64(_BASE) + words[k : k + len(runs)]
        runs = mix(runs)
    for i in range(len(missing)):
        many = at[i + 1] - at[i]
        if missing[i] or not many:
            yield none
        elif many < WORDS:
            h = int(many)
            for w in words[at[i] : at[i + 1]]:
                h = (h * _BASE + int(w) + 1) & _MASK
            yield mix(np.array([h], np.uint64))
        else:
            yield np.unique(runs[at[i] : at[i + 1] - WORDS + 1])


def set_key(s: np.ndarray) -> bytes:
    """A key of the whole set, 128 bits."""
    out = b""
    for salt in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
        h = mix(s ^ np.uint64(salt))
        whole = ((int(h.sum(dtype=np.uint64)) ^ (int(np.bitwise_xor.reduce(h)) * _BASE) ^ len(s)) & _MASK) if len(s) else 0
        out += whole.to_bytes(8, "little")
    return out
