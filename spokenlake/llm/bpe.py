"""Byte-level BPE encoding and decoding in linear time.

Tokens are byte strings mapped to Latin-1 text. An Aho-Corasick automaton over all tokens finds, for every position of a
piece, the longest token that starts there. The encoder walks from the left, takes the longest match, and goes back to
shorter prefixes when the new token and the one before it are not what the merges would leave side by side; that test
depends on the two tokens only and is memoised. A position that has no way on is marked, so each is left at most once.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import documents, process_cache, release_memory

#: Pieces, and units, kept with their ids in one worker, and the longest of them; beyond that many the memo starts anew, and
#: longer ones are encoded each time. Both cost time only and bound the memory: the ids are the same.
MEMO_PIECES, MEMO_LENGTH = 300_000, 32
MEMO_PAIRS = 500_000
#: Tokens of the documents that a worker holds before it hands them on, about.
BATCH_TOKENS = 1 << 17


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a file of ``base64 rank`` lines."""
    found: dict[int, bytes] = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                found[int(rank)] = base64.b64decode(token)
    return [found.get(i, b"") for i in range(max(found) + 1)]


class Encoder:
    """Encodes pieces (pre-split texts) by the ranks of ``tokens``."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.text = [t.decode("latin-1") for t in tokens]
        self.rank = {t: i for i, t in enumerate(self.text) if t}
        self.size = [len(t) for t in tokens]
        self.split: list[tuple[int, int]] = [(i, i) for i in range(len(tokens))]
        self.pair: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        self.prefix: list[int | None] = [None] * len(tokens)
        reachable = set()
        for i, t in enumerate(self.text):
            if not t:
                continue
            if len(t) > 1:
                parts = self._merge(t, i)
                if len(parts) != 2:
                    continue  # the merges never make it: it stands only for a whole piece
                self.split[i] = (parts[0], parts[1])
                self.pair[parts[0], parts[1]] = i
            reachable.add(t)
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        for i, t in enumerate(self.text):
            self.prefix[i] = next((self.rank[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in reachable), None)
        self.memo: dict[str, tuple[int, ...]] = {}
        self.units: dict[str, tuple[int, ...]] = {}
        self.good: dict[tuple[int, int], bool] = {}
        # White space as the pattern's own regular expression library knows it, without U+001C to U+001F.
        self.crossed = re.compile(r"\s ").search
        self.pieces = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall

    def _merge(self, t: str, limit: int) -> list[int]:
        """Plain merges of lowest rank first, by ranks below ``limit``."""
        parts = list(t)
        while len(parts) > 2:
            best, at = limit, -1
            for k in range(len(parts) - 1):
                r = self.rank.get(parts[k] + parts[k + 1], limit)
                if r < best:
                    best, at = r, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def adjacent(self, a: int, b: int) -> bool:
        """Whether the merges can leave tokens a and b side by side: undo them from the later merge to the earlier one and
        look for a merge across the border that would have come first."""
        split, pair, limit = self.split, self.pair, len(self.tokens) + 1
        while True:
            if pair.get((a, b), limit) < limit:
                return False
            if a > b:
                limit, a = a, split[a][1]
                if a == limit:
                    limit, b = b + 1, split[b][0]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, split[b][0]
                if b + 1 == limit:
                    limit, a = a, split[a][1]
                    if a == limit:
                        return True

    def piece(self, t: str) -> tuple[int, ...]:
        """Ids of one piece, given as Latin-1 text of its UTF-8 bytes."""
        whole = self.rank.get(t)
        if whole is not None:
            return (whole,)
        n, size, prefix, good = len(t), self.size, self.prefix, self.good
        longest: list[int | None] = [None] * (n + 1)
        for end, i in self.automaton.iter(t):
            at = end - size[i] + 1
            if longest[at] is None or size[longest[at]] < size[i]:
                longest[at] = i
        out: list[int] = []
        open_ = bytearray(b"\x01") * (n + 1)
        at, token = 0, longest[0]
        while token is not None:
            last = out[-1] if out else None
            while True:
                end = at + size[token]
                if open_[end]:
                    if last is None:
                        fits = True
                    else:
                        fits = good.get((last, token))
                        if fits is None:
                            if len(good) > MEMO_PAIRS:
                                good.clear()
                            fits = good[last, token] = self.adjacent(last, token)
                    if fits:
                        out.append(token)
                        at, token = end, longest[end]
                        break
                shorter = prefix[token]
                if shorter is None:
                    open_[at] = 0
                    out.pop()
                    at -= size[last]
                    token = last
                    break
                token = shorter
        return tuple(out)

    def unit(self, text: str) -> tuple[int, ...]:
        """Ids of a text, piece by piece."""
        memo, out = self.memo, []
        for p in self.pieces(text):
            ids = memo.get(p)
            if ids is None:
                ids = self.piece(p.encode().decode("latin-1"))
                if len(p) <= MEMO_LENGTH:
                    if len(memo) >= MEMO_PIECES:
                        memo.clear()
                    memo[p] = ids
            out += ids
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """Ids of a text, without special tokens.

        No piece of the pattern crosses the start of a run of white space, so where every blank starts such a run the
        text falls into independent units, one for each blank, and units are memoised.
        """
        if self.crossed(text):
            return list(self.unit(text))
        units, memo = text.split(" "), self.units
        out = list(self.unit(units[0]))
        for u in units[1:]:
            ids = memo.get(u)
            if ids is None:
                ids = self.unit(" " + u)
                if len(u) <= MEMO_LENGTH:
                    if len(memo) >= MEMO_PIECES:
                        memo.clear()
                    memo[u] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def worker_encoder(tokens: list[bytes], pattern: str) -> Encoder:
    """The worker's encoder; built once in a process for the same vocabulary."""
    key = hashlib.sha256(b"\0".join(tokens) + pattern.encode()).hexdigest()
    kept = process_cache("bpe")
    if kept.get("bpe_key") != key:
        kept["bpe_key"], kept["bpe"] = key, Encoder(tokens, pattern)
    return kept["bpe"]


OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", ids: bool = False) -> DataFrame:
    """One row per document: number of tokens, digests of ids and of the decoded bytes, and with ``ids`` the ids too.

    Null text counts as empty: no ids, digests of the empty string. Rows that repeat give a row each; other columns are
    not read. The vocabulary (fixed size, read on the driver) is broadcast; a text is encoded whole, one at a time.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_encoder(sent.value, pattern)
        names = [str(i) for i in range(len(own.tokens))]
        fields = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids
        for batch in batches:
            made: list[list] = [[], [], [], []]
            start = held = 0
            for at, text in enumerate(batch.column(1), 1):
                got = own.encode(text.as_py() or "")
                made[0].append(len(got))
                made[1].append(hashlib.sha256(",".join(map(names.__getitem__, got)).encode()).hexdigest())
                made[2].append(hashlib.sha256(own.decode(got)).hexdigest())
                if ids:
                    made[3].append(np.array(got, np.int32))
                held += len(got)
                if held >= BATCH_TOKENS or at == batch.num_rows:
                    columns = [batch.column(0).slice(start, at - start), pa.array(made[0], pa.int64()), pa.array(made[1], pa.string()), pa.array(made[2], pa.string())]
                    columns += [pa.array(made[3], pa.list_(pa.int32()))] * ids
                    yield pa.RecordBatch.from_arrays(columns, names=fields)
                    made, start, held = [[], [], [], []], at, 0
        release_memory()

    return docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text")).mapInArrow(run, OUT + ", ids array<int>" * ids)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir), *default_vocabulary())
