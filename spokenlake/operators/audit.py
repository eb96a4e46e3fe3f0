"""Audit of edited transcripts: only small deletions of unprotected characters are allowed."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame

# A line that is a code fence, the marks of a heading, and the share of content that may go.
FENCE, HEADING = re.compile(r"\s*```[A-Za-z0-9_-]*\s*"), re.compile(r"^\s{0,3}#{1,6}\s+")
MOST_DELETED = 0.05
OUT = "doc_id long, idx int, verdict string, deleted long, source long, deletions array<struct<start: int, stop: int, text: string>>"


def content(text: str) -> str:
    return "".join(c for c in text if not c.isspace() and not unicodedata.category(c).startswith("P"))


def plain(text: str) -> str:
    return "\n".join(HEADING.sub("", line, count=1) for line in text.splitlines() if not FENCE.fullmatch(line)).strip()


def verdict(original: str, formatted: str) -> tuple[str, int, int]:
    """(verdict, characters deleted, characters of content); fences and heading marks of the edited text do not count."""
    a, b = content(original), content(plain(formatted))
    size, gone = len(a), 0
    if a == b:
        return "valid", 0, size
    for op, i, j, _, _ in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if op in ("insert", "replace"):
            return "rewrite", gone, size
        if op == "delete":
            if any(c.isdigit() or c.isascii() and c.isalpha() for c in a[i:j]):
                return "protected", gone, size
            gone += j - i
    return ("valid" if gone <= MOST_DELETED * size else "too_much"), gone, size


def deletions(original: str, formatted: str) -> list[dict]:
    """What a valid edit took out: from the first to the last content character of each deletion, in the original text,
    so that punctuation between them belongs to it."""
    places = [i for i, c in enumerate(original) if content(c)]
    codes = SequenceMatcher(None, content(original), content(plain(formatted)), autojunk=False).get_opcodes()
    spans = [(places[i], places[j - 1] + 1) for op, i, j, _, _ in codes if op == "delete"]
    return [{"start": a, "stop": b, "text": original[a:b]} for a, b in spans]


def audit(pairs: DataFrame) -> DataFrame:
    """pairs: doc_id, idx, original, formatted -> the verdict on each, and the deletions of those that are valid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("text", pa.string())]))
        for batch in batches:
            texts = [(a or "", b or "") for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            found = [verdict(a, b) for a, b in texts]
            gone = [deletions(a, b) if f[0] == "valid" and f[1] else [] for f, (a, b) in zip(found, texts, strict=True)]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64()), pa.array(gone, span)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc_id", "idx", "verdict", "deleted", "source", "deletions"])

    return pairs.select("doc_id", "idx", "original", "formatted").mapInArrow(run, OUT)
