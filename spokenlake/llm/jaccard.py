"""Exact join of word-shingle sets by Jaccard similarity, as a metric-space join.

1. Documents of equal sets are one class. A class can only have a link if 75 % of its shingles occur in another class; a
   count of repeated shingles, never too low, dealt by hash in compact arrays, sets the many classes aside that are at distance
   beyond the radius from all others (in shingle space nearly all pairs are at distance 1, where pivots tell nothing).
   A shingle is told there by its bucket and 32 bits: two that coincide count as repeated, which sets fewer classes aside.
2. What is left falls into closed parts of the space: in the global order rarest first, two linked classes share one of
   their first n - ceil(0.75 n) + 1 shingles, so no link leaves a part.
3. In every part pivots (the classes with the most widely shared shingles) create Voronoi regions. With r = 0.25, a class
   within r of a pivot is linked to it, so its region needs no pairs of its own; by the triangle inequality only a class
   within 2 r of a pivot can have a link into that pivot's region, and only with members whose distance to the pivot
   differs from its own by r at most: just these windows are replicated to the region and tested. The classes in no region
   are a part again, recursively: in one task where a part is small, else as a level of distributed joins. A large part
   that pivots no longer divide by half (no class has many near copies) is cut into bands of set sizes and blocks, and
   only blocks of equal or neighbouring bands meet.
Only links that join components leave a task, fewer than the classes that it read. Nothing is capped, sampled or dropped.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, forget, partitions, release_memory, temporary, written
from .components import connected
from .shingles import set_key, sets_of

#: A link: PERCENT * union <= 100 * intersection. The radius of a region is 1 - PERCENT / 100.
PERCENT = 75
RADIUS = 1 - PERCENT / 100
#: Shingles that one bucket holds, about; classes that a task takes as one part or block; pivots of a level of a large part.
BUCKET_SHINGLES = 1 << 20
BLOCK = 64
PIVOTS = 8
#: A batch of sets ends with this many shingles, or sets.
BATCH_SHINGLES = 1 << 19
BATCH_SETS = 8192
#: A shingle in more documents of a batch is counted there, and only said to be repeated to the others.
BATCH_HOT = 64
NO_CLASS = 0xFFFF
#: Bits of the filter that says which classes are still of interest; a fixed size, exact joins follow it.
FILTER_BITS = 1 << 24


def need(n: int | np.ndarray) -> int | np.ndarray:
    """The least intersection that a set of n shingles has with a linked one."""
    return -(-PERCENT * n // 100)


def linked(common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * common >= PERCENT * (a + b - common)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs, by a product of 0/1 matrices over the shingles that occur twice."""
    out = np.zeros((len(left), len(right)), np.int64)
    if not left or not right:
        return out
    both = [*left, *right] if right is not left else left
    flat = np.concatenate(both)
    _, where, times = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    keep = times[where] > 1
    rows = np.repeat(np.arange(len(both)), [len(s) for s in both])[keep]
    columns = number[where[keep]]
    many, step = int((times > 1).sum()), 1 << 16
    for first in range(0, many, step):
        here = (columns >= first) & (columns < first + step)
        m = np.zeros((len(both), min(step, many - first)), np.float32)
        m[rows[here], columns[here] - first] = 1
        out += (m[: len(left)] @ (m if right is left else m[len(left) :]).T).astype(np.int64)
    return out


def forest(keys: np.ndarray, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Of the linked pairs (index rows) those that a union-find needs."""
    parent = list(range(len(keys)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in pairs.tolist():
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra] = rb
            out.append((int(keys[a]), int(keys[b])))
    return out


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, key: the documents' set sizes and set keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys = [], []
            for s in sets_of(batch.column(1)):
                sizes.append(len(s))
                keys.append(set_key(s))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary())], names=["doc_id", "n_shingles", "key"])
        release_memory()

    return docs.mapInArrow(run, "doc_id long, n_shingles long, key binary")


#: Bytes that tell a shingle from others of its bucket: where chance repetitions only keep more classes, and where they would
#: tie parts of the space together.
COUNTED_BYTES, NAMED_BYTES = 4, 6
#: data: the numbers of sets in the batch with their shingles, as _packed; in the directory the sets' sizes, shingles counted, and keys.
POSTINGS = "bucket int, batch long, directory boolean, data binary"
BACK = "batch long, directory boolean, bucket int, data binary"


def _packed(number: np.ndarray, first: np.ndarray, *columns: tuple[np.ndarray, int]) -> np.ndarray:
    """Byte planes of postings, one column each: set numbers, which ascend from each place in first on, as differences, and the
    lower bytes (array, how many) of what belongs to them. Planes that are nearly all zeros cost next to nothing once compressed."""
    gaps = number.astype("<u2")
    gaps[1:] -= number[:-1].astype("<u2")
    gaps[first] = number[first]
    planes = [gaps.view(np.uint8).reshape(-1, 2)]
    planes += [values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width] for values, width in columns]
    return np.concatenate([p.T for p in planes])


def _unpacked(rows: list[bytes], *widths: int) -> list[np.ndarray]:
    """Lengths of packed rows, and their set numbers and columns one after another."""
    planes = [np.frombuffer(x, np.uint8).reshape(2 + sum(widths), -1) for x in rows]
    lengths = np.array([p.shape[1] for p in planes], np.int64)
    planes = np.concatenate(planes, 1) if planes else np.zeros((2 + sum(widths), 0), np.uint8)
    number = np.cumsum(planes[0] + (planes[1].astype(np.int64) << 8))
    before = np.concatenate([[0], number])[np.cumsum(lengths) - lengths]
    out, at = [lengths, number - np.repeat(before, lengths)], 2
    for width in widths:
        values = np.zeros((planes.shape[1], 8 if width > 4 else 4), np.uint8)
        values[:, :width] = planes[at : at + width].T
        out.append(values.view("<u8" if width > 4 else "<u4")[:, 0])
        at += width
    return out


def _postings(keys: list[bytes], sets: list[np.ndarray], batch: int, buckets: int, hot_limit: int, width: int) -> Iterator[tuple]:
    """Rows of POSTINGS: for each bucket its sets' numbers and the shingles' lower bytes, and one directory of the sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    number = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
    order = np.argsort(flat)
    ordered = flat[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(flat) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(flat)))
    hot = np.empty(len(flat), bool)
    hot[order] = np.repeat(times > hot_limit, times)
    counted = np.bincount(number[hot], minlength=len(sets))
    told = np.repeat(ordered[first[times > hot_limit]], 2)  # twice: whoever has it sees that it is repeated
    flat = np.concatenate([flat[~hot], told])
    number = np.concatenate([number[~hot], np.full(len(told), NO_CLASS, np.uint16)])
    bucket = ((flat >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")  # numbers stay in order inside a bucket
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    filled = np.flatnonzero(np.diff(bounds))
    data = _packed(number[order], bounds[filled], (flat[order], width))
    for b in filled:
        yield int(b), batch, False, data[:, bounds[b] : bounds[b + 1]].tobytes()
    yield batch % buckets, batch, True, np.stack([sizes, counted]).astype("<i8").tobytes() + b"".join(keys)


def _directory(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Sizes, counts and keys of a directory row."""
    n = len(data) // (16 + width)
    sizes, counted = np.frombuffer(data, "<i8", 2 * n).reshape(2, n)
    return sizes, counted, data[16 * n :]


def _frame(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64()}
    names = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names, strict=True)], names=[n for n, _ in names])


def _bucket_of(batches: Iterator[pa.RecordBatch], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int], list[tuple[int, bytes]]]:
    """A task's postings in the order they came, so that those of a batch's set are neighbours: shingles, places of their
    batches, set numbers, repetitions; the batches' ids; and the task's directories."""
    rows, ids, directories = [], [], []
    for batch in batches:
        for _, own, is_directory, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if is_directory:
                directories.append((own, data))
            else:
                rows.append(data)
                ids.append(own)
    lengths, number, flat = _unpacked(rows, width)
    rows.clear()
    source = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
    order = np.argsort(flat)
    ordered = flat[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(flat) else np.zeros(0, np.int64)
    many = np.diff(np.append(first, len(flat)))
    times = np.empty(len(flat), np.int64)
    times[order] = np.repeat(many, many)
    return flat, source, number.astype(np.uint16), times, ids, directories


def _batch_id(number: int) -> int:
    """The same for each attempt of a task."""
    return (TaskContext.get().partitionId() << 24) + number


def _dealt(found: Iterator[tuple[bytes, np.ndarray]], buckets: int, hot_limit: int, width: int) -> Iterator[pa.RecordBatch]:
    """Postings of the classes (key, set) in batches of bounded size; a class that a batch has twice counts once in it."""
    own: dict[bytes, np.ndarray] = {}
    number = held = 0
    for key, s in found:
        if key not in own:
            own[key] = s
            held += len(s)
        if held >= BATCH_SHINGLES or len(own) >= BATCH_SETS:
            yield _frame(list(_postings(list(own), list(own.values()), _batch_id(number), buckets, hot_limit, width)), POSTINGS)
            own, held, number = {}, 0, number + 1
    if own:
        yield _frame(list(_postings(list(own), list(own.values()), _batch_id(number), buckets, hot_limit, width)), POSTINGS)
    own.clear()
    release_memory()


def survivors(docs: DataFrame, shingles: int) -> DataFrame:
    """key: classes of which at least 75 % of the shingles occur in more than one class. What a bucket counts for a batch
    goes back as one packed row."""
    buckets = max(partitions(docs.sparkSession), -(-shingles // BUCKET_SHINGLES))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((set_key(s), s) for batch in batches for s in sets_of(batch.column(1)) if len(s) > 1)
        yield from _dealt(found, buckets, BATCH_HOT, COUNTED_BYTES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, source, number, times, ids, directories = _bucket_of(batches, COUNTED_BYTES)
        here = (times > 1) & (number != NO_CLASS)
        keys, many = np.unique(source[here].astype(np.int64) << 16 | number[here], return_counts=True)
        del source, number, times, here
        bounds = np.searchsorted(keys >> 16, np.arange(len(ids) + 1))
        filled = np.flatnonzero(np.diff(bounds))
        packed = _packed(keys & 0xFFFF, bounds[filled], (many, 4))
        for k in filled:
            yield _frame([(ids[k], False, 0, packed[:, bounds[k] : bounds[k + 1]].tobytes())], BACK)
        for batch, data in directories:
            yield _frame([(batch, True, 0, data)], BACK)
        release_memory()

    def keep(table: pa.Table) -> pa.Table:
        parts, held = [], None
        for is_directory, data in zip(table["directory"].to_pylist(), table["data"].to_pylist(), strict=True):
            if is_directory:
                held = _directory(data, 16)
            else:
                parts.append(data)
        sizes, counted, keys = held
        _, number, many = _unpacked(parts, 4)
        total = counted + np.bincount(number, many, len(sizes)).astype(np.int64)
        left = np.flatnonzero(100 * total >= PERCENT * sizes)
        return pa.table({"key": pa.array([keys[16 * i : 16 * i + 16] for i in left], pa.binary())})

    counted = docs.mapInArrow(deal, POSTINGS).repartitionById(buckets, F.col("bucket")).mapInArrow(count, BACK)
    return counted.groupBy("batch").applyInArrow(keep, "key binary").distinct()


def sets_table(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """class, size, data: the sorted shingles of each class (classes: key, class, least: its smallest doc_id). Texts are hashed
    again; a filter of fixed size over key and doc_id lets the rows of each class's least doc_id pass, and then a join keeps
    the classes wanted, so no text is shuffled, and of many copies about one set."""
    place = F.conv(F.concat(*[F.substr(F.hex("key"), F.lit(2 * i + 1), F.lit(2)) for i in (2, 1, 0)]), 16, 10).cast("long")
    place = place.bitwiseXOR(F.coalesce("least", F.lit(0)).bitwiseAND(F.lit(FILTER_BITS - 1)))
    bits = classes.groupBy(F.floor(place / 32768).cast("int").alias("part")).agg(F.bitmap_construct_agg(F.pmod(place, F.lit(32768))).alias("bits")).collect()
    wanted = np.zeros(FILTER_BITS, bool)
    for r in bits:
        wanted[r.part * 32768 : (r.part + 1) * 32768] = np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little")
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = sent.value
        seen: set[bytes] = set()
        for batch in batches:
            rows = []
            for own, s in zip(batch.column(0).to_pylist(), sets_of(batch.column(1)), strict=True):
                if len(s) > 1:
                    key = set_key(s)
                    at = int.from_bytes(key[:3], "little") ^ ((own or 0) & (FILTER_BITS - 1))
                    if packed[at >> 3] >> (7 - (at & 7)) & 1 and key not in seen:
                        seen.add(key)
                        rows.append((key, len(s), s.astype("<u8").tobytes()))
            yield _frame(rows, "key binary, size long, data binary")
        release_memory()

    found = docs.mapInArrow(run, "key binary, size long, data binary").join(classes.select("key", "class"), "key")
    # by key as well: the rows lie by it already
    return found.groupBy("key", "class").agg(F.first("size").alias("size"), F.first("data").alias("data")).drop("key")


def anchors(sets: DataFrame, shingles: int) -> DataFrame:
    """shingle, class, weight: each class at its anchors, the repeated shingles among its first in the order rarest first.
    weight: mean number of classes that share its shingles, high for what lies at the middle of many copies."""
    buckets = max(partitions(sets.sparkSession), -(-shingles // BUCKET_SHINGLES))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((key.as_py().to_bytes(8, "little"), np.frombuffer(data.as_buffer(), "<u8").astype(np.uint64)) for batch in batches for key, data in zip(batch.column(0), batch.column(2), strict=True))
        yield from _dealt(found, buckets, 1 << 62, NAMED_BYTES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, source, number, times, ids, directories = _bucket_of(batches, NAMED_BYTES)
        own = TaskContext.get().partitionId()
        here = np.flatnonzero(times > 1)
        bounds = np.searchsorted(source[here], np.arange(len(ids) + 1))
        filled = np.flatnonzero(np.diff(bounds))
        packed = _packed(number[here], bounds[filled], (shingle[here], NAMED_BYTES), (times[here], 4))
        for k in filled:
            yield _frame([(ids[k], False, own, packed[:, bounds[k] : bounds[k + 1]].tobytes())], BACK)
        for batch, data in directories:
            yield _frame([(batch, True, -1, data)], BACK)
        release_memory()

    def pick(key: tuple, table: pa.Table) -> pa.Table:
        parts, held, buckets_ = [], None, []
        for is_directory, bucket, data in zip(table["directory"].to_pylist(), table["bucket"].to_pylist(), table["data"].to_pylist(), strict=True):
            if is_directory:
                held = _directory(data, 8)
            else:
                parts.append(data)
                buckets_.append(bucket)
        empty = pa.table({"shingle": pa.array([], pa.int64()), "class": pa.array([], pa.int64()), "weight": pa.array([], pa.float64())})
        if held is None or not parts:
            return empty
        sizes, _, keys = held
        classes = np.frombuffer(keys, "<i8")
        lengths, number, shingle, times = _unpacked(parts, NAMED_BYTES, 4)
        # 48 bits of the shingle and its bucket: one number for the global order, the same in all batches
        token = shingle.astype(np.int64) ^ (np.repeat(np.array(buckets_, np.int64), lengths) << np.int64(48))
        order = np.lexsort((token, times, number))
        number, token, times = number[order], token[order], times[order]
        many = np.bincount(number, minlength=len(classes))
        weight = (np.bincount(number, times, len(classes)) + sizes - many) / np.maximum(1, sizes)
        rank = np.arange(len(number)) - np.repeat(np.cumsum(many) - many, many)
        prefix = sizes - need(sizes) + 1 - (sizes - many)  # shingles of no other class come first
        here = rank < prefix[number]
        return pa.table({"shingle": pa.array(token[here]), "class": pa.array(classes[number[here]]), "weight": pa.array(weight[number[here]])})

    counted = sets.select("class", "size", "data").mapInArrow(deal, POSTINGS).repartitionById(buckets, F.col("bucket")).mapInArrow(count, BACK)
    return counted.groupBy("batch").applyInArrow(pick, "shingle long, class long, weight double")


EDGES = "a long, b long"


def _sets(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    return table["class"].to_numpy(), table["size"].to_numpy(), [np.frombuffer(x, "<u8") for x in table["data"].to_pylist()]


def _edges(pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([x for x, _ in pairs], pa.int64()), "b": pa.array([y for _, y in pairs], pa.int64())})


def across(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], gaps: np.ndarray | None = None) -> np.ndarray:
    """Linked pairs between two lists of classes. gaps: their distances to one pivot; only pairs whose gaps differ by the
    radius at most can be linked, so whoever lies outside all windows of the other side is left out before any test."""
    if gaps is not None and len(left) and len(right):
        reach = RADIUS + 1e-9
        left = left[(gaps[left] >= gaps[right].min() - reach) & (gaps[left] <= gaps[right].max() + reach)]
        right = right[(gaps[right] >= gaps[left].min() - reach) & (gaps[right] <= gaps[left].max() + reach)] if len(left) else right[:0]
    common = overlaps([sets[i] for i in left], [sets[i] for i in right])
    a, b = np.nonzero(linked(common, sizes[left][:, None], sizes[right][None, :])) if common.size else (np.zeros(0, int), np.zeros(0, int))
    return np.stack([left[a], right[b]], 1)


def join_part(keys: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], weights: np.ndarray) -> tuple[list[tuple[int, int]], int, int]:
    """Links of a part that one task holds, by pivots: the heaviest class is the pivot, those within the radius are its
    region, those within twice the radius visit it, and all beyond the radius are the next part. Returns the links that a
    union-find needs, the number of pivots, and the number of pairs tested beside those with pivots."""
    left = np.lexsort((keys, -weights))
    pairs, pivots, tests = [np.zeros((0, 2), np.int64)], 0, 0
    while len(left) > 1:
        pivot, others = left[:1], left[1:]
        pivots += 1
        common = overlaps([sets[i] for i in others], [sets[pivot[0]]])[:, 0]
        union = sizes[others] + sizes[pivot[0]] - common
        inside = linked(common, sizes[others], sizes[pivot[0]])
        near = ~inside & (2 * common >= union)
        gaps = np.ones(len(keys))
        gaps[others] = 1 - common / np.maximum(1, union)
        pairs.append(np.stack([others[inside], np.repeat(pivot, inside.sum())], 1))
        tests += int(inside.sum() * near.sum())
        pairs.append(across(others[inside], others[near], sizes, sets, gaps))
        left = others[~inside]
    return forest(keys, np.concatenate(pairs)), pivots, tests


def join_region(table: pa.Table) -> pa.Table:
    keys, sizes, sets = _sets(table)
    return _edges(join_part(keys, sizes, sets, table["weight"].to_numpy())[0])


def join_block(table: pa.Table) -> pa.Table:
    """Links across two blocks (side 0 and 1), or inside one block whose rows are all of side 0."""
    keys, sizes, sets = _sets(table)
    side = table["side"].to_numpy()
    first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if len(second):
        gaps = table["gap"].to_numpy()
        return _edges(forest(keys, across(first, second, sizes, sets, None if np.isnan(gaps).any() else gaps)))
    pairs = across(first, first, sizes, sets)
    return _edges(forest(keys, pairs[pairs[:, 0] < pairs[:, 1]]))


def _blocks(size: str) -> Column:
    return F.ceil(F.col(size) / BLOCK).cast("int")


def _block(size: str) -> Column:
    return F.pmod(F.xxhash64("class", F.lit(11)), _blocks(size)).cast("int")


def _bands(members: DataFrame) -> DataFrame:
    """Links of large parts without regions. members: region, class, size, data. Linked sets differ in size by a factor of
    4/3 at most, so they lie in the same or in neighbouring bands of a logarithmic scale; a band is cut into blocks, and
    the blocks of a band meet each other and those of the next."""
    cut = members.select("region", "class", "size", "data").withColumn("band", F.floor(F.log(F.col("size").cast("double")) / math.log(100 / PERCENT) + 1e-9).cast("int"))
    counts = written(cut.groupBy("region", "band").agg(F.count("*").alias("many")), "bands")
    after = counts.select("region", (F.col("band") - 1).alias("band"), F.col("many").alias("next_many"))
    before = counts.select("region", (F.col("band") + 1).alias("band"), F.col("many").alias("last_many"))
    counts = written(counts.join(after, ["region", "band"], "left").join(before, ["region", "band"], "left"), "bands")
    cut = cut.join(counts, ["region", "band"]).withColumn("block", _block("many"))
    kept = ["class", "size", "data", F.lit(float("nan")).alias("gap")]
    inner = cut.withColumn("other", F.explode(F.sequence(F.lit(0), _blocks("many") - 1)))
    inner = inner.select("region", F.col("band").alias("low_band"), F.col("band").alias("high_band"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), (F.col("block") > F.col("other")).cast("int").alias("side"), *kept)
    up = cut.where("next_many is not null").withColumn("other", F.explode(F.sequence(F.lit(0), _blocks("next_many") - 1)))
    up = up.select("region", F.col("band").alias("low_band"), (F.col("band") + 1).alias("high_band"), F.col("block").alias("low"), F.col("other").alias("high"), F.lit(0).alias("side"), *kept)
    down = cut.where("last_many is not null").withColumn("other", F.explode(F.sequence(F.lit(0), _blocks("last_many") - 1)))
    down = down.select("region", (F.col("band") - 1).alias("low_band"), F.col("band").alias("high_band"), F.col("other").alias("low"), F.col("block").alias("high"), F.lit(1).alias("side"), *kept)
    return inner.unionByName(up).unionByName(down).groupBy("region", "low_band", "high_band", "low", "high").applyInArrow(join_block, EDGES)


def _level(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One level of pivots. members: region, many, class, size, weight, data. Returns links, and the classes in no region."""
    salt = F.pmod(F.xxhash64("class", F.lit(5)), F.lit(PIVOTS)).cast("int")
    best = members.groupBy("region", "many", salt.alias("salt")).agg(F.max(F.struct("weight", "class")).alias("best"))
    pivots = best.select("region", F.col("many").alias("region_many"), "salt", F.col("best.class").alias("class")).join(members.select("class", "size", "data"), "class")
    pivots = pivots.select("region", F.explode(F.sequence(F.lit(0), F.ceil(F.col("region_many") / BLOCK).cast("int") - 1)).alias("block"), "salt", "class", "size", "data")
    asked = members.select("region", _block("many").alias("block"), F.lit(-1).alias("salt"), "class", "size", "data").unionByName(pivots)
    # cells: (pivot's number, whether the class is at home there, distance); a class without a home has a row with cell -1
    out = "region long, class long, cell int, home boolean, pivot long, gap double"

    def measure(table: pa.Table) -> pa.Table:
        keys, sizes, sets = _sets(table)
        salts = table["salt"].to_numpy()
        own, centres = np.flatnonzero(salts < 0), np.flatnonzero(salts >= 0)
        centres = centres[np.argsort(salts[centres], kind="stable")]
        region = table["region"][0].as_py()
        common = overlaps([sets[i] for i in own], [sets[i] for i in centres])
        union = sizes[own][:, None] + sizes[centres][None, :] - common
        inside, near = linked(common, sizes[own][:, None], sizes[centres][None, :]), 2 * common >= union
        likeness = common / np.maximum(1, union)
        rows = []
        for i, row in enumerate(own):
            home = int(np.where(inside[i], likeness[i], -1.0).argmax()) if inside[i].any() else -1
            rows.append((region, int(keys[row]), int(salts[centres[home]]) if home >= 0 else -1, True, int(keys[centres[home]]) if home >= 0 else None, 1 - likeness[i, home] if home >= 0 else None))
            # of two regions the earlier one's classes visit the later one; those without a home visit all that they can reach
            rows += [(region, int(keys[row]), int(salts[centres[c]]), False, None, 1 - likeness[i, c]) for c in np.flatnonzero(near[i]) if home < c]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("region", "class", "cell", "home", "pivot", "gap"), zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)})

    cells = written(asked.groupBy("region", "block").applyInArrow(measure, out), "cells")
    stars = cells.where("home and cell >= 0 and class <> pivot").select(F.col("class").alias("a"), F.col("pivot").alias("b"))
    reach = RADIUS + 1e-9
    counts = cells.where("cell >= 0").groupBy("region", "cell").agg(
        F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("visits"), F.min(F.when(~F.col("home"), F.col("gap"))).alias("nearest"), F.max(F.when(F.col("home"), F.col("gap"))).alias("farthest")
    )
    # the window: a home too near to its pivot for the nearest visitor, or a visitor too far for the farthest home, has no link
    met = cells.where("cell >= 0").join(counts.where("homes > 0 and visits > 0"), ["region", "cell"])
    met = met.where(F.when(F.col("home"), F.col("gap") >= F.col("nearest") - reach).otherwise(F.col("gap") <= F.col("farthest") + reach))
    met = met.withColumn("block", F.when(F.col("home"), _block("homes")).otherwise(_block("visits")))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("home"), _blocks("visits")).otherwise(_blocks("homes")) - 1)))
    met = met.select("region", "cell", F.when(F.col("home"), F.col("block")).otherwise(F.col("other")).alias("low"), F.when(F.col("home"), F.col("other")).otherwise(F.col("block")).alias("high"), F.when(F.col("home"), 0).otherwise(1).alias("side"), "gap", "class")
    met = met.join(members.select("class", "size", "data"), "class")
    # a group with visitors only would take them for one block
    meet = lambda table: join_block(table) if 0 in table["side"].to_pylist() and 1 in table["side"].to_pylist() else _edges([])
    return stars.unionByName(met.groupBy("region", "cell", "low", "high").applyInArrow(meet, EDGES)), cells.where("cell < 0").select("region", "class")


def links(docs: DataFrame, least: DataFrame, shingles: int) -> tuple[DataFrame, DataFrame]:
    """(a, b: links between classes whose connected components are those of all links; key, class: the classes).
    least: key, least: the smallest doc_id of each set."""
    classes = written(survivors(docs, shingles).join(least, "key").withColumn("class", F.monotonically_increasing_id()), "classes")
    sets = written(sets_table(docs, classes), "sets")
    held = sets.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    at = written(anchors(sets, held), "anchors")
    centre = written(at.groupBy("shingle").agg(F.max(F.struct("weight", "class")).alias("best"), F.count("*").alias("n")).where("n > 1").select("shingle", F.col("best.class").alias("b")), "centres")
    stars = at.join(centre, "shingle").where("class <> b").select(F.col("class").alias("a"), "b")
    region = written(connected(stars).select(F.col("node").alias("class"), F.col("label").alias("region")), "regions")
    weights = at.groupBy("class").agg(F.max("weight").alias("weight"))
    sized = written(region.groupBy("region").agg(F.count("*").alias("many")), "sizes")
    placed = written(region.join(weights, "class").join(sized, "region"), "placed")
    # joined once, as small and large parts each would move all sets again; nothing reads those apart after it
    members = written(placed.join(sets, "class"), "members")
    forget(sets)
    # each kind of links is written by a job of its own: one plan of them all is planned anew after each of its many
    # exchanges, on the driver, whose memory that takes
    found = [written(members.where(F.col("many") <= BLOCK).groupBy("region").applyInArrow(join_region, EDGES), "links")]
    while sized.where(F.col("many") > BLOCK).limit(1).count():
        big = written(members.where(F.col("many") > BLOCK), "members")
        more, rest = _level(big)
        found.append(written(more, "links"))
        region = written(rest, "rest")
        left = written(region.groupBy("region").agg(F.count("*").alias("left")).join(sized, "region"), "left")
        sized = left.where("left * 2 <= many").select("region", F.col("left").alias("many"))  # pivots go on where they divide
        rows = region.join(big.drop("region", "many"), "class")
        if left.where("left * 2 > many").limit(1).count():
            found.append(written(_bands(rows.join(left.where("left * 2 > many").select("region"), "region")), "links"))
        members = rows.join(sized, "region")
        found.append(written(members.where(F.col("many") <= BLOCK).groupBy("region").applyInArrow(join_region, EDGES), "links"))
    found = functools.reduce(DataFrame.unionByName, found)
    return found, classes


def link_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable over links, itself included.

    Texts without words (null, empty, blank) have no shingles and are linked with nothing. Rows of equal sets are linked;
    rows that repeat come out as often; other columns are not read, whatever their names. A null doc_id takes part in
    links, and names no component unless it is alone. Sets are told apart by 128 bits, shingles of a pair by 64. Empty
    table: no rows.
    """
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    told = written(describe(rows), "described")
    total = told.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    named = told.where("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("component_id"))
    if total:
        with temporary():
            found, classes = links(rows, named.withColumnRenamed("component_id", "least"), total)
            labels = connected(found)
            label = classes.join(labels.withColumnRenamed("node", "class"), "class").select("key", "label")
            label = written(named.join(label, "key"), "labels", keep=True)
        linked_ = label.join(label.groupBy("label").agg(F.min("component_id").alias("least")), "label").select("key", "least")
        named = named.join(linked_, "key", "left").select("key", F.coalesce("least", "component_id").alias("component_id"))
    out = told.where("n_shingles > 0").join(named, "key").select("doc_id", "n_shingles", "component_id")
    return out.unionByName(told.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document of the table with the size of its shingle set and the smallest doc_id that it is linked to."""
    return link_documents(documents(spark, sf_dir))
