"""Approximate nearest neighbours: inverted file of coarse centroids, product-quantised residuals, asymmetric distance
tables and exact reranking, for the largest inner product. In the probed lists the result is exact: the tables set a row
aside only if its score and the most that its quantisation can hide stay below a score that k others have. The nearest
lists of a query are searched first, and the k-th best of them is the bar for all its other lists."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import temporary, written

#: Vectors to fit centroids on, about, and of them those to fit codebooks on.
SAMPLE_VECTORS, CODE_VECTORS = 20_000, 4096
#: The share of true neighbours whose lists are probed, as measured on sampled queries; and how many those are.
AIM, ASKED, NEIGHBOURS = 0.97, 256, 20
PARTS, CODES = 32, 64
ROUNDS = 10
#: Rows of a block whose exact scores give a bar where a query has none, or more rows reach it.
RERANK = 64
#: Rows of a list, and queries, that one task holds at most, about; queries and pairs that it scores at a time.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 16384
ASK, PAIRS = 256, 1 << 16


def valid(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there, not zero, and without null or non-finite components."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.where(v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0))


def kmeans(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's rounds from distinct random points; an empty cell takes the point worst served."""
    points = np.unique(points, axis=0)
    draw = np.random.default_rng(seed)
    centres = points[draw.permutation(len(points))[: min(k, len(points))]].copy()
    for _ in range(rounds):
        gap = (centres**2).sum(1) - 2 * points @ centres.T
        own = gap.argmin(1)
        for c in range(len(centres)):
            mine = own == c
            centres[c] = points[mine].mean(0) if mine.any() else points[(gap.min(1) + (points**2).sum(1)).argmax()]
    return centres


class Index:
    """Coarse centroids and residual codebooks."""

    def __init__(self, coarse: np.ndarray, books: list[np.ndarray]):
        self.coarse, self.books, self.parts = coarse, books, len(books)

    @classmethod
    def fitted(cls, sample: np.ndarray, lists: int, parts: int = PARTS, codes: int = CODES, seed: int = 7) -> Index:
        parts = next(p for p in range(min(parts, sample.shape[1]), 0, -1) if sample.shape[1] % p == 0)
        own = cls(kmeans(sample, lists, ROUNDS, seed), [])
        sample = sample[:: -(-len(sample) // CODE_VECTORS)]
        rest = (sample - own.coarse[own.assign(sample)]).reshape(len(sample), parts, -1)
        return cls(own.coarse, [kmeans(rest[:, m], codes, ROUNDS, seed + 1 + m) for m in range(parts)])

    def near(self, q: np.ndarray) -> np.ndarray:
        """The lists in the order in which a query probes them."""
        return np.argsort(-(q @ self.coarse.T), axis=1, kind="stable")

    def probes(self, sample: np.ndarray, aim: float = AIM) -> int:
        """The fewest probes that reach ``aim`` of the true neighbours of sampled queries within the sample."""
        asked = sample[:: max(1, len(sample) // ASKED)]
        scores = asked @ sample.T
        scores[np.arange(len(asked)), np.arange(0, len(sample), max(1, len(sample) // ASKED))] = -np.inf
        k = min(NEIGHBOURS, len(sample) - 1)
        if k < 1:
            return len(self.coarse)
        best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        place = np.argsort(self.near(asked), axis=1)  # of each list in each query's order
        ranks = np.sort(place[np.arange(len(asked))[:, None], self.assign(sample)[best]].ravel())
        return int(ranks[min(len(ranks) - 1, int(np.ceil(aim * len(ranks))))]) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        return ((self.coarse**2).sum(1) - 2 * x @ self.coarse.T).argmin(1)

    def encode(self, x: np.ndarray, lists: np.ndarray) -> np.ndarray:
        rest = (x - self.coarse[lists]).reshape(len(x), self.parts, -1)
        return np.stack([((b**2).sum(1) - 2 * rest[:, m] @ b.T).argmin(1) for m, b in enumerate(self.books)], 1).astype(np.uint8)

    def errors(self, x: np.ndarray, codes: np.ndarray, centre: np.ndarray) -> np.ndarray:
        """For each row and part the length of what its code leaves of the residual."""
        rest = (x - centre).reshape(len(x), self.parts, -1)
        return np.stack([np.linalg.norm(rest[:, m] - b[codes[:, m]], axis=1) for m, b in enumerate(self.books)], 1)

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """For each part the inner products of the queries with the codebook: the asymmetric distance tables."""
        split = q.reshape(len(q), self.parts, -1)
        return [split[:, m] @ b.T for m, b in enumerate(self.books)]


def lists_for(n: int, sample: int) -> int:
    """Lists grow with the square root of the rows; a sampled fit needs some points for each."""
    return max(1, min(int(n**0.5 / 2) + 1, sample // 16, 1 << 12))


def fit(rows: DataFrame, id_column: str, vector: str, sample: int = SAMPLE_VECTORS) -> tuple[Index, int] | None:
    """An index and its number of probes, fitted on about ``sample`` vectors taken by a hash of the id; None for an empty
    table. The length of its vectors is the most frequent one, of equally frequent ones the longer."""
    sizes = rows.groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    if not sizes:
        return None
    size, n = sizes[0]["size"], sizes[0]["n"]
    share = F.pmod(F.xxhash64(id_column), F.lit(1_000_000)) / 1_000_000
    taken = rows.where((share < min(1.0, sample / n)) & (F.size(vector) == size)).select(id_column, vector).toPandas().sort_values(id_column)
    if not len(taken):
        taken = rows.where(F.size(vector) == size).orderBy(id_column).limit(CODES).select(id_column, vector).toPandas()
    points = np.array(taken[vector].tolist(), np.float64)
    index = Index.fitted(points, lists_for(n, len(points)))
    return index, index.probes(points)


def search(queries: DataFrame, rows: DataFrame, k: int = 20, id_column: str = "vec_id", vector: str = "embedding", probes: int | None = None) -> DataFrame:
    """For each query its k best rows of the probed lists: query_id, rank, vec_id, score; ties go to the smaller id.

    Every row is indexed. A list is cut into blocks of about ``BLOCK_ROWS`` rows by a hash of the id, and a query goes to
    all blocks of its lists, so a list that holds a third of all rows is many tasks; queries are cut into groups of about
    ``BLOCK_QUERIES``. The first lists of each query (the root of their number) are searched first, and the k-th best
    score found there is the query's bar in the others. In a block every row whose table score plus its error bound reaches
    the bar is scored by its exact inner product in double precision; where more than ``RERANK`` rows do, the exact scores
    of the tables' best raise the bar before. The best k of a block leave it.
    Lists grow with the square root of the rows, and as many are probed as sampled queries need (``probes`` overrides).
    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an id, nor
    vectors whose length is not the table's most frequent one, as no inner product with them is defined. A row is no
    candidate of a query with its own id. Where an id repeats, its best score counts, and each of its vectors asks for
    the id's list. Other columns are not read. Empty table: no rows.
    """
    spark = rows.sparkSession
    clean = lambda t: valid(t.where(F.col(id_column).isNotNull()), vector).select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows, queries = clean(rows), clean(queries)
    fitted = fit(rows, "id", "v")
    out = "query_id long, rank int, vec_id long, score double"
    if fitted is None:
        return spark.createDataFrame([], out)
    index, probes = fitted[0], probes or fitted[1]
    dims = index.coarse.shape[1]
    rows, queries = rows.where(F.size("v") == dims), queries.where(F.size("v") == dims)
    sent = spark.sparkContext.broadcast((index.coarse, index.books))  # plain arrays; 4,096 centroids and CODES entries at most
    made: list[Index] = []

    def own() -> Index:
        if not made:
            made.append(Index(*sent.value))
        return made[0]

    matrix = lambda column: np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), dims)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            lists = own().assign(x)
            codes = own().encode(x, lists)
            yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary())], names=["list", "id", "v", "codes"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = own().near(matrix(batch.column(1)))[:, :probes]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32()))], names=["id", "v", "lists"])

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        """The best k of the block for each query that can be among its best of all: distinct ids, each with its best score."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if left.num_rows and right.num_rows:
            index = own()
            order = np.argsort(right["id"].to_numpy(), kind="stable")
            ids = right["id"].to_numpy()[order]
            repeats = np.concatenate([[False], ids[1:] == ids[:-1]])
            x = matrix(right["v"].combine_chunks())[order]
            codes = np.frombuffer(b"".join(right["codes"].to_pylist()), np.uint8).reshape(len(ids), index.parts)[order]
            q_ids, q, bars = left["id"].to_numpy(), matrix(left["v"].combine_chunks()), left["bar"].to_numpy()
            centre = index.coarse[right["list"][0].as_py()]
            hidden = index.errors(x, codes, centre)
            # far more than sums in double precision can be off
            slack = 1e-9 * np.linalg.norm(q, axis=1) * (np.linalg.norm(x, axis=1).max() + np.linalg.norm(centre) + hidden.sum(1).max())
            for start in range(0, len(q), ASK):
                part = slice(start, start + ASK)
                found.append(best_of(index, q_ids[part], q[part], bars[part], slack[part], ids, repeats, x, codes, hidden, centre, k))
        return pa.table({"query_id": pa.array(np.concatenate([a for a, _, _ in found]), pa.int64()), "vec_id": pa.array(np.concatenate([b for _, b, _ in found]), pa.int64()), "score": pa.array(np.concatenate([c for _, _, c in found]), pa.float64())})

    with temporary():
        indexed = written(rows.mapInArrow(assign, "list int, id long, v array<double>, codes binary"), "index")
        sizes = {r["list"]: r.n for r in indexed.groupBy("list").agg(F.count("*").alias("n")).collect()}  # a row a list
        blocks = {i: -(-n // BLOCK_ROWS) for i, n in sizes.items()}
        many = F.create_map(*[F.lit(x) for i, b in blocks.items() for x in (i, b)])
        groups = max(1, -(-queries.count() // BLOCK_QUERIES))
        indexed = indexed.withColumn("block", F.pmod(F.xxhash64("id"), many[F.col("list")].cast("long")).cast("int")).withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        asked = queries.mapInArrow(probe, "id long, v array<double>, lists array<int>").withColumn("lists", F.filter("lists", lambda i: i.isin(list(blocks))))
        first = F.lit(max(1, math.isqrt(probes)))

        def met(asked: DataFrame, lists: Column) -> DataFrame:
            cut = asked.select("id", "v", "bar", F.explode(lists).alias("list")).withColumn("ask", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(groups)).cast("int"))
            cut = cut.withColumn("block", F.explode(F.sequence(F.lit(0), many[F.col("list")] - 1)))
            keys = ["list", "block", "ask"]
            return cut.groupBy(*keys).cogroup(indexed.groupBy(*keys)).applyInArrow(join, "query_id long, vec_id long, score double")

        def top(found: DataFrame) -> DataFrame:
            best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
            return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

        none = F.lit(float("-inf"))
        near = written(top(met(asked.withColumn("bar", none), F.slice("lists", F.lit(1), first))), "near")
        bars = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("bar"))
        barred = asked.join(bars, "id", "left").withColumn("bar", F.coalesce("bar", none))
        far = met(barred, F.slice("lists", first + 1, F.greatest(F.size("lists") - first, F.lit(0))))
        ranked = top(near.drop("rank").unionByName(far)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
        return written(ranked, "neighbours", keep=True)


def best_of(index: Index, q_ids: np.ndarray, q: np.ndarray, bars: np.ndarray, slack: np.ndarray, ids: np.ndarray, repeats: np.ndarray, x: np.ndarray, codes: np.ndarray, hidden: np.ndarray, centre: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For some queries the best k rows of a block (query id, row id, exact score) whose score can reach the query's bar."""
    total = np.repeat((q @ centre)[None, :], len(ids), 0)
    for m, table in enumerate(index.tables(q)):
        total += np.ascontiguousarray(table.T)[codes[:, m]]  # a row for all queries is copied at once
    rough = np.ascontiguousarray(total.T)
    rough[q_ids[:, None] == ids[None, :]] = -np.inf
    most = rough + np.linalg.norm(q.reshape(len(q), index.parts, -1), axis=2) @ hidden.T + slack[:, None]
    bars = bars.copy()
    crowded = np.flatnonzero(((most >= bars[:, None]) & np.isfinite(most)).sum(1) > RERANK)
    if len(crowded) and (~repeats).sum() > k:
        # the k-th exact score of some rows of different ids is a bar too
        lead = np.where(repeats, -np.inf, rough[crowded])
        size = min(max(RERANK, k), len(ids) - 1)
        best = np.argpartition(-lead, size, axis=1)[:, :size]
        exact = np.stack([(x[rows] * vector).sum(1) for rows, vector in zip(best, q[crowded], strict=True)])
        exact[~np.isfinite(np.take_along_axis(lead, best, 1))] = -np.inf
        if size >= k:
            bars[crowded] = np.maximum(bars[crowded], np.partition(exact, size - k, axis=1)[:, size - k] - slack[crowded])
    at, row = np.nonzero((most >= bars[:, None]) & np.isfinite(most))
    score = np.concatenate([np.zeros(0), *[(x[row[i : i + PAIRS]] * q[at[i : i + PAIRS]]).sum(1) for i in range(0, len(at), PAIRS)]])
    reached = score >= bars[at] - slack[at]
    at, score, vec = at[reached], score[reached], ids[row[reached]]
    order = np.lexsort((-score, vec, at))
    at, vec, score = at[order], vec[order], score[order]
    fresh = np.concatenate([[True], (at[1:] != at[:-1]) | (vec[1:] != vec[:-1])]) if len(at) else np.zeros(0, bool)
    at, vec, score = at[fresh], vec[fresh], score[fresh]
    order = np.lexsort((vec, -score, at))
    at, vec, score = at[order], vec[order], score[order]
    counts = np.bincount(at, minlength=len(q))
    keep = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts) < k
    return q_ids[at[keep]], vec[keep], score[keep]


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of each vector whose id is divisible by 20."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(rows.where(F.col("vec_id") % 20 == 0), rows)
