"""K-d tree partitioning: nodes are split at distributed weighted medians along their widest metadata dimension.

The points are documents; their dimensions are metadata of the text alone (size, code points by byte, shares of blanks,
line ends, full stops and commas), so equal texts are one point and never part. A text whose copies exceed a shard's
bytes gets a shard of its own first. A node that is to hold s shards is cut at about half its bytes, and each side gets
shards by its weight.
The cut is found with histograms: each pass sums the bytes of all open nodes by bins of their current interval and goes
on inside the bin that holds the cut. Only bins, at most ``BINS`` for each of the at most s nodes, reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, running_total, written

SHARDS = 16
BINS = 512
#: A cut may miss its place by this share of the node's bytes before another pass refines it.
TOLERANCE = 0.002
#: Dimensions are scaled to this many steps; ties are broken by the text's hash, which is part of the key.
STEPS, TIES = 1 << 24, 1 << 37


#: Dimensions that are shares of code points, and which ones they count.
COUNTED = {"d_blanks": " ", "d_lines": "\n", "d_stops": ".", "d_commas": ","}


@dataclass
class Node:
    shards: int
    where: list[tuple[str, int, int]] = field(default_factory=list)  # dimension, least key, first key beyond
    dim: str = ""
    low: int = 0
    high: int = 0
    before: int = 0
    weight: int = 0
    cut: int | None = None
    left: int = 0


def points(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1; null text: 1), checksum, hash, and the dimensions as 61-bit keys."""
    text = F.coalesce(docs[text_column], F.lit(""))
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("hash"), F.length(text).alias("chars"), *[(F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign)))).alias(d) for d, sign in COUNTED.items()])
    scaled = {
        "d_size": F.least(F.lit(1.0), F.log2("size") / 40),
        "d_chars": F.col("chars") / F.col("size"),
        **{d: F.col(d) / F.greatest(F.col("chars"), F.lit(1)) for d in COUNTED},
    }
    tie = F.pmod("hash", F.lit(TIES))
    key = lambda c: F.least(F.floor(c * STEPS), F.lit(STEPS - 1)).cast("long") * TIES + tie
    return rows.select("doc_id", "size", "text_crc32", "hash", *[key(c).alias(d) for d, c in scaled.items()])


DIMENSIONS = ("d_size", "d_chars", *COUNTED)


def _inside(node: Node) -> Column:
    found = F.lit(True)
    for dim, low, high in node.where:
        found &= (F.col(dim) >= low) & (F.col(dim) < high)
    return found


def _number(nodes: list[Node]) -> Column:
    """The node that a point lies in, as a chain of at most one test for each node."""
    found = F.lit(-1)
    for i, node in enumerate(nodes):
        found = F.when(_inside(node), F.lit(i)).otherwise(found)
    return found


def _cut(rows: DataFrame, nodes: list[Node]) -> None:
    """Sets the cut of each node that is to be split."""
    ranges = rows.withColumn("n", _number(nodes)).where("n >= 0").groupBy("n").agg(F.sum("size").alias("w"), *[f(d).alias(f"{d}_{name}") for d in DIMENSIONS for name, f in (("min", F.min), ("max", F.max))]).collect()
    for r in ranges:
        node = nodes[r.n]
        node.weight = r.w
        if node.shards > 1:
            node.dim = max(DIMENSIONS, key=lambda d: r[f"{d}_max"] // TIES - r[f"{d}_min"] // TIES)
            node.low, node.high, node.before = r[f"{node.dim}_min"], r[f"{node.dim}_max"] + 1, 0
    open_ = [n for n in nodes if n.shards > 1 and n.weight]
    while open_:
        bins = F.lit(None).cast("int")
        number = F.lit(-1)
        for i, n in enumerate(open_):
            step = max(1, -(-(n.high - n.low) // BINS))
            here = _inside(n) & (F.col(n.dim) >= n.low) & (F.col(n.dim) < n.high)
            number = F.when(here, F.lit(i)).otherwise(number)
            bins = F.when(here, F.expr(f"cast(({n.dim} - {n.low}L) div {step}L as int)")).otherwise(bins)
        sums = rows.select(number.alias("n"), bins.alias("b"), "size").where("n >= 0").groupBy("n", "b").agg(F.sum("size").alias("w")).collect()
        by: dict[int, dict[int, int]] = {}
        for r in sums:
            by.setdefault(r.n, {})[r.b] = r.w
        left = []
        for i, n in enumerate(open_):
            goal = n.weight * (n.shards // 2) / n.shards  # about half
            step = max(1, -(-(n.high - n.low) // BINS))
            at = n.before
            for b, w in sorted(by.get(i, {}).items()):
                low, high = n.low + b * step, min(n.high, n.low + (b + 1) * step)
                if at + w >= goal:
                    if min(goal - at, at + w - goal) <= TOLERANCE * n.weight or step == 1:
                        n.cut, n.left = (low, at) if goal - at <= at + w - goal and at else (high, at + w)
                    else:
                        n.low, n.high, n.before = low, high, at
                        left.append(n)
                    break
                at += w
        open_ = left


def tree(rows: DataFrame, shards: int = SHARDS) -> list[Node]:
    """The leaves, in order; each holds one shard. A node without points, or of a single point, gives empty shards."""
    nodes = [Node(shards)]
    while any(n.shards > 1 for n in nodes):
        _cut(rows, nodes)
        grown = []
        for n in nodes:
            if n.shards == 1:
                grown.append(Node(1, n.where))
                continue
            cut = n.cut if n.cut is not None else 0
            dim = n.dim or DIMENSIONS[0]
            first = max(1, min(n.shards - 1, round(n.shards * n.left / n.weight))) if n.weight else n.shards // 2
            grown += [Node(first, [*n.where, (dim, -(1 << 62), cut)]), Node(n.shards - first, [*n.where, (dim, cut, 1 << 62)])]
        nodes = grown
    return nodes


def heavy(rows: DataFrame, shards: int) -> list[int]:
    """Hashes of the texts whose copies exceed a shard's bytes, heaviest first; fewer than shards."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    weights = rows.groupBy("hash").agg(F.sum("size").alias("w")).where(F.col("w") * shards > total).orderBy(F.desc("w"), "hash").limit(shards - 1).collect() if shards > 1 else []
    found: list[int] = []
    for r in weights:  # what is left is for the shards that are left
        if r.w * (shards - len(found)) <= total:
            break
        found.append(r.hash)
        total -= r.w
    return found


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Law ``bytes``: shards of near equal size, equal texts together.

    Returns doc_id, size, text_crc32, law, shard, slot (from 0 without gaps in each shard, by a two-level running count in
    an order of ids and texts that no file layout changes), grown_shard (null). Null text counts as empty; texts are
    measured whole. Only one text whose copies hold more than a shard's bytes makes its shard larger, as copies never
    part. Ties of a dimension are cut by the text's hash. Rows that repeat get a slot each; other columns are not read,
    whatever their names; empty table: no rows.
    """
    rows = written(points(docs, id_column, text_column), "points")  # 80 bytes a document, read once for each level
    alone = heavy(rows, shards)
    rest = rows.where(~F.col("hash").isin(alone)) if alone else rows
    shard = _number(tree(rest, shards - len(alone))) + len(alone)
    for k, h in enumerate(alone):
        shard = F.when(F.col("hash") == h, k).otherwise(shard)
    # rows of one id and text are one group with a count, so their number burdens no task
    groups = rows.withColumn("shard", shard.cast("int")).groupBy("doc_id", "size", "text_crc32", "hash", "shard").agg(F.count("*").alias("many"))
    placed = running_total(groups.withColumn("order", F.struct(F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull(), "hash")), ["shard"], "order", "many", "first", buckets=256)
    slots = placed.withColumn("slot", F.explode(F.sequence(F.col("first").cast("long"), (F.col("first") + F.col("many") - 1).cast("long"))))
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of each document of the table."""
    return shard_documents(documents(spark, sf_dir))
