"""Mixing sources to target weights.

A source's documents, in a fixed order, are one stream of words that is packed into blocks of fixed length. A source's
target says how many blocks the mix takes of it; they are its slots. The sources' counts in the output shards are drawn
from multinomial distributions, a draw for each run of SLOT_CHUNK slots of a source (their sum is multinomial too, and a
source's total is held, so targets and caps are exact); the slots of a shard follow from its counts. Slot k of a source
takes block p(k mod blocks) under the source's pseudorandom permutation p (a Feistel network that walks its cycle until it
is inside), so a source repeats itself only after all its blocks. Blocks join slots by their index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, partitions, running_total, word_count, written

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS = 64
SHARDS = 64
SLOT_CHUNK = 8192
SEED = 20_240_601


def ranked(rows: DataFrame, order: Column) -> DataFrame:
    """rows with ``place``, their number from 0 in the order: sorted by ranges, so that no task sees all of them; only a
    count for each range reaches the driver."""
    rows = written(rows.orderBy(order).withColumn("at", F.monotonically_increasing_id()), "mix-ranked")
    part, inside = F.shiftright("at", 33), F.col("at") % F.lit(1 << 33)
    before, offsets = 0, []
    for r in sorted(rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):
        offsets += [F.lit(r.part), F.lit(before)]
        before += r.n
    first = F.create_map(*offsets)[part] if offsets else F.lit(0)
    return rows.withColumn("place", (first + inside).cast("long")).drop("at")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size -> also weight and target: ``share`` of all words by weight, none above ``most`` its size.

    What sources cannot take is given to the others by weight until none is above: the level, words for each unit of
    weight, rises with each round of aggregates until no further source is capped. Sources are counted and capped in
    parallel, however many there are.
    """
    at = (F.col("place") % len(weights)).cast("int")
    rows = ranked(sizes, F.col("source").asc_nulls_last()).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), at + 1))
    rows = rows.withColumn("cap", F.col("source_size") * most).drop("place")
    whole = (rows.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        r = rows.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("cap"))).alias("cap"), F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if r.weight is None or r.n == capped:
            break
        level, capped = max(level, (whole - (r.cap or 0.0)) / r.weight), r.n
    return rows.select("source", "source_size", "weight", F.least("cap", F.lit(level) * F.col("weight")).alias("target") if r.weight is not None else F.col("cap").alias("target"))


def binomial_half(n: Column, *key: Column) -> Column:
    """A draw from the binomial distribution of n trials at one half: the ones among n keyed pseudorandom bits."""
    word = lambda w: F.xxhash64(*key, w)
    kept = lambda w: F.least(F.lit(64), n - w * 64).cast("int")
    ones = lambda w: F.bit_count(F.call_function("shiftrightunsigned", word(w), 64 - kept(w)))
    return F.when(n > 0, F.reduce(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / 64).cast("long")), F.lit(0).cast("long"), lambda a, w: a + ones(w))).otherwise(F.lit(0).cast("long"))


def multinomial(n: Column, shards: int, *key: Column) -> Column:
    """An array of shards counts drawn from the even multinomial distribution of n trials: halved, and halved again."""
    if shards & (shards - 1):
        raise ValueError("the number of shards is a power of two")

    def halved(counts: Column, depth: int) -> Column:
        # the draw is made once, in an array of one
        return F.flatten(F.transform(counts, lambda c, i: F.flatten(F.transform(F.array(binomial_half(c, *key, F.lit(depth), i)), lambda x: F.array(x, c - x)))))

    counts = F.array(n.cast("long"))
    for depth in range(shards.bit_length() - 1):
        counts = halved(counts, depth)
    return counts


def permuted(index: Column, size: Column, key: Column) -> Column:
    """Where a keyed permutation of 0 .. size - 1 sends index: four Feistel rounds on rows and columns of a rectangle
    that is at most one row larger, repeated while the result lies beyond size. A cycle leaves the inside for fewer
    steps than the rectangle has cells outside, so 64 steps always suffice for 4,096, and for more a walk that long has a
    chance below 64^-64; should it come, the job fails and nothing is lost in silence."""
    wide = F.ceil(F.sqrt(size)).cast("long")
    tall = F.ceil(size / wide).cast("long")

    def turn(x: Column) -> Column:
        a, b = F.floor(x / wide).cast("long"), F.pmod(x, wide)
        for r in range(2):
            a = F.pmod(a + F.pmod(F.xxhash64(b, key, F.lit(2 * r)), tall), tall)
            b = F.pmod(b + F.pmod(F.xxhash64(a, key, F.lit(2 * r + 1)), wide), wide)
        return a * wide + b

    found = F.reduce(F.sequence(F.lit(1), F.lit(64)), turn(index), lambda x, _: F.when(x < size, x).otherwise(turn(x)))
    checked = F.transform(F.array(found), lambda x: F.when(x < size, x).otherwise(F.raise_error(F.lit("the cycle walk did not end")).cast("long")))
    return checked[0]


def mix_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(taken, slots): what the mix takes of each document, and the mix itself, slot by slot.

    taken: doc_id, size, source, source_size, target, taken, start (words of the source before it); one row a document,
    repeated rows each on their own.
    slots: source, shard, position (of the slot in its source), block. Null texts have no words; a null source is a
    source of its own, the last; documents without words are taken 0 times. A text of any length is a run of blocks.
    Columns not named are not read. Empty table: no rows.
    """
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[source_column].alias("source"), word_count(docs[text_column]).alias("size"), F.xxhash64(F.coalesce(docs[text_column], F.lit(""))).alias("hash"))
    rows = written(rows, "mix-sizes")  # a few numbers a document: the texts are read once
    plan = written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-targets")
    plan = plan.withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long")).withColumn("slots", F.coalesce(F.round(F.try_divide(F.col("target") * F.col("blocks"), F.col("source_size"))).cast("long"), F.lit(0).cast("long")))
    plan = plan.withColumn("source_key", F.xxhash64("source", F.lit(seed)))
    ordered = rows.withColumn("order", F.struct("hash", F.coalesce("doc_id", F.lit(-1))))
    placed = running_total(ordered, ["source"], "order", "size", "start").drop("order", "hash")
    chunks = plan.where("slots > 0").select("source", "source_key", "blocks", "slots", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / SLOT_CHUNK).cast("long"))).alias("chunk"))
    chunks = chunks.repartition(partitions(docs.sparkSession), F.col("source_key"), F.col("chunk"))  # few small rows, much work
    first = F.col("chunk") * SLOT_CHUNK
    many = F.least(F.lit(SLOT_CHUNK), F.col("slots") - first)
    counts = chunks.select("source", "source_key", "blocks", first.alias("first"), multinomial(many, shards, F.col("source_key"), F.col("chunk")).alias("counts"))
    # a shard's slots of the run follow those of the shards before it
    ends = F.reduce("counts", F.array(F.lit(0).cast("long")), lambda a, c: F.concat(a, F.array(F.element_at(a, -1) + c)))
    shared = counts.withColumn("ends", ends).select("source", "source_key", "blocks", "first", "ends", F.posexplode("counts").alias("shard", "count")).where("count > 0")
    begin = F.col("first") + F.get("ends", F.col("shard"))
    slots = shared.select("source", "source_key", "blocks", "shard", F.explode(F.sequence(begin, begin + F.col("count") - 1)).alias("position"))
    slots = slots.select("source", "source_key", "shard", "position", permuted(F.pmod("position", "blocks"), F.col("blocks"), F.col("source_key")).alias("block"))
    # the optimizer takes exploded rows for as few as they were before and would broadcast them
    drawn = slots.groupBy("source_key", "block").agg(F.count("*").alias("times")).hint("merge")
    joined = placed.join(plan.select(F.col("source").alias("s"), "source_size", "target", "source_key"), placed["source"].eqNullSafe(F.col("s"))).drop("s")
    spans = joined.withColumn("row", F.struct("source_key", "start", "size", "doc_id"))
    last = F.floor((F.col("start") + F.greatest(F.col("size"), F.lit(1)) - 1) / block_words).cast("long")
    pieces = spans.where("size > 0").select("row", "source_key", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block_words).cast("long"), last)).alias("block"))
    overlap = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.greatest(F.col("start"), F.col("block") * block_words)
    taken = pieces.withColumn("words", overlap).join(drawn, ["source_key", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = spans.join(taken.hint("merge"), "row", "left").select("doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "start")
    return out, slots.select("source", "shard", "position", "block")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document of the table."""
    return mix_documents(documents(spark, sf_dir))[0].select("doc_id", "size", "source_size", "target", "taken")
