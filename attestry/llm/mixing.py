"""Mixing sources to target weights.

The words of a source are packed into blocks of fixed length: the source's documents lie one after another in an order that
depends on doc_id alone, and block i is words [i*L, (i+1)*L) of that line. The output is cut into shards of fixed size; for
each the counts of its sources are drawn multinomially from what the sources still have to give, so that the shards are
random and the totals exact. Slot j of a source is block permutation(j) of it, a Feistel permutation of the source's block
indices with a key for each source and epoch: a source is used up before it repeats. Slots and blocks join by index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestry.llm.common import count_words, table, written

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Most times that a source's words may be taken.
MOST = 3.0
BLOCK_WORDS = 128
SHARD_SLOTS = 1 << 16
#: Parts of a source in which offsets are summed apart.
BUCKETS = 4096
#: Sources up to which they are broadcast to the documents (some 10 MB), and beyond which they are joined.
BROADCAST_SOURCES = 100_000


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> list[float]:
    """Words to take from each source: shares of the whole by weight, none above most times its size, the excess reshared by weight."""
    size = np.array(sizes, dtype=np.float64)
    share = np.resize(np.array(weights, dtype=np.float64), len(size))
    out, open_, left = np.zeros(len(size)), np.ones(len(size), dtype=bool), float(sum(sizes))
    while open_.any():
        fair = left * share / share[open_].sum()
        over = open_ & (fair > most * size)
        if not over.any():
            out[open_] = fair[open_]
            break
        out[over] = most * size[over]
        left -= float(out[over].sum())
        open_ &= ~over
    return out.tolist()


def taken(left: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Counts of n slots drawn multinomially in what is left, none above what is left of it."""
    counts = np.minimum(rng.multinomial(n, left / left.sum()), left)
    while (lack := n - int(counts.sum())) > 0:
        room = left - counts
        counts = np.minimum(counts + rng.multinomial(lack, room / room.sum()), left)
    return counts


def shards_of(quota: np.ndarray, shard_slots: int) -> int:
    return -(-int(quota.sum()) // shard_slots)


def draw(quota: np.ndarray, shard_slots: int, seed: int, low: int = 0, high: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, slots of each source in the shards before it, its own counts) for the shards from low to high; together they meet the quotas.

    The shards' range is halved down to single shards. What the first half gets is drawn multinomially, with the halves' bounds
    as seed, and the rest goes to the second, so that any task finds the counts of its shards without those of all others.
    """
    shards = shards_of(quota, shard_slots)
    high = shards if high is None else high
    open_ = [(0, shards, np.asarray(quota, dtype=np.int64), np.zeros(len(quota), dtype=np.int64))]
    while open_:
        first, end, left, before = open_.pop()
        if first >= end or end <= low or first >= high:
            continue
        if end - first == 1:
            yield first, before, left
            continue
        middle = (first + end) // 2
        half = taken(left, (middle - first) * shard_slots, np.random.default_rng([seed, first, end]))
        open_ += [(middle, end, left - half, before + half), (first, middle, half, before)]


def permuted(index: np.ndarray, n: int, key: bytes, back: bool = False) -> np.ndarray:
    """A pseudorandom permutation of range(n), or its inverse, by four Feistel rounds and cycle walking."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.frombuffer(hashlib.sha256(key).digest(), dtype="<u8")
    shift = np.uint64(half)

    def mix(x, k):
        x = (x ^ k) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))) & mask

    def once(x):
        a, b = x >> shift, x & mask
        if back:
            for k in keys[::-1]:
                a, b = b ^ mix(a, k), a
        else:
            for k in keys:
                a, b = b, a ^ mix(b, k)
        return (a << shift) | b

    out = once(index.astype(np.uint64))
    while (far := out >= np.uint64(n)).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def _plan(source: int, size: int, target: float, block: int, seed: int) -> dict:
    """How many slots give the target, whole epochs first, and how many words the last slot gives."""
    blocks, goal = -(-size // block), min(round(target), int(MOST * size))
    epochs, rest = divmod(goal, size) if size else (0, 0)
    short = size - (blocks - 1) * block if size else 0
    slots, last = epochs * blocks, None
    if rest:
        key = f"{seed}/{source}/{epochs}".encode()
        at = int(permuted(np.array([blocks - 1]), blocks, key, back=True)[0])  # where the short block comes
        n = -(-rest // block)
        if at >= n:
            last = rest - (n - 1) * block
        else:
            n = at + 1 + max(0, -(-(rest - at * block - short) // block))
            last = min(short, rest - at * block) if n == at + 1 else rest - (n - 2) * block - short
        slots += n
    return {"blocks": blocks, "slots": slots, "last": last}


def packed(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, ...) with start: the words of the source that lie before the document.

    The order is by a hash of doc_id into buckets and by (doc_id, size) in a bucket, so that no window holds a source.
    """
    docs = docs.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(BUCKETS)).cast("int"))
    sums = docs.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = docs.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(base, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    return rows.select("doc_id", "source", "size", *extra, (F.col("base") + F.col("inner")).alias("start"))


def sources_of(sized: DataFrame, weights: tuple[float, ...]) -> list[tuple]:
    """(number, source, size, target) by code point, null last: a row for each source, as a mix is a configuration (some 200 bytes each on the driver)."""
    found = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    rows = sorted(((r["source"], int(r["n"] or 0)) for r in found), key=lambda r: (r[0] is None, (r[0] or "").encode("utf-32-be", "surrogatepass")))
    goal = targets([n for _, n in rows], weights)
    return [(i, s, n, t) for i, ((s, n), t) in enumerate(zip(rows, goal, strict=True))]


def mixed(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, block: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 7, broadcast_sources: int = BROADCAST_SOURCES) -> tuple[DataFrame, DataFrame]:
    """sized (doc_id, source, size long) -> (placed, pieces).

    placed has each row with row_id, source_size and target; pieces has the mix: shard, slot, row_id, doc_id, and the words
    [from_word, to_word) of the document that the slot takes there. Pieces of a slot lie in the order of from_at.
    Rows of size 0 have no pieces. Repeated rows are documents of their own. Null doc_ids and sources are values like others. Of documents
    that have the same doc_id and size in a source the order is any. An empty table gives empty ones.
    """
    spark = sized.sparkSession
    listed = sources_of(sized, weights)
    plans = [_plan(i, n, t, block, seed) for i, _, n, t in listed]
    names = spark.createDataFrame([(i, s, n, t) for i, s, n, t in listed], "number int, b_source string, source_size long, target double")
    if len(listed) <= broadcast_sources:
        names = F.broadcast(names)
    rows = packed(sized).join(names, F.col("source").eqNullSafe(F.col("b_source"))).drop("b_source")
    placed = written(rows.withColumn("row_id", F.monotonically_increasing_id()), "placed")

    quota = np.array([p["slots"] for p in plans], dtype=np.int64)
    shards = shards_of(quota, shard_slots)
    info = np.array([(p["blocks"], p["slots"], -1 if p["last"] is None else p["last"], n) for p, (_, _, n, _) in zip(plans, listed, strict=True)], dtype=np.int64).reshape(-1, 4)
    shared = spark.sparkContext.broadcast((quota, info))  # five numbers for each source

    def slots(batches):
        quota, info = shared.value
        for batch in batches:
            numbers = batch.column(0).to_pylist()  # of a range, so that they follow each other
            for shard, before, counts in draw(quota, shard_slots, seed, numbers[0], numbers[-1] + 1) if numbers else ():
                slot = 0
                for i in np.flatnonzero(counts).tolist():
                    n, first = int(counts[i]), int(before[i])
                    blocks, total, last, size = info[i].tolist()
                    j = np.arange(first, first + n)
                    epoch, inner = j // blocks, j % blocks
                    index = np.empty(n, dtype=np.int64)
                    for e in np.unique(epoch):
                        index[epoch == e] = permuted(inner[epoch == e], blocks, f"{seed}/{i}/{e}".encode())
                    words = np.minimum(block, size - index * block)
                    if last >= 0:
                        words[j == total - 1] = last
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, shard, np.int32)), pa.array(slot + np.arange(n, dtype=np.int32)), pa.array(np.full(n, i, np.int32)), pa.array(index), pa.array(words)], names=["shard", "slot", "number", "block", "words"])
                    slot += n

    spread = max(1, min(shards, 8 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))
    drawn = spark.range(0, shards, 1, spread).mapInArrow(slots, "shard int, slot int, number int, block long, words long")
    lie = placed.where("size > 0").select("row_id", "doc_id", "number", "size", "start", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * block)
    high = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("words"))
    pieces = drawn.hint("merge").join(lie, ["number", "block"])  # the slots are as many as the blocks, though their plan looks small
    pieces = pieces.withColumns({"from_at": low - F.col("block") * block, "from_word": low - F.col("start"), "to_word": high - F.col("start")}).where("to_word > from_word")
    return placed, pieces.select("shard", "slot", "number", "row_id", "doc_id", "from_at", "from_word", "to_word")


def mix_report(docs: DataFrame) -> DataFrame:
    """docs (doc_id, source, text) -> a row for each with size, source_size, target and the words that the mix takes of it.

    Null and empty texts have size 0 and are never taken. An empty table gives an empty one. Rows that repeat are documents of their own,
    and sources of equal weight and size are told apart by name; other columns of docs don't matter.
    """
    sized = written(docs.select("doc_id", F.col("source").cast("string").alias("source"), count_words().alias("size")), "sized")
    placed, pieces = mixed(sized)
    took = pieces.groupBy("row_id").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    return placed.join(took, "row_id", "left").select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, with the sizes and targets behind it; a row for each."""
    return mix_report(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
