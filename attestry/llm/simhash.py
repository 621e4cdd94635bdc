"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint has 64 bits. Fingerprints within the radius of each other agree on all but `radius` of the blocks they are
cut into, so every choice of agreeing blocks is one hash table; with 8 blocks and radius 2 a bucket agrees on 48 bits and
holds 2**16 distinct fingerprints at most, whatever the data. In a bucket the fingerprints lie vertically, one integer per
bit position with a lane per fingerprint, and one fingerprint is compared with all lanes at once: the differing lanes of
each plane are added into carry-save counters that start so that they overflow beyond the radius, and the block is
abandoned once every lane has.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm.common import map_rows, table, written
from attestry.llm.components import components

SEED = 42
#: Lanes of one vertical block.
LANES = 4096


def fingerprint(text: bytes | None, width: int = 3, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of the word shingles of a UTF-8 text; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), seed)).astype(np.int64))
    flat = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(flat[s : e - 1], seed) for s, e in zip(starts, ends[width - 1 :], strict=False)], dtype="<u8")
    return majority(hashes)


#: For each byte a word of eight byte lanes, lane i holding bit i: 255 hashes can be added before a lane overflows.
_LANES = np.array([sum((b >> i & 1) << 8 * i for i in range(8)) for b in range(256)], dtype="<u8")


def bit_sums(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each run of little-endian 64-bit hashes, beginning at starts, how many have each bit set; runs must not be empty."""
    sizes = np.diff([*starts, len(hashes)])
    pieces = -(-sizes // 255)
    at = np.repeat(np.asarray(starts), pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    sums = np.add.reduceat(_LANES[hashes.view(np.uint8).reshape(-1, 8)], at, axis=0).view(np.uint8).reshape(-1, 64)
    if len(at) == len(sizes):
        return sums
    return np.add.reduceat(sums.astype(np.int64), np.cumsum(pieces) - pieces, axis=0)


def majorities(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Signed 64-bit values of the bits that are set in over half of the hashes of each run."""
    sizes = np.diff([*starts, len(hashes)])
    return np.packbits(2 * bit_sums(hashes, starts).astype(np.int64) > sizes[:, None], axis=1, bitorder="little").view("<i8")[:, 0]


def majority(hashes: np.ndarray) -> int:
    """Signed 64-bit value of the bits that are set in over half of the hashes."""
    total = np.zeros(64, dtype=np.int64)
    for part in (hashes[i : i + (1 << 16)] for i in range(0, len(hashes), 1 << 16)):
        total += bit_sums(part, np.zeros(1, dtype=np.int64))[0]
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<i8")[0])


def planes(values: list[int], free: list[int]) -> list[int]:
    """For each bit position of free, an integer whose bit i is that bit of values[i]."""
    return [sum(1 << i for i, v in enumerate(values) if v >> bit & 1) for bit in free]


def within(block: list[int], free: list[int], lanes: int, query: int, radius: int) -> int:
    """The lanes of a vertical block whose value differs from query in at most radius of the free bits."""
    full = (1 << lanes) - 1
    size = (radius + 1).bit_length()
    start = (1 << size) - (radius + 1)
    counter = [full if start >> k & 1 else 0 for k in range(size)]
    alive = full
    for plane, bit in zip(block, free, strict=True):
        carry = (plane ^ full if query >> bit & 1 else plane) & alive
        for k in range(size):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
            if not carry:
                break
        alive &= ~carry
        if not alive:
            break
    return alive


def links(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links (i, j) that span the components of values under distance <= radius; distinct values, any order."""
    root = list(range(len(values)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    varying = 0
    for v in values:
        varying |= v ^ values[0]
    free = [b for b in range(64) if varying >> b & 1]
    for at in range(0, len(values), LANES):
        part = values[at : at + LANES]
        block = planes(part, free)
        for i, value in enumerate(values[: at + len(part)]):
            hits = within(block, free, len(part), value, radius)
            hits &= ~((1 << max(0, i + 1 - at)) - 1)
            while hits:
                low = hits & -hits
                j = at + low.bit_length() - 1
                hits ^= low
                a, b = find(i), find(j)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    yield i, j


def masks(blocks: int, radius: int) -> list[int]:
    """Signed masks, one for each choice of the blocks on which two values within the radius agree."""
    cuts = [round(64 * k / blocks) for k in range(blocks + 1)]
    bits = [((1 << b) - (1 << a)) for a, b in itertools.pairwise(cuts)]
    chosen = (sum(c) for c in itertools.combinations(bits, blocks - radius))
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def near_fingerprints(fps: DataFrame, radius: int = 2, blocks: int = 8) -> DataFrame:
    """fps (fp long, distinct) -> (a, b): links that span the components under the radius.

    With 8 blocks and radius 2 no bucket can hold more than 2**16 fingerprints, so that none is capped or split.
    """
    chosen = masks(blocks, radius)
    keyed = fps.select("fp", F.explode(F.array(*(F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(chosen)))).alias("x"))
    buckets = keyed.groupBy("x.t", "x.key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")

    def compare(rows):
        for (found,) in rows:
            values = [v & (1 << 64) - 1 for v in sorted(found)]
            back = sorted(found)
            for i, j in links(values, radius):
                yield back[i], back[j]

    return map_rows(buckets, compare, "a long, b long").distinct()


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long) for each row."""

    def run(rows):
        for doc_id, text in rows:
            yield doc_id, fingerprint(text, width)

    kind = dict(docs.dtypes)[id_col]
    return map_rows(docs.select(F.col(id_col), F.col(text_col).alias("text")), run, f"doc_id {kind}, fp long", binary=("text",))


def near_duplicates(docs: DataFrame, radius: int = 2, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long, component_id): component_id is the smallest doc_id reachable over links of radius bits or fewer.

    A row of the input gives a row of the result, repeated doc_ids included. Null and empty texts have fingerprint zero and
    link like any other. A null doc_id is no candidate for component_id, which is null only where all of a component are.
    Equal fingerprints are one node, so that copies cost nothing beyond an aggregation. An empty table gives an empty one.
    """
    every = written(fingerprints(docs, width, id_col, text_col), "fingerprints")
    distinct = written(every.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    label = components(near_fingerprints(distinct.select("fp"), radius)).select(F.col("node").alias("fp"), "label")
    named = distinct.join(label, "fp", "left").select("fp", "rep", F.coalesce("label", "fp").alias("label"))
    first = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    of = written(named.join(first, "label").select("fp", "component_id"), "components")
    return every.join(of, "fp").select("doc_id", "fp", "component_id")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document; a row for each."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
