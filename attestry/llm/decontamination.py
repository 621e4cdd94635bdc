"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into overlapping passages of words. Words of the benchmark are terms, weighted by inverse document
frequency over all passages; a randomised eigendecomposition of the passages' term covariance (the right singular vectors of
the TF-IDF matrix) is summed over all passages in one pass and solved on the driver, where it is terms by rank. Passages and
benchmark items are compared by cosine in that space, and candidates are checked on their words: by the longest common
subsequence with the item, and for paraphrases also by that of its rarer words, or by its last words. Items of few words have no
such shape; they are looked for word by word.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm.common import forget, map_rows, partitions, table, written

#: Words of a passage and from one passage to the next; a passage is a whole number of strides.
STRIDE = 32
STRIDES = 2
RANK = 96
#: Weight of the benchmark's own passages among those that the decomposition is fitted to, as a share of all variance.
ITEM_SHARE = 0.9
LEAST_COSINE = 0.4
#: Share of an item's words in the longest common subsequence: enough alone, and enough with its rarer words or its last ones.
VERBATIM = 0.8
PARAPHRASE = 0.6
ANSWER_WORDS = 6
ANSWER_SHARE = 0.8
#: Share of the rarer half of an item's words in order that tells a paraphrase from a text with the same frequent words.
RARE_SHARE = 0.4
#: Items that are looked for in one pass over the documents; RANK dimensions don't tell many more apart.
ITEMS = 256
#: Terms whose part of the covariance is summed in one row.
ROWS = 512
#: Term numbers, in bytes, of the documents that are compared at once.
BATCH_BYTES = 1 << 17
#: Items of fewer words count only as a whole, with their words on end, and of fewer than ALONE words only as the whole text.
LEAST_WORDS = 8
ALONE = 3
_WORD = re.compile(r"\w+")
_APART = bytes(c if chr(c).isalnum() and c < 128 or c == 95 else 32 for c in range(256))


def words_in(text: str | None) -> list[str]:
    low = (text or "").lower()
    if low.isascii():  # the same words, parted faster
        return low.encode().translate(_APART).decode().split()
    return _WORD.findall(low)


def common_subsequence(item: list[int], passage: list[int]) -> int:
    """Length of the longest common subsequence, with the item as bits of one integer (Hyyrö 2004)."""
    full = (1 << len(item)) - 1
    at: dict[int, int] = {}
    for i, x in enumerate(item):
        at[x] = at.get(x, 0) | 1 << i
    row = full
    for y in passage:
        if hit := at.get(y):
            u = row & hit
            row = (row + u | row - u) & full
    return len(item) - row.bit_count()


class Terms:
    """The benchmark's words as numbers from 1; any other word is 0."""

    def __init__(self, items: list[tuple[int, list[str]]]) -> None:
        self.number = {w: i + 1 for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}

    def __call__(self, words: list[str]) -> np.ndarray:
        return np.array(list(map(self.number.get, words, itertools.repeat(0))), dtype=np.int32)


def run_sums(values: np.ndarray, rows: np.ndarray, starts: np.ndarray, longest: int = STRIDE * STRIDES) -> np.ndarray:
    """Sums of values[rows] over the runs that begin at starts, rows of all runs at once; np.add.reduceat takes some eight times as long over so many columns."""
    lengths = np.diff(np.append(starts, len(rows)))
    if len(lengths) and lengths.max() > longest:
        pieces = -(-lengths // longest)
        first = np.cumsum(pieces) - pieces
        parts = run_sums(values, rows, np.repeat(starts, pieces) + (np.arange(pieces.sum()) - np.repeat(first, pieces)) * longest, longest)
        return run_sums(parts, np.arange(len(parts)), first, longest)
    by = np.argsort(-lengths, kind="stable")
    at, lengths = starts[by], lengths[by]
    sums = values[rows[at]]
    for k in range(1, int(lengths.max(initial=0))):
        m = np.searchsorted(-lengths, -k)  # runs longer than k
        sums[:m] += values[rows[at[:m] + k]]
    out = np.empty_like(sums)
    out[by] = sums
    return out


def strides(docs: list[np.ndarray], values: np.ndarray, step: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """For each stride of the documents' words the sum of its terms' rows of values; and the number of strides of each document, one at least."""
    counts = np.array([max(1, -(-len(ids) // step)) for ids in docs])
    out = np.zeros((counts.sum(), values.shape[1]), dtype=np.float32)
    where = [np.flatnonzero(ids) for ids in docs]
    rows = np.concatenate([ids[w] for ids, w in zip(docs, where, strict=True)])
    of = np.concatenate([first + w // step for first, w in zip((np.cumsum(counts) - counts).tolist(), where, strict=True)])
    if len(rows):
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        out[of[starts]] = run_sums(values, rows, starts)
    return out, counts


def passages(sums: np.ndarray, counts: np.ndarray, n: int = STRIDES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over n strides on end, one passage beginning at each stride of a document but the last ones; and the document and the stride of each."""
    many = np.maximum(1, counts - n + 1)
    doc = np.repeat(np.arange(len(counts)), many)
    stride = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = np.repeat(np.cumsum(counts) - counts, many) + stride
    out = sums[at]
    for k in range(1, n):
        more = stride + k < counts[doc]
        out[more] += sums[at[more] + k]
    return out, doc, stride


def numbered(docs: DataFrame, terms: Terms) -> DataFrame:
    """(doc_id, ids binary, n_words): the documents' words as term numbers, in order, without what is behind the last term; two bytes each if that does."""
    id_kind = dict(docs.dtypes)["doc_id"]
    kind = kind_of(len(terms.number))
    shared = docs.sparkSession.sparkContext.broadcast(terms.number)  # the words of ITEMS items at most

    def run(rows):
        number = shared.value.get
        for doc_id, text in rows:
            words = words_in(text)
            ids = np.array(list(map(number, words, itertools.repeat(0))), dtype=kind)
            last = np.flatnonzero(ids)
            yield doc_id, ids[: last[-1] + 1].tobytes() if len(last) else b"", len(words)

    return map_rows(docs.select("doc_id", "text"), run, f"doc_id {id_kind}, ids binary, n_words long")


def kind_of(terms: int) -> type:
    return np.uint16 if terms < 1 << 16 else np.int32


def term_weights(ids: DataFrame, terms: int, step: int = STRIDE * STRIDES) -> np.ndarray:
    """Inverse document frequency of each term over all passages (on end); index 0, the unknown word, has weight 0."""

    kind = kind_of(terms)

    def run(rows):
        seen, total = np.zeros(terms + 1, dtype=np.int64), 0
        for (raw,) in rows:
            found = np.frombuffer(raw, kind).astype(np.int64)
            total += max(1, -(-len(found) // step))
            pairs = np.unique((np.arange(len(found)) // step) * (terms + 1) + found)
            seen += np.bincount(pairs % (terms + 1), minlength=terms + 1)
        seen[0] = total
        for i in np.flatnonzero(seen):
            yield int(i), int(seen[i])

    counts = np.zeros(terms + 1)
    for r in map_rows(ids.select("ids"), run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():  # a row for each term at most
        counts[r["term"]] = r["n"]
    weights = np.log((1 + counts[0]) / (1 + counts))
    weights[0] = 0
    return weights


def covariance(ids: DataFrame, omega: np.ndarray) -> tuple[np.ndarray, float]:
    """A^T (A omega) over all passages (on end), omega being weighted; and the squared length of A omega.

    Each task sums its own part; the parts of a block of terms are added up as they stream by.
    """
    spark = ids.sparkSession
    terms, rank = omega.shape
    kind = kind_of(terms - 1)
    shared = spark.sparkContext.broadcast(omega.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        omega, out, size = shared.value, np.zeros((terms, rank)), 0.0
        held: list[np.ndarray] = []
        spots: list[np.ndarray] = []
        count = passage = 0

        def add() -> None:
            nonlocal size
            term, spot = np.concatenate(held), np.concatenate(spots)
            starts = np.flatnonzero(np.concatenate([[True], spot[1:] != spot[:-1]]))
            y = run_sums(omega, term, starts)
            size += float((y.astype(np.float64) ** 2).sum())
            order = np.argsort(term, kind="stable")
            row = np.repeat(np.arange(len(starts)), np.diff([*starts, len(term)]))[order]
            firsts = np.flatnonzero(np.concatenate([[True], np.diff(term[order]) != 0]))
            out[term[order][firsts]] += run_sums(y, row, firsts)

        for batch in batches:
            for raw in batch.column(0):
                found = np.frombuffer(raw.as_py(), kind)
                where = np.flatnonzero(found)
                if len(where):
                    held.append(found[where])
                    spots.append(passage + where // (STRIDE * STRIDES))
                    passage += -(-len(found) // (STRIDE * STRIDES))
                    count += len(where)
                    if count > 1 << 17:
                        add()
                        held, spots, count = [], [], 0
        if count:
            add()
        for b in range(0, terms, ROWS):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([out[b : b + ROWS].astype(np.float32).tobytes()]), pa.array([size if b == 0 else 0.0])], names=["block", "part", "size"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        size = 0.0
        for batch in batches:
            for b, part, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(part, np.float32).astype(np.float64)
                sums[b] = sums[b] + part if b in sums else part
                size += more
        for i, (b, part) in enumerate(sums.items()):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([part.astype(np.float32).tobytes()]), pa.array([size if i == 0 else 0.0])], names=["block", "part", "size"])

    schema = "block int, part binary, size double"
    parts = ids.select("ids").mapInArrow(run, schema).repartition(partitions(spark), "block").mapInArrow(total, schema)
    out, size = np.zeros((terms, rank)), 0.0
    for r in parts.toLocalIterator():
        out[r["block"] : r["block"] + ROWS] = np.frombuffer(r["part"], np.float32).reshape(-1, rank)
        size += r["size"]
    return out, size


def latent_space(ids: DataFrame, items: list[np.ndarray], weights: np.ndarray, rank: int = RANK, share: float = ITEM_SHARE, seed: int = 5) -> np.ndarray:
    """Terms by rank: leading right singular vectors of the passages' TF-IDF matrix, the items' own passages included.

    The sketch C omega of C = A^T A takes one pass over all passages; its eigenvectors follow by the Nystrom formula.
    """
    terms, rng = len(weights), np.random.default_rng(seed)
    rank = min(rank, terms - 1)
    omega = np.linalg.qr(rng.standard_normal((terms, min(terms, rank + 8))))[0]
    sketch, size = covariance(ids, omega * weights[:, None])
    sketch *= weights[:, None]
    mine, length = np.zeros((terms, omega.shape[1])), 0.0
    for item in items:
        y = weights[item] @ omega[item]
        np.add.at(mine, item, weights[item][:, None] * y)
        length += float((y**2).sum())
    weight = 1.0 if not size else share / (1 - share) * size / max(1e-12, length)
    sketch += weight * mine
    nu = 1e-7 * np.linalg.norm(sketch) + 1e-12
    sketch += nu * omega
    core = omega.T @ sketch
    lower = np.linalg.cholesky((core + core.T) / 2 + nu * np.eye(len(core)))
    u, _, _ = np.linalg.svd(np.linalg.solve(lower, sketch.T).T, full_matrices=False)
    return u[:, :rank]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class ShortFinder:
    """Items of few words in a document, from its term numbers: their words on end, found by a hash of as many words from each place."""

    def __init__(self, items: list[tuple[object, np.ndarray]], alone: int = ALONE) -> None:
        self.alone = alone
        self.of: dict[int, dict[int, list[tuple[object, list[int]]]]] = {}
        for item, ids in items:
            self.of.setdefault(len(ids), {}).setdefault(int(self.hashed(ids, len(ids))[0]), []).append((item, ids.tolist()))
        self.keys = {n: np.array(sorted(found), dtype=np.uint64) for n, found in self.of.items()}

    @staticmethod
    def hashed(ids: np.ndarray, n: int) -> np.ndarray:
        out, ids = np.zeros(len(ids) - n + 1, dtype=np.uint64), ids.astype(np.uint64)
        for k in range(n):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[k : len(ids) - n + 1 + k]
        return out

    def __call__(self, ids: np.ndarray, n_words: int) -> dict[object, float]:
        found = {}
        for n, keys in self.keys.items():
            if len(ids) < n or n < self.alone and n_words != n:
                continue
            hashes = self.hashed(ids, n)
            for at in np.flatnonzero(np.isin(hashes, keys)).tolist():
                for item, said in self.of[n][int(hashes[at])]:
                    if said == ids[at : at + n].tolist():
                        found[item] = 1.0
        return found


class Finder:
    """Items of the benchmark in documents, from their term numbers."""

    def __init__(self, items: list[tuple[int, np.ndarray]], values: np.ndarray, least: float, verbatim: float, paraphrase: float, weights: np.ndarray) -> None:
        self.items = [(i, ids.tolist()) for i, ids in items]
        self.rare = [set(ids[weights[ids] >= np.median(weights[ids])].tolist()) for _, ids in items]
        self.bags = [np.unique(ids, return_counts=True) for _, ids in items]
        self.bag_terms, self.bag_counts = (np.concatenate(x) for x in zip(*self.bags, strict=True))
        self.bag_starts = np.cumsum([0, *(len(terms) for terms, _ in self.bags[:-1])])
        self.needs = min(verbatim, paraphrase) * np.array([len(ids) for _, ids in items])
        self.longest = max(len(ids) for _, ids in items)
        self.values = values.astype(np.float32)
        self.queries = unit(np.stack([values[ids].sum(axis=0) for _, ids in items])).astype(np.float32)
        self.least, self.verbatim, self.paraphrase = least, verbatim, paraphrase

    def candidates(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (passage, item) whose cosine suffices, as the numbers of the document, of its stride, and of the item; in order."""
        sums, doc, stride = passages(*strides(docs, self.values))
        passage, item = np.nonzero(unit(sums) @ self.queries.T >= self.least)
        return doc[passage], stride[passage], item

    def verdict(self, item: list[int], rare: set[int], near: np.ndarray) -> float | None:
        """Share of the item's words in the best window of the words near a candidate, if it is a copy or a paraphrase."""
        need = min(self.verbatim, self.paraphrase) * len(item)
        hit = np.isin(near, item)
        width = len(item) + max(4, len(item) // 4)
        sums = np.cumsum(np.concatenate([[0], hit]))
        inside = sums[width:] - sums[:-width] if len(near) > width else sums[-1:]
        best, done = 0, -1
        for start in np.flatnonzero(inside >= need):
            if start < done:
                continue
            done = start + max(1, width // 8)
            window = near[start : start + width + width // 4].tolist()
            n = common_subsequence(item, window)
            if n >= need:
                answer = item[-ANSWER_WORDS:]
                told = common_subsequence(answer, window) >= ANSWER_SHARE * len(answer)
                if not told:
                    seldom = [x for x in item if x in rare]
                    told = common_subsequence(seldom, window) >= RARE_SHARE * len(seldom)
                if n >= self.verbatim * len(item) or told and n >= self.paraphrase * len(item):
                    best = max(best, n)
        return best / len(item) if best else None

    def __call__(self, docs: list[np.ndarray]) -> list[dict[object, float]]:
        """For each document the items found and how much of them."""
        out: list[dict[object, float]] = [{} for _ in docs]
        full = [d for d, ids in enumerate(docs) if len(ids)]
        if full:
            doc, stride, item = self.candidates([docs[d] for d in full])
            edges = [0, *(np.flatnonzero(doc[1:] != doc[:-1]) + 1).tolist(), len(doc)] if len(doc) else [0]
            for a, b in itertools.pairwise(edges):
                d = full[doc[a]]
                out[d] = self.found(docs[d], stride[a:b], item[a:b])
        return out

    def found(self, ids: np.ndarray, stride: np.ndarray, item: np.ndarray) -> dict[object, float]:
        """The document's items, from its candidates by the strides that their passages begin with."""
        found: dict[object, float] = {}
        # the words that an item and the text, or the surroundings of a passage, share bound the common subsequence from above
        there = np.bincount(ids, minlength=len(self.values))
        enough = np.add.reduceat(np.minimum(there[self.bag_terms], self.bag_counts), self.bag_starts) >= self.needs
        hold = enough[item]
        for passage, pairs in itertools.groupby(zip(stride[hold].tolist(), item[hold].tolist(), strict=True), key=lambda c: c[0]):
            start = passage * STRIDE
            near = ids[max(0, start - self.longest) : start + STRIDE * STRIDES + self.longest]
            there = np.bincount(near, minlength=len(self.values))
            for _, k in pairs:
                number, words = self.items[k]
                terms, counts = self.bags[k]
                if np.minimum(there[terms], counts).sum() >= self.needs[k] and (share := self.verdict(words, self.rare[k], near)) is not None:
                    found[number] = max(share, found.get(number, 0.0))
        return found


def blocks_of(benchmark: DataFrame, items_at_once: int) -> Iterator[list[tuple[object, list[str]]]]:
    """The benchmark's items with a word, in order, a block at a time; the driver holds one block."""
    block: list[tuple[object, list[str]]] = []
    for r in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        if words := words_in(r["text"]):
            block.append((r["item_id"], words))
        if len(block) == items_at_once:
            yield block
            block = []
    if block:
        yield block


def together(rows: Iterator[tuple], size: Callable[[tuple], int], most: int) -> Iterator[list[tuple]]:
    """Rows in lists that end with the one by which their sizes, one at least for each, exceed most."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += max(1, size(row))
        if total > most:
            yield held
            held, total = [], 0
    if held:
        yield held


def leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, least: float = LEAST_COSINE, verbatim: float = VERBATIM, paraphrase: float = PARAPHRASE, least_words: int = LEAST_WORDS, items_at_once: int = ITEMS, share: float = ITEM_SHARE) -> DataFrame:
    """docs (doc_id, text), benchmark (item_id, text) -> (doc_id, item_id, share): items found in documents, in no order.

    The benchmark is a stated query set: it is looked for in blocks of items_at_once items, each a pass over all documents. Items of
    fewer than least_words words are found only with all their words on end, and of fewer than ALONE words only where they are the
    whole text. Items without a word, null texts with them, are found nowhere; items that repeat are found each. Documents with null or
    empty texts have no leaks, and empty tables give none. Results are by row of docs, so that rows that repeat a doc_id give repeated results.
    """
    spark = docs.sparkSession
    kind, key = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id {kind}, item_id {key}, share double"
    out, ids, shared = spark.createDataFrame([], schema), None, None
    for n, block in enumerate(blocks_of(benchmark, items_at_once)):
        if ids is not None:  # more than one pass: each is done before the next, and leaves its few rows
            out = written(out, "leaks")
            forget(ids)
            shared.unpersist()
        terms = Terms(block)
        items = [(i, terms(words)) for i, words in block if len(words) >= least_words]
        short = [(i, terms(words)) for i, words in block if len(words) < least_words]
        ids = written(numbered(docs, terms), "ids")
        weights = values = None
        if items:
            weights = term_weights(ids, len(terms.number))
            values = latent_space(ids, [x for _, x in items], weights, rank, share) * weights[:, None]
        shared = spark.sparkContext.broadcast((items, short, values, weights))  # items_at_once items, terms by rank numbers

        def run(rows, shared=shared, kind=kind_of(len(terms.number))):
            items, short, values, weights = shared.value
            finder = Finder(items, values, least, verbatim, paraphrase, weights) if items else lambda docs: [{} for _ in docs]
            whole = ShortFinder(short)
            for batch in together(rows, lambda row: len(row[1]), BATCH_BYTES):
                docs = [np.frombuffer(raw, kind) for _, raw, _ in batch]
                for (doc_id, _, n_words), ids, found in zip(batch, docs, finder(docs), strict=True):
                    for item, share in (found | whole(ids, n_words)).items():
                        yield doc_id, item, share

        out = out.unionByName(map_rows(ids, run, schema)) if n else map_rows(ids, run, schema)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs (doc_id, text) -> a row for each doc_id, null included: contaminated, items (sorted) and share, the largest of an item's words found.

    Rows that repeat a doc_id are taken together; null and empty texts are clean, and without items every text is. Other columns of docs don't matter.
    """
    found = leaks(docs.select("doc_id", "text"), benchmark, **options).groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("share").alias("share"))
    found = found.select(F.col("doc_id").alias("f_doc"), "items", "share")
    every = docs.select("doc_id").distinct()
    rows = every.join(found, F.col("doc_id").eqNullSafe(F.col("f_doc")), "left")
    none = F.array().cast(f"array<{dict(benchmark.dtypes)['item_id']}>")
    return rows.select("doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", none).alias("items"), F.coalesce("share", F.lit(0.0)).alias("share"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the whole benchmark: whether a text holds an item, which ones and how much of them; a row for each doc_id."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
