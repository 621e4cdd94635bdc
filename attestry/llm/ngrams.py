"""Language-model scores from a log-frequency Bloom filter.

Talbot and Osborne, "Smoothed Bloom filter language models" (2007): an n-gram whose count has quantum q is put into the filter
q times, together with 1, 2, ... q, and a lookup probes 1, 2, ... until a probe fails; the error is one-sided and falls with
each probe. Texts are cut into windows; the distinct n-grams of a window go, sorted by hash, in pieces to the tasks that have their
segments of the hash range. Each task builds the filter of its segments, as large as their entries ask for, probes it for
each piece and sends the levels back to the window, where probabilities are taken. No task holds more than its segments and nothing is
read once more for a larger filter, so that the cost grows with the corpus alone. Probabilities are those of a bigram model with a
Dirichlet prior on the unigrams.
"""

from __future__ import annotations

import itertools
import math
import pickle
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm.common import bound_batches, grouped, map_rows, partitions, table, written
from attestry.llm.language import remainder

#: Bits for an entry of the filter, and bits of it that a task holds (64 MB).
ENTRY_BITS = 8
PASS_BITS = 1 << 29
#: Tokens of the corpus for each segment of the filter, and segments at most.
SEGMENT_TOKENS = 1 << 18
MOST_SEGMENTS = 1 << 20
PROBES = 4
#: Counts are quantised to powers of this base.
BASE = 2.0
#: Weight of the unigram prior, in tokens.
PRIOR = 8.0
#: Tokens with the highest counts, which are sent to the workers with their exact counts; the others' counts are asked for.
HEAD = 1 << 17
#: Distinct words that a task counts beyond this are passed on.
FLUSH = 1 << 18
#: N-grams of the training texts for each task that probes, at most, and tokens of a window.
PART_GRAMS = 1 << 22
WINDOW = 1 << 19
#: What a piece is for.
LEARN, ASK, NAMED, COUNTED = 1, 2, 4, 8
PIECES = "deal int, window long, part int, kind int, data binary, n binary"
END = b""
#: An odd multiplier for each level of the filter.
_LEVELS = [2 * (0x9E3779B97F4A7C15 * (k + 1) % (1 << 63)) % (1 << 64) + 1 for k in range(80)]
_K1, _K2, _K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def tokens(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a UTF-8 text and an end; the end is the empty word, which no text has."""
    found = (text or b"").lower().split()
    found.append(END)
    return found


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


class Vocabulary(dict):
    """Numbers of words in the order in which they come, from a start; with their hashes."""

    def __init__(self, words: Iterable[bytes] = ()) -> None:
        from xxhash import xxh64_intdigest

        self.digest, self.hashes, self.held = xxh64_intdigest, [], np.zeros(0, np.uint64)
        for w in words:
            self[w]

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.hashes)
        self.hashes.append(self.digest(word, 1))
        return n

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """Hashes of words by their numbers."""
        more = len(self.hashes) - len(self.held)
        if more > 1 << 15:
            self.held = np.concatenate([self.held, np.array(self.hashes[len(self.held) :], dtype=np.uint64)])
            more = 0
        if not more:
            return self.held[numbers]
        new = np.array(self.hashes[len(self.held) :], dtype=np.uint64)
        old = numbers < len(self.held)
        out = np.empty(len(numbers), dtype=np.uint64)
        out[old], out[~old] = self.held[numbers[old]], new[numbers[~old] - len(self.held)]
        return out


def grams(hashes: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 to order the hash of the n-gram that ends at each token; texts begin at starts, behind tokens of their own kind."""
    salt = [np.array([n], dtype=np.uint64) * _K1 for n in range(order + 1)]
    out, now, before = [mix(hashes + salt[1])], hashes, hashes
    for n in range(2, order + 1):
        before = np.concatenate([before[:1], before[:-1]])
        before[starts] = n
        now = mix(now * _K1 + before)
        out.append(mix(now + salt[n]))
    return out


def quantum(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(base) + 1e-9).astype(np.int64)


class LogFrequencyFilter:
    """A Bloom filter of (n-gram, quantum) in segments by the high bits of the n-gram's hash; segment i has the words from bounds[i] to bounds[i + 1].

    All bits of an entry lie in one 64-bit word, so that a probe is one access (Putze et al., "Cache-, hash- and space-efficient
    Bloom filters", 2007).
    """

    def __init__(self, words: np.ndarray, bounds: np.ndarray, base: float, probes: int = PROBES) -> None:
        self.words, self.base, self.segments = words, base, len(bounds) - 1
        self.start, self.size = bounds[:-1].astype(np.uint64), np.diff(bounds).astype(np.uint64)
        bits = np.random.default_rng(11).integers(0, 64, (1 << 16, probes)).astype(np.uint64)
        self.masks = np.bitwise_or.reduce(np.uint64(1) << bits, axis=1)

    def entry(self, folded: np.ndarray, level: int, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word number in the hash's segment, and the bits of the entry; folded: hash ^ hash >> 32."""
        x = folded * np.array([_LEVELS[level]], dtype=np.uint64)
        return (x >> np.uint64(32)) * size >> np.uint64(32), self.masks[(x >> np.uint64(16)) & np.uint64(0xFFFF)]

    @staticmethod
    def segment(hashes: np.ndarray, segments: int) -> np.ndarray:
        return (hashes >> np.uint64(40)) * np.uint64(segments) >> np.uint64(24)

    @classmethod
    def of(cls, hashes: np.ndarray, counts: np.ndarray, base: float, entry_bits: int) -> LogFrequencyFilter:
        """A filter of one segment, of as many words as its entries ask for."""
        q = quantum(counts, base)
        size = max(1, -(-int(q.sum()) * entry_bits // 64))
        out = cls(np.zeros(size, np.uint64), np.array([0, size]), base)
        for level in range(1, int(q.max(initial=0)) + 1):
            h = hashes[q >= level]
            place, mask = out.entry(h ^ h >> np.uint64(32), level, out.size[0])
            np.bitwise_or.at(out.words, place, mask)
        return out

    def levels(self, hashes: np.ndarray, most: int = 64) -> np.ndarray:
        """The quantum that the probes reach, 0 if the first fails or the segment is empty."""
        if len(hashes) > 1 << 14:  # what a step works on stays in the processor's cache
            return np.concatenate([self.levels(hashes[i : i + (1 << 14)], most) for i in range(0, len(hashes), 1 << 14)])
        reached = np.zeros(len(hashes), dtype=np.uint8)
        if not len(self.words):
            return reached
        of = self.segment(hashes, self.segments)
        size = self.size[of]
        alive = np.flatnonzero(size)
        h, o, size = hashes[alive], self.start[of[alive]], size[alive]
        h = h ^ h >> np.uint64(32)
        for level in range(1, most + 1):
            place, mask = self.entry(h, level, size)
            hit = self.words[place + o] & mask == mask
            alive, h, o, size = alive[hit], h[hit], o[hit], size[hit]
            if not len(alive):
                break
            reached[alive] = level
        return reached

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        return middles(self.base)[self.levels(hashes)]


def middles(base: float, most: int = 64) -> np.ndarray:
    """The count that each quantum stands for: the middle of those that it covers."""
    low = [math.ceil(base ** (k - 1) - 1e-9) for k in range(1, most + 1)]
    high = [max(a, math.ceil(base**k - 1e-9) - 1) for k, a in enumerate(low, start=1)]
    return np.array([0.0, *((a + b) / 2 for a, b in zip(low, high, strict=True))])


def first_of(texts: list[list[bytes]]) -> np.ndarray:
    return np.array([0, *itertools.accumulate(len(t) for t in texts[:-1])], dtype=np.int64)


def segments_for(tokens: int) -> int:
    n = 16
    while n < MOST_SEGMENTS and n * SEGMENT_TOKENS < tokens:
        n *= 2
    return n


def flat(x: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first, so that what they share is compressed."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unflat(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, len(data) // size).T.copy().view(kind).reshape(-1)


def packed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def unpacked(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def distinct(numbers: np.ndarray, words: Vocabulary, starts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """A window's distinct n-grams, sorted by hash; how often it has each; and for n = 1 to order the place among them of the n-gram that ends at each token."""
    seen = np.bincount(numbers, minlength=len(words))
    there = np.flatnonzero(seen)
    rank = np.zeros(len(seen), np.int64)
    rank[there] = np.arange(len(there))
    found = [unigrams(words.of(there)), *grams(words.of(numbers), starts, order)[1:]]
    all_, times = np.concatenate(found), np.concatenate([seen[there], np.ones(len(numbers) * (order - 1), np.int64)])
    by = np.argsort(all_)
    h = all_[by]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    places = np.empty(len(h), np.int64)
    places[by] = np.cumsum(new) - 1
    return h[new], np.add.reduceat(times[by], np.flatnonzero(new)), [places[rank[numbers]], *places[len(there) :].reshape(order - 1, len(numbers))]


def filter_of(hashes: np.ndarray, counts: np.ndarray, segments: int, base: float, entry_bits: int) -> LogFrequencyFilter:
    """The filter with those segments that the n-grams fall into, the others empty; repeated hashes are added up."""
    by = np.argsort(hashes)
    h = hashes[by]
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    h, n = h[starts], np.add.reduceat(counts[by], starts, dtype=np.int64) if len(h) else counts
    of = LogFrequencyFilter.segment(h, segments).astype(np.int64)
    sizes, held = np.zeros(segments, np.int64), []
    for a, b in runs(of):
        held.append(LogFrequencyFilter.of(h[a:b], n[a:b], base, entry_bits).words)
        sizes[of[a]] = len(held[-1])
    return LogFrequencyFilter(np.concatenate(held) if held else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(sizes)]), base)


def parts_for(tokens: int, segments: int, least: int, entry_bits: int, pass_bits: int) -> int:
    """Tasks that the filter's segments are dealt to: at least as many as least, and so many that n-grams and filter of a task stay bounded."""
    return min(segments, max(least, -(-tokens // PART_GRAMS), -(-tokens * entry_bits // pass_bits)))


def part_of(hashes: np.ndarray, segments: int, parts: int) -> np.ndarray:
    return (LogFrequencyFilter.segment(hashes, segments) * np.uint64(parts) // np.uint64(segments)).astype(np.int64)


def runs(of: np.ndarray) -> Iterator[tuple[int, int]]:
    """From where to where equal numbers follow each other."""
    return itertools.pairwise([*np.flatnonzero(np.diff(of, prepend=-1)).tolist(), len(of)])


def unigrams(words: np.ndarray) -> np.ndarray:
    return grams(words, np.zeros(0, np.int64), 1)[0]


def counted_words(counts: DataFrame, segments: int, parts: int) -> DataFrame:
    """(token, c) -> pieces of words with their exact counts, for the tasks that have the words' segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        words, times = Vocabulary(), []

        def out():
            of = part_of(unigrams(np.array(words.hashes, dtype=np.uint64)), segments, parts)
            by = np.argsort(of, kind="stable")
            names, n = list(words), np.array(times, dtype=np.uint64)[by]
            for a, b in runs(of[by]):
                yield int(of[by[a]]), 0, int(of[by[a]]), COUNTED, packed(b" ".join([names[i] for i in by[a:b].tolist()])), packed(flat(n[a:b]))

        for token, c in batches:
            words[token]
            times.append(c)
            if len(times) > FLUSH:
                yield from out()
                words, times = Vocabulary(), []
        if times:
            yield from out()

    return map_rows(counts.select("token", "c"), run, PIECES)


def answered(pieces: DataFrame, segments: int, parts: int, base: float, entry_bits: int) -> DataFrame:
    """windows' pieces (deal, window, part, kind, data, n) -> (window, part, data): the levels of each asked piece's n-grams and, behind all parts, the exact counts of
    its words, in order.

    A task gets all pieces of its segments, makes their filter of those to learn from, and probes it for those that ask. Windows themselves, as part -1, go through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["window", "part", "data"]
        hashes, counts, asking, naming, exact = [], [], [], [], {}
        for batch in batches:
            whole = pc.less(batch.column(2), 0)
            if pc.any(whole).as_py():
                yield batch.filter(whole).select(names)
            for _, window, part, kind, data, n in zip(*(c.to_pylist() for c in batch.filter(pc.invert(whole)).columns), strict=True):
                if kind == COUNTED:
                    exact.update(zip(unpacked(data).split(b" "), unflat(unpacked(n), np.uint64).tolist(), strict=True))
                    continue
                if kind == NAMED:
                    naming.append((window, part, data))
                    continue
                h = unflat(data, np.uint64)
                if kind & LEARN:
                    hashes.append(h)
                    counts.append(unflat(unpacked(n), np.uint32))
                if kind & ASK:
                    asking.append((window, part, h))
        none = [np.zeros(0, np.uint64)]
        model = filter_of(np.concatenate(hashes or none), np.concatenate(counts or none), segments, base, entry_bits)
        hashes, counts = [], []

        def answers():
            for i in range(0, len(asking), 1 << 8):
                some = asking[i : i + (1 << 8)]
                reached = np.split(model.levels(np.concatenate([h for _, _, h in some])), np.cumsum([len(h) for _, _, h in some])[:-1])
                for (window, part, _), levels in zip(some, reached, strict=True):
                    yield window, part, packed(levels.tobytes())
            for window, part, data in naming:
                yield window, parts + part, packed(flat(np.array([exact.get(w, 0) for w in unpacked(data).split(b" ")], dtype=np.uint64)))

        for some in iter(lambda rows=answers(): list(itertools.islice(rows, 1 << 10)), []):
            window, part, data = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(window, pa.int64()), pa.array(part, pa.int32()), pa.array(data, pa.binary())], names=names)

    bound_batches(pieces.sparkSession)
    return pieces.repartition(parts, "deal").mapInArrow(run, "window long, part int, data binary")


def head_of(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words, as many as most at most; of words with equal counts all or none."""
    least, n = None, 0
    # a row for each count that a word has, of which there are some sqrt(2 * tokens) at most
    for c, words in sorted(((r["c"], r["words"]) for r in counts.groupBy("c").agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True):
        n += words
        if n > most:
            break
        least = c
    return [] if least is None else sorted(((bytes(r["token"]), r["c"]) for r in counts.where(F.col("c") >= least).collect()), key=lambda x: (-x[1], x[0]))


def word_counts(training: DataFrame) -> DataFrame:
    """(token binary, c long) of the training texts, the end included; exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush():
            words, n = list(counts.keys()), list(counts.values())
            for i in range(0, len(words), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(words[i : i + (1 << 16)], pa.binary()), pa.array(n[i : i + (1 << 16)], pa.int64())], names=["token", "n"])
            counts.clear()

        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                counts.update(tokens(text.as_py()))
                if len(counts) > FLUSH:
                    yield from flush()
        yield from flush()

    return training.select("text").mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("c"))


def log_probabilities(counted: list[np.ndarray], starts: np.ndarray, total: int, vocabulary: int, prior: float, texts: int) -> np.ndarray:
    """log10 probability of each text: at each order the counts of its n-grams over those of their contexts, with the lower order as prior.

    counted: for each order the filter's count of the n-gram that ends at each token. texts: the texts learned from, which is
    how often the start was a context.
    """
    p = (counted[0] + 1) / (total + vocabulary + 1)
    for n in range(2, len(counted) + 1):
        context = np.concatenate([[0.0], counted[n - 2][:-1]])
        context[starts] = texts
        c = np.minimum(counted[n - 1], context)
        p = (c + prior * p) / (context + prior)
    return np.add.reduceat(np.log10(np.minimum(p, 1.0)), starts)


def scored(docs: DataFrame, training: DataFrame | None = None, order: int = 2, base: float = BASE, prior: float = PRIOR, head: int = HEAD, entry_bits: int = ENTRY_BITS, pass_bits: int = PASS_BITS) -> DataFrame:
    """docs (doc_id, held_out, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; a row for each.

    training (text): what is learned from; None: the docs that are not held out, which are then read once for both. base_score has exact
    counts with one added; score is the filter's model. Null texts are empty: one token, the end. The head tokens go to the workers with
    their counts, the others' counts are asked for where their segments are, so that no vocabulary must fit in memory. Without training texts
    every token is unknown. The filter has entry_bits for each entry at any size; a task holds some pass_bits of it at most, and the number
    of tasks doesn't change a score. Rows that repeat are scored alike. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    counts = written(word_counts(docs.where(~F.col("held_out")) if training is None else training), "counts")
    total, vocabulary, texts_learned = (int(x or 0) for x in counts.agg(F.sum("c"), F.count(F.lit(1)), F.sum(F.when(F.length("token") == len(END), F.col("c")))).first())
    top = head_of(counts, head)
    segments = segments_for(order * total)
    parts = parts_for(order * total, segments, partitions(spark), entry_bits, pass_bits)
    hashes = np.array(Vocabulary([w for w, _ in top]).hashes, dtype=np.uint64)
    shared = spark.sparkContext.broadcast((top, hashes))  # head entries
    add = math.log10(total + vocabulary + 1)
    kinds = dict(docs.dtypes)
    together = training is None
    window = WINDOW

    def by_part(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The parts of words by their hashes, sorted, and the order in which they are."""
        of = part_of(unigrams(words), segments, parts)
        by = np.argsort(of, kind="stable")
        return of[by], by

    def cutting(rows, together: bool, kind: int):
        """Windows of texts with their pieces; together: texts that are not held out are learned from as well."""
        from pyspark import TaskContext

        frequent = [w for w, _ in shared.value[0]]
        number, size = TaskContext.get().partitionId() << 32, 0
        words, waiting = Vocabulary(frequent), {}

        def out(kind, texts):
            starts = first_of([t for _, _, t in texts])
            numbers = np.concatenate([t for _, _, t in texts])
            h, times, _ = distinct(numbers, words, starts, order)
            of = part_of(h, segments, parts)
            for a, b in runs(of):
                yield int(of[a]), number, int(of[a]), kind, flat(h[a:b]), packed(flat(times[a:b].astype(np.uint32))) if kind & LEARN else None
            if kind & ASK:
                there = np.unique(numbers[numbers >= len(frequent)])
                of, by = by_part(words.of(there))
                there, names = there[by], list(words)
                named = [names[i] for i in there.tolist()]
                for a, b in runs(of):
                    yield int(of[a]), number, int(of[a]), NAMED, packed(b" ".join(named[a:b])), None
                rank = np.arange(len(words), dtype=np.uint32)
                rank[there] = len(frequent) + np.arange(len(there), dtype=np.uint32)
                about = [(doc_id, held_out, len(t)) for doc_id, held_out, t in texts], named, flat(rank[numbers])
                yield (number // (1 << 32) + number) % parts, number, -1, kind, packed(pickle.dumps(about)), None

        def all_out():
            nonlocal number, size, words
            for of, texts in waiting.items():
                yield from out(of, texts)
                number += 1
            waiting.clear()
            size = 0
            if len(words) > len(frequent):  # a window names those words that the head lacks
                words = Vocabulary(frequent)

        for doc_id, held_out, text in rows:
            said = tokens(text)
            waiting.setdefault(ASK | LEARN if together and held_out is False else kind, []).append((doc_id, held_out, np.fromiter(map(words.__getitem__, said), np.int64, len(said))))
            size += len(said)
            if size > window:
                yield from all_out()
        yield from all_out()

    def scoring(rows):
        top, hashes = shared.value
        middle, head = middles(base), len(top)
        head_gains = np.log10(np.array([c for _, c in top], dtype=np.float64) + 1)
        for (window,), group in grouped(rows, 1):
            _, part, data = next(group)
            if part != -1:
                raise RuntimeError(f"window {window} is missing; its input changed when a task was repeated")
            texts, names, numbers = pickle.loads(unpacked(data))
            numbers = unflat(numbers, np.uint32).astype(np.int64)
            words = Vocabulary(names)
            words.held, words.hashes = np.concatenate([hashes, np.array(words.hashes, dtype=np.uint64)]), range(head + len(names))
            starts = np.array([0, *itertools.accumulate(n for _, _, n in texts[:-1])], dtype=np.int64)
            h, _, places = distinct(numbers, words, starts, order)
            found = [(part, unpacked(data)) for _, part, data in group]
            reached = np.frombuffer(b"".join(x for part, x in found if part < parts), np.uint8)
            exact = np.concatenate([np.zeros(0, np.uint64), *(unflat(x, np.uint64) for part, x in found if part >= parts)])
            if len(reached) != len(h) or len(exact) != len(names):
                raise RuntimeError(f"window {window} has {len(h)} n-grams and {len(names)} words to be counted, and got {len(reached)} and {len(exact)}; its input changed when a task was repeated")
            scores = log_probabilities([middle[reached[p]] for p in places], starts, total, vocabulary, prior, texts_learned).tolist()
            gains = np.concatenate([head_gains, np.log10(exact.astype(np.float64) + 1)])
            known = np.concatenate([np.ones(head, np.int64), exact > 0])
            there = np.add.reduceat(known[numbers], starts).tolist()
            sure = np.add.reduceat(gains[numbers], starts).tolist()
            for (doc_id, held_out, n), score, k, gain in zip(texts, scores, there, sure, strict=True):
                yield doc_id, held_out, n, k, total, gain - add * n, score

    pieces = map_rows(docs.select("doc_id", "held_out", "text"), lambda rows: cutting(rows, together, ASK), PIECES, binary=("text",))
    if not together:
        learned = training.select(F.lit(None).alias("doc_id"), F.lit(None).cast("boolean").alias("held_out"), "text")
        pieces = pieces.unionByName(map_rows(learned, lambda rows: cutting(rows, False, LEARN), PIECES, binary=("text",)))
    if vocabulary > len(top):
        pieces = pieces.unionByName(counted_words(counts.where(F.col("c") < min((c for _, c in top), default=total + 1)), segments, parts))
    rows = answered(pieces, segments, parts, base, entry_bits).repartition(partitions(spark), "window").sortWithinPartitions("window", "part")
    schema = f"doc_id {kinds['doc_id']}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return written(map_rows(rows, scoring, schema), "scored")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by what those with crc32(doc_id) mod 7 other than 2 say; a row for each."""
    return scored(table(spark, sf_dir, "documents").select("doc_id", (remainder(by=7) == 2).alias("held_out"), "text"))
