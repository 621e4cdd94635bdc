"""Fuzzy line deduplication over a corpus.

Lines are normalised, hashed and sketched where they lie; only hashes and sketches are shuffled. Each line lies in one bucket of
each of TABLES tables, named by a min-hash of its word pairs. Lines of a bucket are candidates if their SimHashes differ in
few bits and their lengths allow the similarity. Pigeonhole blocks of the SimHash alone can't name the buckets: lines of similarity 0.8
differ in some 27 of 128 bits, for which blocks would have four bits. The lines of each group of candidates are fetched and compared by
edit similarity, many pairs at once, each in the first table in which it agrees and not if it is connected already, so that a group of m
alike lines costs about m comparisons and gives m - 1 links. Of each connected group of lines the first occurrence stays.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestry.llm.common import bound_batches, forget, map_rows, partitions, spread_join, table, written
from attestry.llm.components import components
from attestry.llm.simhash import majorities

#: Lines with fewer words are left alone; with 1 only those without a word, such as blank ones.
LEAST_WORDS = 1
#: Lines with fewer words and fewer characters are compared for equality alone, as one edit can change what they say.
FUZZY_WORDS = 5
FUZZY_CHARS = 20
#: Lines whose SimHashes of 128 bits differ in more bits aren't compared (unrelated ones differ in some 54, those of similarity 0.8 in some 27).
RADIUS = 35
#: Min-hashes of a line, the bytes of each, and the words of a shingle.
TABLES = 5
WIDTH = 6
SHINGLE = 2
#: Shingles of words with fewer bytes in all, such as those of articles, are many lines' own; they count where a line has no others.
LONG = 9
SIMILARITY = 0.8
#: Lines of a bucket that are compared in one go; a larger bucket is dealt out in pairs of parts.
BUCKET = 2048
#: Buckets up to which all pairs are listed.
PAIRS = 32
#: Lines to fetch or to look up until which their places are broadcast (some 24 MB), and beyond which they are joined.
BROADCAST_LINES = 1 << 19
#: Lines of more characters are compared one by one, as are pairs that few others of their length accompany.
BATCH_CHARS = 4096
BATCH_FEW = 12
#: Words of 64 bits of a batch's state, and of its table of letters.
BATCH_STATE = 4096
BATCH_TABLE = 4 << 20
#: Lines, and their characters, from which the groups that came are compared.
CHUNK_LINES = 1 << 15
CHUNK_BYTES = 16 << 20
#: Pairs that are held before they are compared.
PAIRS_HELD = 1 << 20
#: Multiplier of the words' hashes, its inverse modulo 2**64, a value for each byte, and a constant that parts the SimHash's halves.
_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_BYTES = np.array([xxhash.xxh64_intdigest(bytes([c]), 5) for c in range(256)], dtype=np.uint64)
_K = np.uint64(0x2545F4914F6CDD1D)
#: An odd multiplier for each table of min-hashes.
_ODD = [np.uint64(int.from_bytes(xxhash.xxh64_digest(bytes([k]), 3)) | 1) for k in range(TABLES)]
#: Bytes of words and line ends stay, all others become spaces.
_PLAIN = bytes(c if c >= 128 or c == 10 or bytes([c]).isalnum() else 32 for c in range(256))


def normal(line: str) -> str:
    """Lower-case words, joined by single spaces; ASCII characters other than letters and digits part words."""
    return b" ".join(line.lower().encode().translate(_PLAIN).split()).decode()


def trimmed(a: Sequence, b: Sequence) -> tuple[Sequence, Sequence]:
    """Both without what they share at the beginning, and then at the end; found by halving, as slices compare fast."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[len(a) - middle : len(a) - low] == b[len(b) - middle : len(b) - low] else (low, middle - 1)
    return a[: len(a) - low], b[: len(b) - low]


def distance(a: Sequence, b: Sequence, most: int) -> int:
    """Levenshtein distance of two texts or lists, or more than most if it is more (Myers 1999, on whole integers)."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return most + 1
    a, b = trimmed(a, b)
    if not a:
        return len(b)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    at: dict[object, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    plus, minus, score, shift = full, 0, len(a), len(b) - len(a)
    for j in range(0, len(b), 16):
        for y in b[j : j + 16]:
            eq = at.get(y, 0)
            vertical = eq | minus
            eq |= ((eq & plus) + plus) ^ plus
            up, down = minus | ~(eq | plus) & full, plus & eq
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up = (up << 1 | 1) & full
            down = down << 1 & full
            plus, minus = down | ~(vertical | up) & full, up & vertical
        # no distance falls along a diagonal, so that on the last one it bounds the whole from below
        if (i := j + 16 - shift) > 0 and j + 16 < len(b):
            mask = (1 << i) - 1
            if j + 16 + (plus & mask).bit_count() - (minus & mask).bit_count() > most:
                return most + 1
    return score


def edits(a: str, b: str, most: int) -> int | None:
    """A number of edits, at most `most`, that turn a into b; None if there is none.

    Bounds that are found sooner come first: what differs between a common beginning and end, words replaced one by one, and a
    distance in words, which bounds that in characters by the longest word and its space.
    """
    if abs(len(a) - len(b)) > most:
        return None
    a, b = trimmed(a, b)
    if (n := max(len(a), len(b))) <= most:
        return n
    one, two = a.split(" "), b.split(" ")
    if len(one) == len(two) and (n := sum(max(len(x), len(y)) for x, y in zip(one, two, strict=True) if x != y)) <= most:
        return n
    longest = 1 + max(map(len, one + two))
    if (few := most // longest) and (n := distance(one, two, few)) <= few:
        return n * longest
    return n if (n := distance(a, b, most)) <= most else None


def similar(a: str, b: str, least: float = SIMILARITY) -> bool:
    """Whether 1 - distance / longer length is at least `least`."""
    return edits(a, b, int((1 - least) * max(len(a), len(b)) + 1e-9)) is not None


def distances(patterns: np.ndarray, texts: np.ndarray, m: np.ndarray, n: np.ndarray, left: int, right: int) -> np.ndarray:
    """Levenshtein distances of pairs at once, of edits that go no more than left and right columns from the diagonal (Myers 1999 in blocks of 64 rows, Ukkonen's band).

    Rows of patterns have a multiple of 64 letters, of which the last m count, after as many zeros as texts have before their n;
    letters are small numbers. At each step the block k is one column behind the block k - 1, so that all blocks move on at once.
    """
    count, high = patterns.shape
    blocks, wide = high // 64, texts.shape[1]
    used = np.zeros(int(max(patterns.max(), texts.max())) + 1, dtype=bool)
    used[patterns] = True
    place = np.where(used, np.cumsum(used) - 1, used.sum())  # letters of no pattern share the last place
    letters = int(used.sum()) + 1
    row = np.arange(count) * letters
    table = np.zeros(count * letters * blocks, dtype=np.uint64)
    at = (row[:, None] + place[patterns]) * blocks + np.arange(high) // 64
    np.add.at(table, at.ravel(), np.tile(np.uint64(1) << (np.arange(high) % 64).astype(np.uint64), count))
    column = np.ascontiguousarray(((row[:, None] + place[texts]) * blocks).T)
    ks = np.arange(blocks)[:, None]
    plus, minus = np.full((blocks, count), ~np.uint64(0)), np.zeros((blocks, count), np.uint64)
    up, down = np.zeros((blocks + 1, count), np.uint64), np.zeros((blocks + 1, count), np.uint64)
    up[0] = 1
    eqs, ats, xs, ys, zs = (np.empty((blocks, count), kind) for kind in (np.uint64, np.int64, np.uint64, np.uint64, np.uint64))
    score, until = np.full(count, 64, dtype=np.int64), n + (high - m)
    one, top = np.uint64(1), np.uint64(63)
    low, end, sooner = 0, 1, int(until.min())
    for step in range(wide + blocks - 1):
        last, low = low, max(0, -((right + 63 - step) // 65), step - wide + 1)
        if end < min(blocks, step + 1, (step + left) // 65 + 1):
            score += 64 - up[end].view(np.int64) + down[end].view(np.int64)
            end += 1
        p, v, u, d, eq, to, x, y, z = (a[low:end] for a in (plus, minus, up, down, eqs, ats, xs, ys, zs))
        np.add(column[step - end + 1 : step - low + 1][::-1], ks[low:end], out=to)
        table.take(to, out=eq, mode="clip")
        np.bitwise_or(eq, v, out=x)
        np.bitwise_or(eq, d, out=eq)
        np.bitwise_and(eq, p, out=y)
        np.add(y, p, out=y)
        np.bitwise_xor(y, p, out=y)
        np.bitwise_or(y, eq, out=y)
        np.bitwise_or(y, p, out=z)
        np.invert(z, out=z)
        np.bitwise_or(z, v, out=z)  # rises along the rows
        np.bitwise_and(y, p, out=y)  # falls
        np.right_shift(z, top, out=eq)
        np.left_shift(z, one, out=z)
        np.bitwise_or(z, u, out=z)
        np.right_shift(y, top, out=v)
        np.left_shift(y, one, out=y)
        np.bitwise_or(y, d, out=y)
        up[low + 1 : end + 1] = eq
        down[low + 1 : end + 1] = v
        np.bitwise_or(x, z, out=p)
        np.invert(p, out=p)
        np.bitwise_or(p, y, out=p)
        np.bitwise_and(z, x, out=v)
        if low > last:
            up[low], down[low] = 1, 0  # above the band each column counts one more
        moved = up[end].view(np.int64) - down[end].view(np.int64)
        if end == blocks and step - blocks + 1 >= sooner:
            moved[step - blocks + 1 >= until] = 0
        score += moved
    return score


class Texts:
    """Texts whose pairs are compared many at once."""

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        self.sizes = np.array([len(x) for x in texts], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        used = np.zeros(0x110000, dtype=bool)
        used[codes] = True
        known = np.flatnonzero(used)
        letters = np.zeros(0x110000, dtype=np.int32)
        letters[known] = np.arange(1, len(known) + 1)
        self.codes = np.append(letters[codes], 0)
        self.alphabet, self.narrow = len(known), int((known < 0x250).sum())
        self.wide = np.maximum.reduceat(self.codes, self.starts) > self.narrow

    def letters(self, first: np.ndarray, size: np.ndarray, shift: np.ndarray, width: int) -> np.ndarray:
        """A row for each text from first on, of size letters after shift zeros; zeros follow."""
        at = np.arange(width) - shift[:, None]
        return np.where((at >= 0) & (at < size[:, None]), self.codes.take(first[:, None] + at, mode="clip"), 0)

    def shared(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many letters, most at most, are the same from the places a and b on, in steps of 1 or -1."""
        out, open_, done = np.zeros(len(a), dtype=np.int64), np.arange(len(a)), 0
        while len(open_):
            at = step * np.arange(done, done + 64)
            differ = self.codes.take(a[open_, None] + at, mode="clip") != self.codes.take(b[open_, None] + at, mode="clip")
            here = np.where(differ.any(axis=1), differ.argmax(axis=1), 64)
            out[open_] = np.minimum(done + here, most[open_])
            done += 64
            open_ = open_[(here == 64) & (done < most[open_])]
        return out

    def edits(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """For pairs of texts' numbers a number of edits, at most `most`, that turn one into the other; -1 if there is none."""
        out = np.full(len(a), -1, dtype=np.int64)
        a, b = np.where(self.sizes[a] <= self.sizes[b], a, b), np.where(self.sizes[a] <= self.sizes[b], b, a)
        m, n = self.sizes[a], self.sizes[b]
        alike = self.shared(self.starts[a], self.starts[b], m, 1)
        first, second, m, n = self.starts[a] + alike, self.starts[b] + alike, m - alike, n - alike
        alike = self.shared(first + m - 1, second + n - 1, m, -1)
        m, n = m - alike, n - alike
        out[n <= most] = n[n <= most]
        left = np.flatnonzero((n - m <= most) & (out < 0))
        wide = self.wide[a[left]] | self.wide[b[left]]
        order = np.lexsort((m[left], wide))
        left, wide = left[order], wide[order]
        while len(left):
            size, letters = int(m[left[0]]), (self.alphabet if wide[0] else self.narrow) + 2
            blocks = (size + size // 2 + 127) // 64
            fit = (m[left] <= 64 * blocks) & (wide == wide[0])
            count = int(fit.argmin()) if not fit.all() else len(left)
            count = max(1, min(count, BATCH_STATE // min(blocks, int(most[left[0]]) // 64 + 2), BATCH_TABLE // (letters * blocks)))
            some, left, wide = left[:count], left[count:], wide[count:]
            if size > BATCH_CHARS or count < BATCH_FEW:
                for k in some.tolist():
                    found = edits(self.texts[a[k]], self.texts[b[k]], int(most[k]))
                    out[k] = -1 if found is None else found
                continue
            high = -(-int(m[some].max()) // 64) * 64
            shift, more = high - m[some], n[some] - m[some]
            patterns, texts = self.letters(first[some], m[some], shift, high), self.letters(second[some], n[some], shift, int((n[some] + shift).max()))
            # a path of `most` edits that ends on another diagonal leaves neither by more
            found = distances(patterns, texts, m[some], n[some], int(((most[some] - more) // 2).max()), int(((most[some] + more) // 2).max()))
            out[some] = np.where(found <= most[some], found, -1)
        return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def min_hashes(tokens: np.ndarray, lengths: np.ndarray, starts: np.ndarray, tables: int = TABLES, shingle: int = SHINGLE) -> np.ndarray:
    """For each run of token hashes, beginning at starts, WIDTH bytes of the least hash of its shingles in each table.

    Shingles go on from the end of a run to its beginning, so that each token is in as many.
    """
    sizes = np.diff([*starts, len(tokens)])
    first, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    at = np.arange(len(tokens)) - first
    whole, length = tokens, lengths
    for k in range(1, shingle):
        there = first + (at + k) % size
        whole, length = mixed(whole * np.uint64(0x9E3779B97F4A7C15) + tokens[there]), length + lengths[there]
    last = np.where(length < LONG, np.uint64(0xFF << 56), np.uint64(0))
    out = np.empty((len(starts), tables), dtype="<u8")
    for k, odd in enumerate(_ODD[:tables]):
        x = whole * odd
        out[:, k] = np.minimum.reduceat((x ^ (x >> np.uint64(32))) | last, starts)
    return np.ascontiguousarray(out.view(np.uint8).reshape(len(starts), tables, 8)[:, :, :WIDTH]).reshape(len(starts), -1)


def sketches(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each run of token hashes the SimHash of its distinct tokens, of 128 bits in two columns."""
    most = 1 << 24
    if len(starts) > most:
        cut = starts[most]
        return np.concatenate([sketches(tokens[:cut], starts[:most]), sketches(tokens[cut:], starts[most:] - cut)])
    run = np.repeat(np.arange(len(starts), dtype=np.uint64), np.diff([*starts, len(tokens)])) << np.uint64(40)
    found = np.sort(run | tokens >> np.uint64(24))
    found = found[np.concatenate([[True], found[1:] != found[:-1]])]
    run = found >> np.uint64(40)
    firsts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    tokens = mixed(found << np.uint64(24))
    return np.stack([majorities(tokens, firsts), majorities(mixed(tokens + _K), firsts)], axis=1)


class LineHashes:
    """Per text the number, hash, length, SimHash and min-hashes of each line.

    Words of many texts are parted and hashed at once; a line's hash is that of its normal form. A line's features are its
    distinct words, so that frequent ones don't make all lines of a language alike. Lines of few words have pairs of characters
    instead, which parts unspaced scripts too. Min-hashes are those of word shingles, or of windows of characters in lines of few words; a
    line too short for FUZZY_WORDS and FUZZY_CHARS has none, and one that this object saw not long ago has none again.
    """

    def __init__(self, least_words: int, most: int = 1 << 17) -> None:
        self.least, self.most, self.met = max(1, least_words), most, set()
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            powers, inverses = (np.full(2 * n, x, dtype=np.uint64) for x in (_P, _INVERSE))
            powers[0] = inverses[0] = 1
            self.powers, self.inverses = np.multiply.accumulate(powers), np.multiply.accumulate(inverses)

    def words(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Beginnings, ends and hashes of the words of translated bytes that end in a line feed."""
        apart = (text == 32) | (text == 10)
        edge = np.flatnonzero(apart[1:] != apart[:-1]) + 1
        if not apart[0]:
            edge = np.concatenate([[0], edge])
        first, end = edge[::2], edge[1::2]
        self._grow(len(text) + 1)
        terms = _BYTES.take(text)
        terms *= self.powers[: len(text)]
        sums = np.add.reduceat(terms, edge)[::2] if len(edge) else np.zeros(0, np.uint64)  # the last edge is an end, and a line feed stands there
        return first, end, mixed(sums * self.inverses[first])

    def __call__(self, texts: list[str]) -> Iterator[list[tuple[int, int, int, int, int, bytes | None]]]:
        owner, *columns = self.columns(texts)
        rows = list(zip(*(x if isinstance(x, list) else x.tolist() for x in columns), strict=True))
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield rows[a:b]

    def columns(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
        """For each listed line its text's index, and its number, hash, length, the SimHash's halves and min-hashes."""
        if len(self.met) > self.most:
            self.met = set()
        raw = ("\n".join(texts) + "\n").lower().encode().translate(_PLAIN)
        text = np.frombuffer(raw, dtype=np.uint8)
        first, end, hashes = self.words(text)
        feeds = np.flatnonzero(text == 10)
        line = np.searchsorted(feeds, first)
        starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
        counts = np.diff([*starts, len(line)])
        # normal forms lie in one buffer, each word with one space behind it
        kept = text != 32
        kept[feeds] = False
        kept[end] = True
        plain = text[kept]
        plain[plain == 10] = 32
        plain = memoryview(plain.tobytes())
        within = np.flatnonzero((text & 0xC0) == 0x80)  # bytes that begin no character, all of them in words
        length = np.add.reduceat(end - first, starts) + counts if len(starts) else counts
        chars = length - 1 - np.searchsorted(within, end[starts + counts - 1]) + np.searchsorted(within, first[starts])
        stop = np.cumsum(length)
        begin, stop = (stop - length).tolist(), (stop - 1).tolist()
        listed, keys, sizes, long, runs, odd = [], [], [], [], [], []
        for k, (a, b, n, size) in enumerate(zip(begin, stop, counts.tolist(), chars.tolist(), strict=True)):
            if n < self.least:
                continue
            key = xxhash.xxh3_64_intdigest(plain[a:b])
            if key not in self.met:
                self.met.add(key)
                if n >= FUZZY_WORDS:
                    long.append(len(listed))
                    runs.append(k)
                elif size >= FUZZY_CHARS:
                    odd.append((len(listed), bytes(plain[a:b]).decode()))
            listed.append(k)
            keys.append(key)
            sizes.append(size)
        sims, mins = np.zeros((len(listed), 2), dtype=np.int64), [None] * len(listed)
        if long:
            mine = np.zeros(len(starts), dtype=bool)
            mine[runs] = True
            mine = np.repeat(mine, counts)
            begins = np.cumsum([0, *counts[runs][:-1]])
            self._sketch(long, hashes[mine], (end - first)[mine], begins, hashes[mine], begins, sims, mins)
        if odd:
            shingled, features = [], []
            for _, said in odd:
                width = 2 if 2 * sum(c > "\x7f" for c in said) > len(said) else 6
                shingled.append([said[i : i + width].encode() for i in range(len(said) - width + 1)])
                features.append([said[i : i + 2].encode() for i in range(len(said) - 1)])
            of = lambda lists: np.array([xxhash.xxh64_intdigest(x, 7) for xs in lists for x in xs], dtype=np.uint64)
            ends = lambda lists: np.cumsum([0, *(len(x) for x in lists[:-1])])
            self._sketch([i for i, _ in odd], of(shingled), np.array([len(x) for xs in shingled for x in xs]), ends(shingled), of(features), ends(features), sims, mins)
        number = line[starts[listed]] if listed else np.zeros(0, dtype=np.int64)
        begins = np.cumsum([0, *(said.count("\n") + 1 for said in texts)])
        owner = np.searchsorted(begins, number, side="right") - 1
        keys = np.array(keys, dtype=np.uint64).view(np.int64)
        return owner, number - begins[owner], keys, np.array(sizes, dtype=np.int64), sims[:, 0], sims[:, 1], mins

    @staticmethod
    def _sketch(places: list[int], tokens: np.ndarray, lengths: np.ndarray, starts: np.ndarray, features: np.ndarray, begins: np.ndarray, sims: np.ndarray, mins: list) -> None:
        sims[places] = sketches(features, begins)
        for i, m in zip(places, min_hashes(tokens, lengths, starts), strict=True):
            mins[i] = m.tobytes()


def occurrences(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, mark, line, lead, h, size, s, t, mins): mark is a hash of the text, line counts from 0, lead
    is the text's first line that is listed. s and t are the SimHash's halves. mins is null in lines that are too short, and where a task repeats a line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = LineHashes(least_words)

        def out(part: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            owner, line, h, size, s, t, mins = hashed.columns(texts)
            lead = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, dtype=bool)
            names = ["doc_id", "mark", "line", "lead", "h", "size", "s", "t", "mins"]
            return pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), part.column(1).take(pa.array(owner)), pa.array(line.astype(np.int32)), pa.array(lead), pa.array(h), pa.array(size.astype(np.int32)), pa.array(s), pa.array(t), pa.array(mins, pa.binary())], names=names)

        for batch in batches:
            texts, first, size = [], 0, 0
            for i, text in enumerate(batch.column(2)):
                texts.append(text.as_py())
                size += len(texts[-1])
                if size > 1 << 18:
                    yield out(batch.slice(first, len(texts)), texts)
                    texts, first, size = [], i + 1, 0
            if texts:
                yield out(batch.slice(first, len(texts)), texts)

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, mark long, line int, lead boolean, h long, size int, s long, t long, mins binary"
    bound_batches(docs.sparkSession)
    return docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(run, schema)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of the SimHashes of lines (size, s, t)."""
    return np.bitwise_count((a[..., 1:] ^ b[..., 1:]).view(np.uint64)).sum(axis=-1)  # of signed numbers it would count the absolute value's


class Near:
    """Which of two lines may be similar, by SimHash and length. Lines are rows of (size, s, t)."""

    def __init__(self, radius: int, similarity: float) -> None:
        self.radius, self.similarity = radius, similarity

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        near = differing(a, b) <= self.radius
        # a line can't be similar to one that is shorter by more than the edits allowed
        size, other = a[..., 0], b[..., 0]
        return near & (np.abs(size - other) <= (1 - self.similarity) * np.maximum(size, other) + 1e-9)


def near_pairs(lines: np.ndarray, group: np.ndarray, near: Near) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (i, j) of near lines of one group, group numbers being sorted."""
    first, second = [], []
    here = np.arange(len(lines))
    for offset in range(1, len(lines)):
        here = here[here + offset < len(lines)]
        here = here[group[here] == group[here + offset]]
        if not len(here):
            break
        found = here[near(lines[here], lines[here + offset])]
        first.append(found)
        second.append(found + offset)
    return (np.concatenate(first), np.concatenate(second)) if first else (here[:0], here[:0])


def spanned(lines: np.ndarray, near: Near) -> Iterator[np.ndarray]:
    """Index sets of the components of two and more near lines; each is compared once with those not yet reached."""
    left = np.arange(len(lines))
    while len(left):
        found, at, left = [left[:1]], 0, left[1:]
        while at < len(found):
            for i in found[at]:
                hit = near(lines[left], lines[i])
                if hit.any():
                    found.append(left[hit])
                    left = left[~hit]
            at += 1
        if len(found) > 1:
            yield np.concatenate(found)


GROUPS = pa.schema([("hot", pa.bool_()), ("key", pa.int64()), ("g", pa.int64()), ("h", pa.int64()), ("size", pa.int64()), ("s", pa.int64()), ("t", pa.int64())])


def _rows(hot: bool, key: np.ndarray | None, g: np.ndarray | None, h: np.ndarray, lines: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(h), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(h), hot)), none if key is None else pa.array(key), none if g is None else pa.array(g), pa.array(h), *(pa.array(x) for x in lines.T)], schema=GROUPS)


def _bucket_groups(near: Near, most: int | None):
    """Batches of (key, h, size, s, t), sorted by key, to rows (hot, key, g, h, size, s, t): the groups of near lines in each bucket, by a hash g of their members.

    The last four bits of a key are its table, which is what a group's rows have for a key. The lines of a bucket beyond `most` come back as they are, with hot set and repeated ones among them; else rows that repeat key and h count once.
    """

    def compare(key: np.ndarray, h: np.ndarray, lines: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole buckets."""
        same = key[1:] == key[:-1]
        met = np.concatenate([[False], same]) | np.concatenate([same, [False]])  # few buckets have more than one line
        key, h, lines = key[met], h[met], lines[met]
        if not len(key):
            return
        order = np.lexsort((h, key))
        key, h = key[order], h[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (h[1:] != h[:-1])])
        key, h, lines = key[new], h[new], lines[order[new]]
        number = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        sizes = np.bincount(number)
        groups = []
        for large in np.flatnonzero(sizes > PAIRS).tolist():
            mine = np.flatnonzero(number == large)
            groups += (mine[found] for found in spanned(lines[mine], near))
        small = np.flatnonzero((sizes[number] > 1) & (sizes[number] <= PAIRS))
        pairs = near_pairs(lines[small], number[small], near)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for i, j in zip(*(small[p].tolist() for p in pairs), strict=True):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
        members: dict[int, list[int]] = {}
        for i in root:
            members.setdefault(find(i), []).append(i)
        groups += (np.array(x) for x in members.values())
        if groups:
            names = [xxhash.xxh64_intdigest(np.sort(h[x]).tobytes()) for x in groups]
            all_ = np.concatenate(groups)
            yield _rows(False, key[all_] & 15, np.repeat(np.array(names, dtype=np.uint64).view(np.int64), [len(x) for x in groups]), h[all_], lines[all_])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 3), np.int64)
        hot = None  # the bucket that is passed through
        for batch in batches:
            key, h, size, s, t = (np.asarray(x) for x in batch.columns)
            key, h, lines = (np.concatenate(x) for x in zip(kept, (key, h, np.stack([size, s, t], axis=1)), strict=True))
            if hot is not None and (n := int((key == hot).sum())):
                yield _rows(True, key[:n], None, h[:n], lines[:n])
                key, h, lines = key[n:], h[n:], lines[n:]
            if len(key):
                hot = None
                bounds = np.array([0, *(np.flatnonzero(key[1:] != key[:-1]) + 1), len(key)])
                last = int(bounds[-1] - bounds[-2])
                if most is not None and (np.diff(bounds) > most).any():
                    keep = np.ones(len(key), dtype=bool)
                    for k in np.flatnonzero(np.diff(bounds) > most).tolist():
                        a, b = int(bounds[k]), int(bounds[k + 1])
                        yield _rows(True, key[a:b], None, h[a:b], lines[a:b])
                        keep[a:b] = False
                        if b == len(key):
                            hot, last = int(key[a]), 0
                    key, h, lines = key[keep], h[keep], lines[keep]
                whole = len(key) - last
                if whole:
                    yield from compare(key[:whole], h[:whole], lines[:whole])
                key, h, lines = key[whole:], h[whole:], lines[whole:]
            kept = (key, h, lines)
        if len(kept[0]):
            yield from compare(*kept)

    return run


def alike_groups(lines: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, bucket: int = BUCKET) -> DataFrame:
    """lines (h, size, s, t, mins; repeated or not) -> (g, h, tab): groups, and the first table of each, in which any two lines that agree on a min-hash and are near are found together.

    Buckets of more than `bucket` lines are dealt into parts by hash, and each pair of parts is a bucket of its own.
    """
    n = partitions(lines.sparkSession)
    near = Near(radius, similarity)
    schema = "hot boolean, key long, g long, h long, size long, s long, t long"
    name = lambda k, *columns: F.xxhash64(*columns).bitwiseAND(F.lit(-16)).bitwiseOR(k)
    names = F.array(*(name(F.lit(k), F.lit(k), F.substring("mins", WIDTH * k + 1, WIDTH)) for k in range(TABLES)))
    rows = lines.select(F.explode(names).alias("key"), "h", F.col("size").cast("long").alias("size"), "s", "t")
    found = written(rows.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_bucket_groups(near, bucket), schema), "groups")
    out = found.where("not hot").select("g", "key", "h")
    hot = found.where("hot").select("key", "h", "size", "s", "t").dropDuplicates(["key", "h"])
    parts = hot.groupBy("key").agg(F.greatest(F.lit(2), F.ceil(F.count(F.lit(1)) * 2 / bucket)).cast("int").alias("parts"))
    if parts.head(1):
        part = F.pmod(F.xxhash64("h"), F.col("parts")).cast("int")
        dealt = spread_join(hot, parts.withColumnRenamed("key", "p_key"), "key", "p_key").withColumn("a", part).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        dealt = dealt.where("a <> b").select(name(F.col("key").bitwiseAND(F.lit(15)), "key", F.least("a", "b"), F.greatest("a", "b")).alias("key"), "h", "size", "s", "t")
        dealt = dealt.repartition(n, "key").sortWithinPartitions("key")
        out = out.unionByName(dealt.mapInArrow(_bucket_groups(near, None), schema).select("g", "key", "h"))
    return out.groupBy("g", "h").agg(F.min("key").cast("int").alias("tab"))


def firsts(key: np.ndarray) -> np.ndarray:
    """Places where sorted values begin."""
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)


class Clusters:
    """Lines with those linked to them. Of each cluster one line is known, and edits within which all others are of it; distances obey the triangle inequality."""

    def __init__(self, sizes: np.ndarray) -> None:
        n = len(sizes)
        self.label = np.arange(n)  # the known line
        self.bound, self.reach, self.longest = np.zeros(n, np.int64), np.zeros(n, np.int64), sizes.copy()
        self.members: dict[int, list[int]] = {}

    def link(self, i: int, j: int, edits: int) -> None:
        a, b = int(self.label[i]), int(self.label[j])
        if a == b:
            return
        one, two = self.members.get(a) or [a], self.members.get(b) or [b]
        if len(one) < len(two):
            i, j, a, b, one, two = j, i, b, a, two, one
        self.bound[two] += int(self.bound[i]) + edits + int(self.bound[j])
        self.label[two] = a
        self.reach[a] = max(int(self.reach[a]), int(self.bound[two].max()))
        self.longest[a] = max(int(self.longest[a]), int(self.longest[b]))
        self.members[a] = one + two
        self.members.pop(b, None)


def linked(group: np.ndarray, tab: np.ndarray, lines: np.ndarray, mins: np.ndarray, said: list[str], near: Near, similarity: float) -> np.ndarray:
    """Lines (size, s, t) of whole groups, with sorted group numbers, their tables, min-hashes and texts -> for each the number of a line that all those have which
    links connect with it. Lines of a group link if they are near and their texts similar. A pair that agrees in an earlier table is compared there.

    In each round many pairs are compared that are not connected yet.
    """
    texts = Texts(said)
    sizes = texts.sizes
    clusters = Clusters(sizes)
    label = clusters.label
    allowed = lambda size: ((1 - similarity) * size + 1e-9).astype(np.int64)

    def rounds(i: np.ndarray, j: np.ndarray) -> None:
        order = np.lexsort((differing(lines[i], lines[j]), i))
        i, j, count = i[order], j[order], 0
        while len(i):
            count += 1
            if count == 1:  # each line with the nearest
                some = firsts(i)
            elif count == 2:  # each two clusters
                a, b = label[i], label[j]
                some = np.unique(np.minimum(a, b) * len(sizes) + np.maximum(a, b), return_index=True)[1]
            else:  # each line with each cluster
                key, some, of, many = np.unique(i * len(sizes) + label[j], return_index=True, return_inverse=True, return_counts=True)
                if count & (count + 1) == 0:
                    a, b = i[some], label[j[some]]
                    most = allowed(np.maximum(sizes[a], clusters.longest[b])) + clusters.reach[b]
                    look = np.flatnonzero((many > 2) & (most < np.maximum(sizes[a], sizes[b])))
                    far = np.zeros(len(some), dtype=bool)
                    far[look] = texts.edits(a[look], b[look], most[look]) < 0
                    stay = ~far[of]
                    i, j = i[stay], j[stay]
                    some = np.unique(i * len(sizes) + label[j], return_index=True)[1]
            a, b = i[some], j[some]
            found = texts.edits(a, b, allowed(np.maximum(sizes[a], sizes[b])))
            for x, y, n in zip(a[found >= 0].tolist(), b[found >= 0].tolist(), found[found >= 0].tolist(), strict=True):
                clusters.link(x, y, n)
            stay = label[i] != label[j]
            stay[some] = False
            i, j = i[stay], j[stay]

    first, second, held = [], [], 0
    here = np.arange(len(lines))
    for offset in range(1, len(lines)):
        here = here[: np.searchsorted(here, len(lines) - offset)]
        here = here[group[here] == group[here + offset]]
        if not len(here):
            break
        there = here + offset
        pick = near(lines[here], lines[there])
        for k in range(TABLES - 1):
            pick &= (mins[here, k] != mins[there, k]) | (tab[here] <= k)
        pick &= label[here] != label[there]
        first.append(there[pick])
        second.append(here[pick])
        held += int(pick.sum())
        if held > PAIRS_HELD:
            rounds(np.concatenate(first), np.concatenate(second))
            first, second, held = [], [], 0
    if held:
        rounds(np.concatenate(first), np.concatenate(second))
    return label


def _links(near: Near, similarity: float):
    """Batches of (g, tab, h, size, s, t, mins, said), sorted by (g, tab), to links (a, b) of lines; of m lines that are linked in one go there are m - 1."""

    def compare(table: pa.Table) -> pa.RecordBatch:
        g, tab, h, size, s, t = (table.column(k).to_numpy() for k in range(6))
        mins = np.frombuffer(b"".join(table.column(6).to_pylist()), dtype=np.uint8).reshape(len(h), -1, WIDTH)
        wide = np.zeros((*mins.shape[:2], 8), dtype=np.uint8)
        wide[:, :, :WIDTH] = mins
        group = np.cumsum(np.concatenate([[0], (g[1:] != g[:-1]) | (tab[1:] != tab[:-1])]))
        label = linked(group, tab, np.stack([size.astype(np.int64), s, t], axis=1), wide.view("<u8")[:, :, 0], table.column(7).to_pylist(), near, similarity)
        # a line that is in several groups connects them; each is linked with the smallest that it reaches here, which leaves few rounds to components()
        names, name = np.unique(h, return_inverse=True)
        least, before = np.arange(len(names)), None
        while before is None or (least != before).any():
            before, low = least.copy(), np.full(len(h), len(names))
            np.minimum.at(low, label, least[name])
            np.minimum.at(least, name, low[label])
        apart = least != np.arange(len(names))
        return pa.RecordBatch.from_arrays([pa.array(names[apart]), pa.array(names[least[apart]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if sum(x.num_rows for x in held) < CHUNK_LINES and size < CHUNK_BYTES:
                continue
            table = pa.Table.from_batches(held)
            g, tab = table.column(0).to_numpy(), table.column(1).to_numpy()
            whole = int(np.searchsorted(-((g == g[-1]) & (tab == tab[-1])).astype(np.int64)[::-1], 0))  # lines of the last group, which may go on
            whole = len(g) - whole
            if whole:
                yield compare(table.slice(0, whole))
                table = table.slice(whole)
            held, size = table.to_batches(), table.nbytes
        if held and (table := pa.Table.from_batches(held)).num_rows:
            yield compare(table)
        pa.default_memory_pool().release_unused()

    return run


def line_groups(docs: DataFrame, seen: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, bucket: int = BUCKET, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """(h, label): lines linked to others, and the smallest hash that they reach.

    Lines link if their edit similarity suffices; of such pairs those are found that agree on a min-hash and whose SimHashes are
    within the radius. Places of up to broadcast_lines lines are broadcast, more are joined.
    """
    n = partitions(docs.sparkSession)
    lines = seen.where("mins is not null").select("h", "size", "s", "t", "mins")
    groups = written(alike_groups(lines, radius, similarity, bucket), "near")
    places = written(groups.select("h").distinct(), "members")
    few = F.broadcast if places.count() <= broadcast_lines else lambda df: df
    told = F.first(F.when(F.col("mins").isNotNull(), F.struct("size", "s", "t", "mins")), ignorenulls=True).alias("told")
    first = seen.join(few(places), "h").groupBy("h").agg(F.min(F.struct("doc_id", "mark", "line")).alias("at"), told)
    first = written(first.select("h", "at", "told.*"), "first")
    wanted = first.groupBy("at.doc_id", "at.mark").agg(F.collect_list(F.struct("at.line", "h")).alias("wanted"))
    wanted = few(wanted.select(F.col("doc_id").alias("w_doc"), F.col("mark").alias("w_mark"), "wanted"))
    here = docs.where("text is not null").select("doc_id", "text")
    here = here.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_doc")) & (F.xxhash64("text") == F.col("w_mark"))).select("text", "wanted")

    def fetch(rows):
        for text, places in rows:
            said = text.split("\n")
            for p in places:
                yield p["h"], normal(said[p["line"]])

    texts = written(map_rows(here, fetch, "h long, said string").dropDuplicates(["h"]).join(first.drop("at"), "h"), "texts")
    rows = groups.join(texts, "h").repartition(max(1, n // 4), "g").sortWithinPartitions("g", "tab", "h").select("g", "tab", "h", "size", "s", "t", "mins", "said")
    label = components(rows.mapInArrow(_links(Near(radius, similarity), similarity), "a long, b long"))
    out = written(label.select(F.col("node").alias("h"), "label"), "labels")
    forget(groups, places, first, texts)
    return out


def repeated_lines(docs: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS, bucket: int = BUCKET, broadcast_lines: int = BROADCAST_LINES) -> tuple[DataFrame, bool]:
    """docs (doc_id, text) -> (doc_id, mark, gone), the numbers of the lines to remove from the text with that hash; and whether
    any row repeats both doc_id and text."""
    seen = written(occurrences(docs, least_words), "seen")
    twice = bool(seen.where("lead").groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").head(1))
    linked = line_groups(docs, seen, radius, similarity, bucket, broadcast_lines)
    place = F.struct("doc_id", "mark", "line")
    lines = seen.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    again = lines.join(linked.withColumnRenamed("h", "l_h"), F.col("h") == F.col("l_h"), "left").where("n > 1 or label is not null")
    again = written(again.select("h", "first", F.coalesce("label", "h").alias("label")), "again")
    keep = again.groupBy(F.col("label").alias("k_label")).agg(F.min("first").alias("keep"))
    rule = spread_join(again.select("h", "label"), keep, "label", "k_label").select("h", "keep")  # a label may have many lines
    if again.count() <= broadcast_lines:
        rule = F.broadcast(rule)
    gone = seen.select("doc_id", "mark", "line", "h").join(rule, "h").where(~place.eqNullSafe(F.col("keep")))
    return gone.groupBy("doc_id", "mark").agg(F.collect_set("line").alias("gone")), twice


def deduplicated(docs: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS, bucket: int = BUCKET, broadcast_lines: int = BROADCAST_LINES, counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """docs (doc_id, text, ...) with text without the lines that repeat, and n_lines and n_removed (long), which `counts` names.

    Lines are parted by U+000A. A line of at least least_words words stays only at the first place of its connected group, by
    doc_id (null first), hash of the text and line number; lines without a word stay. Lines link if their normal forms are equal, or,
    from FUZZY_WORDS words or FUZZY_CHARS characters on, if their edit similarity is at least `similarity` and they are found as
    candidates (see line_groups). Null texts stay null and have no lines; empty ones have one, which stays. An empty table gives an
    empty one. Of rows that repeat doc_id and text one loses its repeated lines, the others all their lines that have a word, as
    those repeat that one's. Columns of docs that have a name of `counts` are replaced.
    """
    names = [c for c in docs.columns if c not in counts]
    gone, twice = repeated_lines(docs.select("doc_id", "text"), radius, similarity, least_words, bucket, broadcast_lines)
    gone = gone.select(F.col("doc_id").alias("__doc"), F.col("mark").alias("__mark"), F.col("gone").alias("__gone"))
    rows = docs.select(*names).join(gone, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__mark")), "left").select(*names, "__gone")
    copy = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(0))) if twice else F.lit(1)
    rows = rows.withColumn("__copy", copy)
    at = names.index("text")

    def run(found):
        for row in found:
            text, numbers, copy = row[at], row[-2], row[-1]
            if text is None:
                yield (*row[:-2], 0, 0)
                continue
            if not numbers and copy == 1:
                yield (*row[:-2], text.count("\n") + 1, 0)
                continue
            said = text.split("\n")
            drop = set(numbers or ()) if copy == 1 else {i for i, x in enumerate(said) if len(normal(x).split()) >= max(1, least_words)}
            left = "\n".join(x for i, x in enumerate(said) if i not in drop)
            yield (*row[:at], left, *row[at + 1 : -2], len(said), len(drop))

    return map_rows(rows, run, rows.drop("__gone", "__copy").withColumns({c: F.lit(0).cast("long") for c in counts}).schema)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that repeat: doc_id, text, n_lines, n_removed; a row for each."""
    return deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
