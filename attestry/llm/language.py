"""Language identification by compression.

For each language a zstandard dictionary of raw content is filled with texts of a bounded sample. A text is reduced to
lower-case letters and spaces and cut into pieces, all of it, and each piece is compressed against every dictionary: the language whose dictionary leaves the fewest bytes is
chosen, the margin to the next is the score, and a narrow margin rejects the text. Nothing is shuffled but the sample; the dictionaries go
to the workers, a block of languages at a time.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestry.llm.common import grouped, map_rows, partitions, table

#: Bounds of what is learned from for each language: texts, characters of a text, bytes of a dictionary.
SAMPLE_TEXTS = 96
SAMPLE_CHARS = 16_384
DICTIONARY_BYTES = 112_640
#: Languages whose compressors a worker holds at once; of more, one worker after another takes its block of a row's languages.
BLOCK = 64
#: Bytes of a piece, and zstandard's level.
PIECE = 2048
LEVEL = 9
#: Margin below which a text is rejected.
LEAST_MARGIN = 0.02
UNKNOWN = "und"
_NOISE = re.compile(r"[\W\d_]+")
#: Beyond ASCII, where marks belong to words in many scripts.
_WIDE_NOISE = regex.compile(r"[^\p{L}\p{M}]+")


def plain(text: str) -> bytes:
    """Lower case, with a space for each run of characters other than letters and their marks."""
    low = text.lower()
    return (_NOISE if low.isascii() else _WIDE_NOISE).sub(" ", low).encode()


def remainder(id_col: str = "doc_id", by: int = 4):
    """Column: crc32 of the id as text, modulo by. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % by


def learn(labelled: DataFrame) -> list[tuple[str, bytes]]:
    """labelled (text, lang, ...) -> (language, dictionary), the language with the most rows first, ties by name.

    Rows with a null text or language, or without a letter, teach nothing; any other language has a dictionary. The sample is the
    SAMPLE_TEXTS texts of a language with the smallest hashes, ties by text, so that it depends on texts alone; of a text longer than
    SAMPLE_CHARS it has a window of that length, which begins where another hash says. An empty table gives no languages.
    """
    spark = labelled.sparkSession
    rows = labelled.select("text", "lang").where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    at = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.char_length("text") - SAMPLE_CHARS + 1, F.lit(1)).cast("long")).cast("int")
    window = F.substring("text", at + 1, F.lit(SAMPLE_CHARS))
    # a window without a letter would teach nothing
    rows = rows.select("lang", F.xxhash64("text").alias("hash"), F.when(window.rlike(r"\p{L}"), window).otherwise(F.regexp_extract("text", rf"\p{{L}}[\s\S]{{0,{SAMPLE_CHARS - 1}}}", 0)).alias("text"))
    sample = rows.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("hash", "text"))).where(F.col("k") <= SAMPLE_TEXTS)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language

    def fill(found):
        for (lang,), texts in grouped(found, 1):
            held = bytearray()
            for _, _, text in texts:
                if len(held) < DICTIONARY_BYTES:
                    held += plain(text) + b"\n"
            yield lang, bytes(held[:DICTIONARY_BYTES])

    ready = sample.select("lang", "k", "text").repartition(partitions(spark), "lang").sortWithinPartitions("lang", "k")
    made = map_rows(ready, fill, "lang string, held binary").collect()  # DICTIONARY_BYTES for each language
    return sorted(((r["lang"], bytes(r["held"])) for r in made), key=lambda x: (-counts[x[0]], x[0]))


class Classifier:
    """Compressors of each language; made on the worker, as they can't be sent."""

    def __init__(self, dictionaries: Sequence[tuple[str, bytes]]) -> None:
        self.languages = [lang for lang, _ in dictionaries]
        self.compressors = []
        for _, content in dictionaries:
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: bytes) -> list[int]:
        pieces = [text[i : i + PIECE] for i in range(0, len(text), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]

    def __call__(self, text: bytes | None, best: tuple[str, int, int] | None = None) -> tuple[str, int, int] | None:
        """Language, its size and that of the next, of this block's languages and best's; None for a null text or one without letters."""
        said = (text or b"").decode(errors="replace")
        if not self.languages or not any(map(str.isalpha, said)):
            return best
        sizes = self.sizes(plain(said))
        first = min(range(len(sizes)), key=sizes.__getitem__)
        rest = [s for i, s in enumerate(sizes) if i != first]
        if best is None:
            return self.languages[first], sizes[first], min(rest, default=-1)
        lang, size, after = best
        if sizes[first] < size:  # the earlier language wins a tie
            return self.languages[first], sizes[first], min([size, *rest])
        return lang, size, min(x for x in (after, sizes[first]) if x >= 0)


def margin(found: tuple[str, int, int] | None) -> tuple[str, float]:
    """Language and score: how much smaller the best size is than the next; und and 0 if nothing was found, 1 for the only language."""
    if found is None:
        return UNKNOWN, 0.0
    lang, best, after = found
    return lang, 1 - best / after if after > 0 else 1.0


def classified(docs: DataFrame, dictionaries: list[tuple[str, bytes]], text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score"), block: int = BLOCK) -> DataFrame:
    """docs with two more columns, the language and its margin, which `names` names; a column of docs with one of these names is replaced.

    Every row stays, empty, null and repeated ones too; und and 0 for a null text, one without letters, or without languages. Of
    languages that leave as many bytes the first listed is chosen, with margin 0. Other columns pass through unread. An empty table gives an empty one.
    """
    kept = [c for c in docs.columns if c not in names]
    rows = docs.select(*kept)
    at = kept.index(text_col)
    end = len(kept)
    schema = rows.withColumns({"__lang": F.lit(None).cast("string"), "__best": F.lit(None).cast("long"), "__next": F.lit(None).cast("long")}).schema
    last = rows.withColumns({names[0]: F.lit(""), names[1]: F.lit(0.0)}).schema
    blocks = [dictionaries[i : i + block] for i in range(0, len(dictionaries), block)] or [[]]
    for k, part in enumerate(blocks):
        shared = docs.sparkSession.sparkContext.broadcast(part)  # `block` dictionaries of DICTIONARY_BYTES at most

        def run(found, k=k, shared=shared):
            classify = Classifier(shared.value)
            for row in found:
                best = None if not k or row[end] is None else (row[end].decode() if isinstance(row[end], bytes) else row[end], row[end + 1], row[end + 2])
                best = classify(row[at], best)
                says = margin(best) if k == len(blocks) - 1 else best or (None, None, None)
                yield (*(x.decode() if i == at and x is not None else x for i, x in enumerate(row[:end])), *says)

        rows = map_rows(rows, run, last if k == len(blocks) - 1 else schema, binary=(text_col,))
    return rows


def rejected(lang: str = "lang_pred", score: str = "score"):
    """Column: whether the text has no language, or one by too narrow a margin."""
    return (F.col(lang) == UNKNOWN) | (F.col(score) < LEAST_MARGIN)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, learned from those with crc32(doc_id) mod 4 other than 2, and whether its margin rejects it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    dictionaries = learn(docs.where(remainder() != 2).select("text", "lang"))
    found = classified(docs.select("doc_id", (remainder() == 2).alias("held_out"), "text"), dictionaries)
    return found.select("doc_id", "held_out", "lang_pred", "score", rejected().alias("rejected"))
