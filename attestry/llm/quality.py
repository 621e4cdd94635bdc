"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Counts come from array expressions over the words and lines of the whole text; the text is never exploded and nothing is
shuffled. Each rule is a ratio of counts with a lowest and a highest value, and the verdict is their conjunction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm.common import table, words_of

#: Words of a repeated window.
WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the languages that a corpus is expected in.
STOP_WORDS = tuple(
    "the of and to in a is that it for on was as with be by this are or an at from "  # English
    "der die und das den von zu mit sich des ist im dem nicht ein eine als auch es für "  # German
    "de la le et les des en un du une que est dans qui par pour au il sur plus "  # French
    "el y los del se las con una su al lo como más pero sus no para por"  # Spanish
    .split()
)
#: name, numerator, denominator (None: 1), lowest, highest. A null bound is open; a denominator of 0 makes the ratio 0.
RULES: tuple[tuple[str, str, str | None, float | None, float | None], ...] = (
    ("words", "n_words", None, 10, None),
    ("mean_word_chars", "word_chars", "n_words", 2.0, 12.0),
    ("symbols_per_word", "n_symbols", "n_words", None, 0.2),
    ("stop_words_per_word", "n_stop_words", "n_words", 0.02, None),
    ("repeated_lines", "n_dup_lines", "n_lines", None, 0.4),
    ("repeated_words", "n_repeat_words", "n_words", None, 0.2),
    ("longest_word", "longest_word", None, None, 200),
)


def let(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda's variable, where a repeated expression would be computed again."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, n_words: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows that occur twice or more.

    Hashes of the windows tell most texts apart without repeats. Only the others sort their windows, as text, with positions:
    equal neighbours are repeats, and each next position adds as many words as it lies behind the one before, at most a window.
    """

    def at(i: Column, offset: int) -> Column:
        return F.get(words, i + offset)

    spots = F.sequence(F.lit(0), n_words - window)
    hashes = F.transform(spots, lambda i: F.xxhash64(*(at(i, k) for k in range(window))))
    spelled = F.sort_array(F.transform(spots, lambda i: F.struct(F.concat_ws(" ", *(at(i, k) for k in range(window))).alias("w"), i.alias("i"))))
    twice = lambda e: F.filter(e, lambda x, k: (F.get(e, k - 1)["w"] == x["w"]) | (F.get(e, k + 1)["w"] == x["w"]))
    found = let(spelled, lambda e: F.sort_array(F.transform(twice(e), lambda x: x["i"])))
    covered = F.aggregate(
        found, F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(window), i - acc["last"])).alias("n")), lambda acc: acc["n"],
    )
    some = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(n_words <= window, 0).when(some, covered).otherwise(0).cast("long")


def measured(docs: DataFrame, text_col: str = "text", stop_words: Sequence[str] = STOP_WORDS, window: int = WINDOW) -> DataFrame:
    """docs with a struct column `quality` of counts. Null text counts as empty; names of docs don't clash with it unless they are `quality`.

    A line counts if it has a word; n_dup_lines are lines equal to an earlier one. Stop words count after lower-casing and
    without ASCII punctuation at the ends.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    spaced = words_of(text_col)
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, " \t\x0b\f\r", "") != "")
    rows = docs.withColumn("__words", F.array_remove(F.split(spaced, " "), "")).withColumn("__lines", lines)
    words, n = F.col("__words"), F.size("__words")
    chars = F.char_length(F.translate(spaced, " ", ""))
    padded = F.split(F.translate(F.lower(spaced), ".,;:!?\"'()", " " * 10), " ")
    return rows.select(
        *docs.columns,
        F.struct(
            n.cast("long").alias("n_words"), chars.cast("long").alias("word_chars"),
            (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size("__lines").cast("long").alias("n_lines"), (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
            repeated_words(words, n, window).alias("n_repeat_words"),
            F.size(F.filter(padded, lambda w: w.isin(*dict.fromkeys(stop_words)))).cast("long").alias("n_stop_words"),
            F.coalesce(F.array_max(F.transform(words, F.char_length)), F.lit(0)).cast("long").alias("longest_word"),
        ).alias("quality"),
    )


def verdict(quality: Column, rules=RULES) -> dict[str, Column]:
    """For each rule whether it holds, from the struct of measured()."""

    def holds(over: str, under: str | None, low: float | None, high: float | None) -> Column:
        ratio = quality[over].cast("double") if under is None else F.when(quality[under] > 0, quality[over] / quality[under]).otherwise(0.0)
        test = F.lit(True)
        if low is not None:
            test = test & (ratio >= low)
        if high is not None:
            test = test & (ratio <= high)
        return test

    return {name: holds(*rest) for name, *rest in rules}


def judged(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """docs with `quality` (counts) and `failed`, the names of the rules that don't hold."""
    rows = measured(docs, text_col)
    tests = verdict(F.col("quality"), rules)
    failed = F.array_compact(F.array(*(F.when(~test, F.lit(name)) for name, test in tests.items())))
    return rows.withColumn("failed", failed)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and verdict of each document; a row for each."""
    rows = judged(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    q = F.col("quality")
    base = (q["n_words"] < 10) | (100 * q["n_repeat_words"] > 20 * q["n_words"])
    return rows.select("doc_id", *(q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), base.alias("base_failed"), (~base & (F.size("failed") == 0)).alias("kept"))


def oracle(rules=RULES, stop_words: Sequence[str] = STOP_WORDS) -> str:
    """DuckDB SQL for op2_quality_rules, from the same table of thresholds."""
    tests = []
    for _, over, under, low, high in rules:
        ratio = over if under is None else f"case when {under} > 0 then {over} / {under} else 0 end"
        tests += [f"({ratio}) >= {low}"] if low is not None else []
        tests += [f"({ratio}) <= {high}"] if high is not None else []
    listed = ", ".join(f"'{w}'" for w in dict.fromkeys(stop_words))
    return f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
s as (select *, translate(t, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     ') as spaced from d),
w as (select *, list_filter(string_split(spaced, ' '), lambda x: x <> '') as words,
  list_filter(string_split(t, chr(10)), lambda x: translate(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13), '') <> '') as lines from s),
spots as (select r, unnest(range(1, len(words) - {WINDOW - 2})) as i, words from w where len(words) >= {WINDOW}),
windows as (select r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') as said from spots),
twice as (select r, i from windows qualify count(*) over (partition by r, said) > 1),
covered as (select r, count(distinct i + k) as n from twice, range(0, {WINDOW}) as x(k) group by r),
q as (select doc_id, len(words) as n_words, len(replace(spaced, ' ', '')) as word_chars, len(t) - len(translate(t, '{SYMBOLS}', '')) as n_symbols,
  len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words,
  len(list_filter(string_split(translate(lower(spaced), '.,;:!?"' || chr(39) || '()', '          '), ' '), lambda x: x in ({listed}))) as n_stop_words,
  coalesce(list_max(list_transform(words, lambda x: len(x))), 0) as longest_word
  from w left join covered using (r)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from q)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
  cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed, not base_failed and {" and ".join(tests)} as kept
from b
"""


ORACLE = oracle()
