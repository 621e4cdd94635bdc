"""From raw documents to a training mix: language, lines, near-duplicates, benchmark leaks, source weights.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again for the next one. All but the
last return the columns of documents. Rows that repeat a doc_id are documents of their own where a stage doesn't say otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm import decontamination, language, lines, mixing, simhash
from attestry.llm.common import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is found by a clear margin; texts without a letter, or null, go. lang becomes what was found.

    An empty table, and one without any language to learn, give an empty one.
    """
    dictionaries = language.learn(docs.where(language.remainder() != 2).select("text", "lang"))
    found = language.classified(docs, dictionaries, names=("__lang_pred", "__margin"))
    kept = found.where(~language.rejected("__lang_pred", "__margin"))
    return kept.withColumn("lang", F.col("__lang_pred")).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that repeat, exactly or nearly, from all texts but the first; no document goes. n_chars follows the text. An empty table stays empty."""
    found = lines.deduplicated(docs, counts=("__n_lines", "__n_removed"))
    return found.withColumn("n_chars", F.when(F.col("__n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near-duplicates the document with the smallest doc_id.

    Rows with a null doc_id stay, as they can't be named; of rows that repeat a kept doc_id all stay.
    """
    found = simhash.near_duplicates(docs)
    gone = written(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark, as a copy or a paraphrase. Rows with a null doc_id stay."""
    leaked = written(decontamination.leaks(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "leaked")
    return docs.join(leaked, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, by source weights."""
    return mixing.mix_report(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: The compression, the decomposition and the edit similarities have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir, each written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
