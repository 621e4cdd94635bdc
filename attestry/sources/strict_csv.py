"""Strict CSV: bytes are checked before any record is believed. Spark's reader mends what this one must report."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestry.operators import diagnostics

#: One field and what ends it: quoted with doubled quotes, or bare without quotes; a comma, CRLF or the end.
_FIELD = re.compile(r'(?:"((?:[^"\r\n]|"")*)"|([^",\r\n]*))(,|\r\n|\Z)')
FILE_CODES = {
    "bom": ("encoding", "the file must be UTF-8 without a byte order mark"),
    "invalid_utf8": ("encoding", "the file must be valid UTF-8"),
    "nul": ("bytes", "the file must not contain NUL"),
    "missing_final_crlf": ("newlines", "the last record must end in CRLF"),
    "non_crlf": ("newlines", "records must end in CRLF"),
    "control_character": ("fields", "fields must not contain control characters"),
    "embedded_newline": ("fields", "fields must not contain line ends"),
    "invalid_quote_escape": ("quoting", "quotes in quoted fields must be doubled"),
    "bare_quote": ("quoting", "quotes are allowed only around fields"),
    "unclosed_quote": ("quoting", "a quoted field is not closed"),
    "header_mismatch": ("header", "the header must match the columns and their order"),
    "missing_data": ("records", "there must be a record"),
}


def structure_problem(text: str) -> str | None:
    """Code of the first structural fault of the text, by fields."""
    at = 0
    while at < len(text):
        m = _FIELD.match(text, at)
        if m and m.end() > at:
            body = m.group(1) or m.group(2) or ""
            if any(unicodedata.category(c)[0] == "C" and c != "\0" for c in body):
                return "control_character"
            at = m.end()
            continue
        if text[at] == '"':
            inside = re.compile(r'(?:[^"\r\n]|"")*').match(text, at + 1)
            if any(unicodedata.category(c)[0] == "C" and c != "\0" for c in inside.group()):
                return "control_character"
            after = text[inside.end() : inside.end() + 1]
            return "unclosed_quote" if not after else "invalid_quote_escape" if after == '"' else "embedded_newline"
        bare = re.compile(r'[^",\r\n]*').match(text, at)
        if any(unicodedata.category(c)[0] == "C" and c != "\0" for c in bare.group()):
            return "control_character"
        if text[bare.end() : bare.end() + 1] == '"':
            return "bare_quote"
        at = bare.end() + 1  # a line end that isn't CRLF has its own code
    return None


def records(text: str) -> Iterator[list[str]]:
    """Records of a text without structural faults; a blank line is an empty record."""
    row: list[str] = []
    at = 0
    while at < len(text):
        m = _FIELD.match(text, at)
        row.append(m.group(2) if m.group(1) is None else m.group(1).replace('""', '"'))
        at = m.end()
        if m.group(3) != ",":
            yield [] if row == [""] and m.group(1) is None else row
            row = []


def parse(content: bytes, header: Sequence[str]) -> tuple[list[str], list[list[str]]]:
    """Codes of all faults of the file, or else its records."""
    codes = ["bom"] if content.startswith(b"\xef\xbb\xbf") else []
    try:
        text = content.decode()
    except UnicodeDecodeError:
        return [*codes, "invalid_utf8"], []
    if "\0" in text:
        codes.append("nul")
    if not text.endswith("\r\n"):
        codes.append("missing_final_crlf")
    if re.search(r"\r(?!\n)|(?<!\r)\n", text):
        codes.append("non_crlf")
    if code := structure_problem(text):
        codes.append(code)
    if codes:
        return codes, []
    if not text.startswith(",".join(header) + "\r\n"):
        return ["header_mismatch"], []
    rows = list(records(text))[1:]
    return ([], rows) if any(rows) else (["missing_data"], [])


def read_strict_csv(spark: SparkSession, path: str, header: Sequence[str]) -> DataFrame:
    """(source, lineage, code, record_number, fields): a row for each record or file fault, files in parallel, records numbered from 1.

    Records may have any number of fields; column_rules() reports those that don't match the header. lineage is the file's SHA-256.
    """
    header = tuple(header)

    @F.udtf(returnType="code string, record_number long, fields array<string>")
    class Scan:
        def eval(self, content: bytes):
            codes, rows = parse(bytes(content), header)
            for code in codes:
                yield code, None, None
            for i, row in enumerate(rows, start=1):
                yield None, i, row

    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "[^/]*$", 0).alias("source"), F.sha2("content", 256).alias("lineage"), "content")
    return files.lateralJoin(Scan(F.col("content").outer())).drop("content")


def file_faults(scanned: DataFrame) -> DataFrame:
    """Diagnostics of location `file`."""
    table = F.create_map(*(F.lit(x) for code, (field, _) in FILE_CODES.items() for x in (code, field)))
    said = F.create_map(*(F.lit(x) for code, (_, message) in FILE_CODES.items() for x in (code, message)))
    return scanned.where("code is not null").select(F.lit("file").alias("location"), table[F.col("code")].alias("field"), "code", said[F.col("code")].alias("message"), F.lit(None).cast("long").alias("record_number"))


def as_columns(scanned: DataFrame, header: Sequence[str], nullable: Sequence[str] = ()) -> DataFrame:
    """Records as columns; empty text is null in nullable ones. Records of another width have nulls and n_fields to tell."""
    wide = F.size("fields") == len(header)
    value = lambda i, c: F.nullif(F.get("fields", i), F.lit("")) if c in nullable else F.get("fields", i)
    return scanned.where("code is null").select("source", "lineage", "record_number", F.size("fields").alias("n_fields"), *(F.when(wide, value(i, c)).alias(c) for i, c in enumerate(header)))


def load(spark: SparkSession, path: str, header: Sequence[str], nullable: Sequence[str] = ()) -> DataFrame:
    """as_columns() of files without faults; raises DiagnosticsError for file faults and records of a wrong width."""
    scanned = read_strict_csv(spark, path, header)
    rows = as_columns(scanned, header, nullable)
    width = rows.where(F.col("n_fields") != len(header)).select(
        F.lit("row").alias("location"), F.lit("record").alias("field"), F.when(F.col("n_fields") == 0, "blank_record").otherwise("column_count").alias("code"), F.lit("the record must have the header's columns").alias("message"), "record_number"
    )
    diagnostics.raise_if_any(file_faults(scanned).unionByName(width), ())
    return rows.drop("n_fields")


def schema_of(header: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in header])
