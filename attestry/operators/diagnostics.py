"""Diagnostics: rules over rows, in one fixed order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.errors import DiagnosticsError
from attestry.operators.ordering import numbered

LOCATIONS = ("metadata", "file", "row")
SCHEMA = "location string, field string, code string, message string, record_number long"


def violations(rows: DataFrame, rules: Mapping[tuple[str, str], tuple[Column, str]], record: str, location: str = "row") -> DataFrame:
    """One row for each (field, code) whose condition is true, in one pass over rows.

    rules: (field, code) to (condition, message).
    """
    found = [F.when(bad, F.struct(F.lit(field).alias("field"), F.lit(code).alias("code"), F.lit(message).alias("message"))) for (field, code), (bad, message) in rules.items()]
    out = rows.select(F.col(record).cast("long").alias("record_number"), F.explode(F.array_compact(F.array(*found))).alias("d"))
    return out.select(F.lit(location).alias("location"), "d.field", "d.code", "d.message", "record_number")


def ordered(diagnostics: DataFrame, fields: Sequence[str]) -> DataFrame:
    """diagnostics with sort keys: metadata, file, rows; then the record, the field in the header's order (others first, and a file's all alike), the code."""
    place = reduce(lambda c, i: c.when(F.col("location") == LOCATIONS[i], i), range(1, len(LOCATIONS)), F.when(F.col("location") == LOCATIONS[0], 0)).otherwise(len(LOCATIONS))
    at = F.array_position(F.array(*(F.lit(f) for f in fields)), F.col("field"))
    return diagnostics.withColumns({"location_rank": place, "record_rank": F.coalesce("record_number", F.lit(0)), "field_rank": F.when((F.col("location") != "file") & (at > 0), at).otherwise(0).cast("int")})


def raise_if_any(diagnostics: DataFrame, fields: Sequence[str], most: int = 1000) -> None:
    """Raises DiagnosticsError for any diagnostics: the first `most` of them, in order, are in its message, and all in its frame."""
    found = diagnostics.persist()
    if count := found.count():
        rows = ordered(found, fields).orderBy("location_rank", "record_rank", "field_rank", "field", "code").limit(most).collect()
        raise DiagnosticsError([{k: r[k] for k in ("location", "field", "code", "message", "record_number")} for r in rows], count, found)
    found.unpersist()


def positioned(diagnostics: DataFrame, fields: Sequence[str]) -> DataFrame:
    """ordered() with position, from 1 to n over all, without bringing them together in a task."""
    return numbered(ordered(diagnostics, fields), "position", "location_rank", "record_rank", "field_rank", "field", "code")
