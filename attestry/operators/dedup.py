"""Ordered exact deduplication with a trail of occurrences."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.errors import CollisionError
from attestry.operators.ordering import with_previous


class Deduplicated(NamedTuple):
    """unique: first row of each fingerprint. occurrences: every row, with the position of its representative."""

    unique: DataFrame
    occurrences: DataFrame


def collisions(rows: DataFrame, fingerprint: str = "fingerprint", payload: str = "payload") -> DataFrame:
    """Fingerprints that stand for different payloads; an aggregation with map-side combining."""
    return rows.groupBy(fingerprint).agg(F.min(payload).alias("low"), F.max(payload).alias("high"), F.count(F.lit(1)).alias("n_rows")).where("low <> high").select(fingerprint, "n_rows")


def first_positions(rows: DataFrame, fingerprint: str = "fingerprint", position: str = "input_position") -> DataFrame:
    return rows.groupBy(fingerprint).agg(F.min(position).alias("representative_position"), F.count(F.lit(1)).alias("n_occurrences"))


def deduplicate(rows: DataFrame, fingerprint: str = "fingerprint", payload: str | None = "payload", position: str = "input_position", check: bool = True) -> Deduplicated:
    """rows with a unique position each. Raises CollisionError if equal fingerprints have different payloads.

    Representatives come from an aggregation and a join, not from a window over each fingerprint: a fingerprint that a third
    of all rows share is combined before the shuffle, and adaptive execution splits its side of the join.
    """
    if check and payload and (found := collisions(rows, fingerprint, payload).limit(5).collect()):
        raise CollisionError(f"equal fingerprints for different payloads: {', '.join(r[0] for r in found)}")
    first = first_positions(rows, fingerprint, position)
    trail = rows.join(first, fingerprint)
    return Deduplicated(trail.where(F.col(position) == F.col("representative_position")).drop("representative_position"), trail.drop("n_occurrences", *([payload] if payload else [])))


def run_counts(rows: DataFrame, fingerprint: str = "fingerprint") -> DataFrame:
    """Physical, unique and duplicate rows."""
    per = rows.groupBy(fingerprint).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("physical"), F.count(F.lit(1)).alias("unique")).withColumn("duplicate", F.col("physical") - F.col("unique"))


def position_gaps(rows: DataFrame, position: str, *keys: str) -> DataFrame:
    """Groups whose positions are not exactly 1 to n, by counts alone."""
    per = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.min(position).alias("low"), F.max(position).alias("high"), F.count_distinct(position).alias("n_positions"))
    return per.where((F.col("low") != 1) | (F.col("high") != F.col("n_rows")) | (F.col("n_positions") != F.col("n_rows")))


def out_of_order(unique: DataFrame, order: str, first: str) -> DataFrame:
    """Rows whose first position is not after that of the row before, in the order given."""
    return with_previous(unique, order, before=first).where(F.col("before") >= F.col(first)).drop("before")
