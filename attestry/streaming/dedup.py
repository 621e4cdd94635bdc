"""Idempotent repeat imports as a stream: rows whose fingerprint was seen within the watermark are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame


def deduplicate_stream(rows: DataFrame, fingerprint: str, event_time: str, delay: str = "7 days") -> DataFrame:
    """State is bounded by the delay; a fingerprint that returns later counts as new."""
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([fingerprint])
