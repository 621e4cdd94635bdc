"""Reconciling two deduplicated sources by canonical payload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.errors import ReconcileError
from attestry.operators.dedup import collisions

SIDES = ("equivalent", "left_only", "right_only")


def reconcile(left: DataFrame, right: DataFrame, fingerprint: str = "fingerprint", payload: str = "payload", position: str = "input_position", check: bool = True) -> DataFrame:
    """(fingerprint, side, left_position, right_position): one full join on fingerprint and payload gives all three sides.

    Each input must hold a fingerprint once. Raises ReconcileError for repeated fingerprints and for equal fingerprints of
    different payloads, in one input or across both.
    """
    a = left.select(F.col(fingerprint).alias("fingerprint"), F.col(payload).alias("payload"), F.col(position).alias("left_position"))
    b = right.select(F.col(fingerprint).alias("fingerprint"), F.col(payload).alias("payload"), F.col(position).alias("right_position"))
    if check:
        for name, side in (("left", a), ("right", b)):
            if side.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).where("n > 1").head(1):
                raise ReconcileError(f"the {name} source repeats a fingerprint")
        if collisions(a.select("fingerprint", "payload").unionByName(b.select("fingerprint", "payload"))).head(1):
            raise ReconcileError("equal fingerprints for different payloads")
    side = F.when(F.col("right_position").isNull(), SIDES[1]).when(F.col("left_position").isNull(), SIDES[2]).otherwise(SIDES[0])
    return a.join(b, ["fingerprint", "payload"], "full").select("fingerprint", side.alias("side"), "left_position", "right_position")
