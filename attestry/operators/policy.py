"""Reviewable policy: evidence, disposition, manual decisions and exact totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.errors import DecisionError
from attestry.functions.scalars import UNPRINTABLE, collapse_whitespace, strip
from attestry.functions.unicode import normal_form

INCLUDED, EXCLUDED, REVIEW = "included", "excluded", "review_required"
COMPLETE, INCOMPLETE = "complete", "review_required"


def evidence(marker: Column, description: Column, special: str = "TW", special_code: str = "two_way_contract_marker") -> Column:
    """Array of (code, value): canonical text decides whether there is evidence, and the raw text is what is reported."""
    mark = strip(normal_form(marker))
    marked = F.struct(F.when(mark == special, special_code).otherwise("source_target_marker").alias("code"), marker.alias("value"))
    described = F.struct(F.lit("source_row_description").alias("code"), description.alias("value"))
    return F.array_compact(F.array(F.when(mark != "", marked), F.when(collapse_whitespace(normal_form(description)) != "", described)))


def with_counts(rows: DataFrame, entity: str, amount: str) -> DataFrame:
    """rows with n_amounts: how many rows of the entity have an amount, decided ones included. Aggregation and join, no window."""
    per = rows.groupBy(F.col(entity).alias("__entity")).agg(F.count(amount).alias("n_amounts"))
    return rows.join(per, F.col(entity).eqNullSafe(F.col("__entity"))).drop("__entity")


def disposition(amount: Column, has_evidence: Column, n_amounts: Column, decision: Column) -> dict[str, Column]:
    """Status, reason code and source of the decision: a decision first, then no amount, evidence, several amounts, and inclusion."""
    decided = decision.isNotNull()
    status = F.when(decided, decision).when(amount.isNull(), EXCLUDED).when(has_evidence | (n_amounts > 1), REVIEW).otherwise(INCLUDED)
    reason = (
        F.when(decided & (decision == INCLUDED), "decision_included").when(decided, "decision_excluded").when(amount.isNull(), "no_amount")
        .when(has_evidence, "source_evidence_requires_review").when(n_amounts > 1, "multiple_amounts").otherwise("single_ordinary_amount")
    )
    return {"status": status, "reason_code": reason, "decision_source": F.when(decided, "manual").otherwise("default")}


def check_decisions(rows: DataFrame, decisions: DataFrame, key: str, amount: str) -> DataFrame:
    """Problems of decisions (key, status, reason): one row (key, problem) for each; empty if they can be applied.

    A reason is text that can be printed. Decisions with other columns raise DecisionError.
    """
    if set(decisions.columns) != {key, "status", "reason"}:
        raise DecisionError(f"decisions have exactly {key}, status and reason")
    known = rows.select(F.col(key), F.col(amount).isNotNull().alias("has_amount"))
    d = decisions.select(key, "status", "reason").join(known, key, "left")
    repeated = decisions.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key, F.lit("repeated").alias("problem"))
    problem = (
        F.when(F.col("has_amount").isNull(), "unknown").when(F.col("status").isNull() | ~F.col("status").isin(INCLUDED, EXCLUDED), "status")
        .when(F.col("reason").isNull() | (strip(F.col("reason")) == "") | strip(F.col("reason")).rlike(UNPRINTABLE), "reason")
        .when(~F.col("has_amount") & (F.col("status") == INCLUDED), "included_without_amount")
    )
    return d.select(key, problem.alias("problem")).where("problem is not null").unionByName(repeated)


def apply_policy(rows: DataFrame, entity: str, amount: str, marker: str, description: str, key: str, decisions: DataFrame | None = None) -> DataFrame:
    """rows with n_amounts, evidence, status, reason_code, decision_source. Raises DecisionError for decisions that can't be applied."""
    out = with_counts(rows, entity, amount)
    if decisions is not None:
        if bad := check_decisions(rows, decisions, key, amount).limit(20).collect():
            raise DecisionError("; ".join(f"{r[0]}: {r[1]}" for r in sorted(bad, key=str)))
        out = out.join(decisions.select(key, F.col("status").alias("decision")), key, "left")
    else:
        out = out.withColumn("decision", F.lit(None).cast("string"))
    out = out.withColumn("evidence", evidence(F.col(marker), F.col(description)))
    return out.withColumns(disposition(F.col(amount), F.size("evidence") > 0, F.col("n_amounts"), F.col("decision"))).drop("decision")


def entity_totals(disposed: DataFrame, entity: str, amount: str, position: str, display: str | None = None) -> DataFrame:
    """Per entity: first position, counts by status, exact subtotal of what is included, and the total once nothing is unresolved.

    amount is a decimal; a sum beyond 38 digits raises. entity_totals_unbounded() takes digit strings of any length.
    """
    count = lambda status: F.count_if(F.col("status") == status).alias(f"n_{status}")
    per = disposed.groupBy(entity).agg(
        F.min(position).alias("first_position"), *([F.min_by(display, position).alias("display")] if display else []), count(INCLUDED), count(EXCLUDED), count(REVIEW),
        F.coalesce(F.sum(F.when(F.col("status") == INCLUDED, F.col(amount))), F.lit(0)).alias("subtotal"),
    )
    done = F.col(f"n_{REVIEW}") == 0
    return per.withColumns({"total": F.when(done, F.col("subtotal")), "completion": F.when(done, COMPLETE).otherwise(INCOMPLETE)})


def entity_totals_unbounded(disposed: DataFrame, entity: str, digits: str) -> DataFrame:
    """(entity, subtotal): exact sums of digit strings of any length; zero for an entity with nothing included.

    Numbers are cut into limbs of nine digits, limbs of a place are added with map-side combining, and the carries run once over the
    places of an entity, which are as many as its longest number needs.
    """
    said = F.when(F.col("status") == INCLUDED, F.col(digits))
    size = F.ceil(F.length(said) / 9).cast("int")
    padded = F.lpad(said, size * 9, "0")
    limbs = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.substring(padded, (size - 1 - i) * 9 + 1, F.lit(9)).cast("long"))
    rows = disposed.select(F.col(entity), F.posexplode_outer(F.when(size > 0, limbs)).alias("place", "limb"))
    places = rows.groupBy(entity, F.coalesce("place", F.lit(0)).alias("place")).agg(F.coalesce(F.sum(F.col("limb").cast("decimal(18,0)")), F.lit(0)).cast("decimal(38,0)").alias("limb"))
    per = places.groupBy(entity).agg(F.array_sort(F.collect_list(F.struct("place", "limb"))).alias("limbs"))
    billion = F.lit(10**9).cast("decimal(38,0)")
    zero = F.lit(0).cast("decimal(38,0)")

    def add(state: Column, x: Column) -> Column:
        v = (x["limb"] + state["carry"]).cast("decimal(38,0)")
        return F.struct(F.concat(F.lpad(F.pmod(v, billion).cast("decimal(9,0)").cast("string"), 9, "0"), state["said"]).alias("said"), F.floor(v / billion).cast("decimal(38,0)").alias("carry"))

    total = F.aggregate("limbs", F.struct(F.lit("").alias("said"), zero.alias("carry")), add, lambda s: F.concat(F.when(s["carry"] > 0, s["carry"].cast("string")).otherwise(""), s["said"]))
    return per.select(entity, F.coalesce(F.nullif(F.regexp_replace(total, r"\A0+", ""), F.lit("")), F.lit("0")).alias("subtotal"))
