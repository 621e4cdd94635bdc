"""Validated aggregation: a deduplicated table is proved before any of it is believed, and then totalled by player."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.errors import PolicyError, SeasonError
from attestry.functions import encoding as E
from attestry.functions import scalars as S
from attestry.operators import dedup, policy
from attestry.operators import rows as R
from attestry.operators.audit import audit
from attestry.operators.dedup import Deduplicated
from attestry.session import settled


class Aggregated(NamedTuple):
    """dispositions: every unique row with its status. players: a row for each, in order of first_position."""

    dispositions: DataFrame
    players: DataFrame


def check_season(season: object, spark) -> None:
    """Raises SeasonError for what isn't an ASCII season."""
    if not isinstance(season, str) or not spark.createDataFrame([(season,)], "x string").select(S.season_is_valid(F.col("x"))).first()[0]:
        raise SeasonError("the season must be yyyy-yy, the second year after the first")


def occurrence_problems(occurrences: DataFrame, prefix: str = E.PREFIX) -> DataFrame:
    """(position, fingerprint, problem): fields of occurrences that are missing or out of range, and positions that aren't 1 to n."""
    col = F.col
    bad = [
        F.when(F.coalesce(col(c) < 1, F.lit(True)), F.lit(f"invalid {c}")) for c in ("input_position", "representative_position", *R.POSITIVE)
    ] + [F.when(col(c).isNull(), F.lit(f"invalid {c}")) for c in ("source_locator", "imported_at", "rank_text")]
    bad.append(F.when(~F.coalesce(col("fingerprint").rlike(rf"\A\Q{prefix}\E[0-9a-f]{{64}}\z"), F.lit(False)), F.lit("invalid fingerprint")))
    each = occurrences.select(col("input_position").cast("long").alias("position"), "fingerprint", F.explode(F.array_compact(F.array(*bad))).alias("problem"))
    gaps = dedup.position_gaps(occurrences, "input_position").select(F.lit(None).cast("long").alias("position"), F.lit(None).cast("string").alias("fingerprint"), F.lit("positions are not 1 to n").alias("problem"))
    return each.unionByName(gaps)


def deduplication_problems(deduplicated: Deduplicated, season: str, domain: bytes = E.DOMAIN, prefix: str = E.PREFIX) -> DataFrame:
    """(position, fingerprint, problem), empty for a table that can be believed: fingerprints are made anew, and the trail is audited.

    unique_position, where unique rows have it, must follow their first occurrences.
    """
    return _problems(Deduplicated(*(settled(x) for x in deduplicated)), season, domain, prefix)


def _problems(deduplicated: Deduplicated, season: str, domain: bytes = E.DOMAIN, prefix: str = E.PREFIX) -> DataFrame:
    unique, occurrences = deduplicated
    told = unique.drop("payload", "problems").withColumnRenamed("fingerprint", "__told")
    made = R.with_payload(told, domain, prefix)
    problem = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("__told").rlike(rf"\A\Q{prefix}\E[0-9a-f]{{64}}\z"), F.lit(False)), F.lit("invalid fingerprint")),
        F.when(F.size("problems") > 0, F.concat(F.lit("no canonical form: "), F.array_join("problems", " "))),
        F.when((F.size("problems") == 0) & ~F.col("fingerprint").eqNullSafe(F.col("__told")), F.lit("fingerprint differs")),
        F.when(~F.col("target_season").eqNullSafe(F.lit(season)), F.lit("another season")),
    ))
    rows = made.select(F.col("input_position").cast("long").alias("position"), F.col("__told").alias("fingerprint"), F.explode(problem).alias("problem"))
    trail = audit(unique, occurrences, same=R.PROVENANCE).select(F.lit(None).cast("long").alias("position"), "fingerprint", "problem")
    out = rows.unionByName(occurrence_problems(occurrences, prefix)).unionByName(trail)
    if "unique_position" in unique.columns:
        first = occurrences.groupBy(F.col("fingerprint").alias("o_fp")).agg(F.min("input_position").alias("o_first"))
        late = dedup.out_of_order(unique.join(first, F.col("fingerprint") == F.col("o_fp")).select("unique_position", "fingerprint", "o_first"), "unique_position", "o_first")
        out = out.unionByName(late.select(F.col("unique_position").cast("long").alias("position"), "fingerprint", F.lit("out of first-seen order").alias("problem")))
    return out


def player_totals(disposed: DataFrame) -> DataFrame:
    """Per player (kind, value): first position, the first row's text, rows by status, their list in order, and exact digits of subtotal and total."""
    rows = disposed.withColumns({"kind": F.col("player")["kind"], "value": F.col("player")["value"]})
    count = lambda status: F.count_if(F.col("status") == status).alias(f"n_{status}")
    listed = F.array_sort(F.collect_list(F.struct("input_position", "fingerprint", "status", "reason_code")))  # a player's rows are one row of the result
    per = rows.groupBy("kind", "value").agg(F.min("input_position").alias("first_position"), F.min_by("player_display_text", "input_position").alias("display"), count(policy.INCLUDED), count(policy.EXCLUDED), count(policy.REVIEW), listed.alias("dispositions"))
    sums = policy.entity_totals_unbounded(rows.withColumn("who", F.struct("kind", "value")), "who", R.AMOUNT).select("who.kind", "who.value", "subtotal")
    done = F.col(f"n_{policy.REVIEW}") == 0
    return per.join(sums, ["kind", "value"]).withColumns({"total": F.when(done, F.col("subtotal")), "completion": F.when(done, policy.COMPLETE).otherwise(policy.INCOMPLETE)})


def dispositions(unique: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """Unique rows with player, evidence, status and reason; decisions (fingerprint, status, reason) as policy.apply_policy() takes them."""
    rows = settled(R.with_identity(unique))
    key = F.concat_ws(":", F.col("player")["kind"], F.col("player")["value"])
    return policy.apply_policy(rows.withColumn("__key", key), "__key", R.AMOUNT, "target_season_marker_text", "source_row_description", "fingerprint", decisions).drop("__key")


def aggregate(deduplicated: Deduplicated, season: str, decisions: DataFrame | None = None, **fingerprints) -> Aggregated:
    """Totals by player. Raises SeasonError, PolicyError for a table that can't be believed, and DecisionError."""
    check_season(season, deduplicated.unique.sparkSession)
    deduplicated = Deduplicated(*(settled(x) for x in deduplicated))
    if bad := _problems(deduplicated, season, **fingerprints).limit(20).collect():
        raise PolicyError("; ".join(sorted(f"{r['fingerprint'] or r['position']}: {r['problem']}" for r in bad)))
    made = settled(dispositions(deduplicated.unique, decisions))
    return Aggregated(made, player_totals(made))


def subsets(disposed: DataFrame) -> dict[str, DataFrame]:
    """The rows of each status."""
    return {status: disposed.where(F.col("status") == status) for status in (policy.INCLUDED, policy.EXCLUDED, policy.REVIEW)}
