"""Priced rows: rules, amounts, canonical forms, identities and whole-row payloads, as expressions.

A row has one amount for a target season and a cell for each season that its source shows. Ids and amounts are digits of any length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.errors import FingerprintError, MoneyError
from attestry.functions import encoding as E
from attestry.functions import scalars as S
from attestry.functions import unicode as U

CELLS = "array<struct<heading:string,salary_text:string,marker_text:string>>"
#: The columns of a row, those of a raw row first.
RAW = (
    "target_season string, source_page_number int, source_row_position int, rank_text string, player_display_text string, player_url string, player_id string, "
    f"team_logo_url string, team_logo_asset_id string, target_season_salary_text string, target_season_marker_text string, source_row_description string, source_locator string, imported_at string, salary_season_cells {CELLS}"
)
AMOUNT = "target_season_salary_dollars"
ROW = f"{RAW}, {AMOUNT} string"
STRINGS = ("target_season", "player_display_text", "team_logo_url", "target_season_salary_text", "target_season_marker_text", "source_locator", "imported_at", "rank_text")
POSITIVE = ("source_page_number", "source_row_position")
DIGITS = ("player_id", "team_logo_asset_id", AMOUNT)
PROVENANCE = ("source_locator", "imported_at", "source_page_number", "source_row_position", "rank_text")


def context(position: str | None = "input_position") -> Column:
    """Where a row stands, for messages: positions as far as they are there, and the beginning of its text as it can be printed."""
    said = lambda name, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name} "), F.col(c).cast("string")))
    player = F.when(F.col("player_display_text") != "", F.concat(F.lit("player '"), S.printable(F.col("player_display_text")), F.lit("'")))
    parts = F.concat_ws(", ", *([said("input position", position)] if position else []), said("source page", "source_page_number"), said("source row", "source_row_position"), player)
    return F.when(parts != "", F.concat(F.lit(" at "), parts)).otherwise("")


def _first(rows: DataFrame, bad: Column, says: Column, position: str | None) -> list[str]:
    """Messages of the first faulty rows; how many are read is bounded by the limit, how many there are isn't."""
    order = [position] if position else [*POSITIVE]
    return [f"{r['code']}{r['place']}" for r in rows.where(bad).select(*order, says.alias("code"), context(position).alias("place")).orderBy(*order, "code").limit(20).collect()]


def with_amounts(rows: DataFrame) -> DataFrame:
    """Raw rows with the digits of their amount, null for none, and amount_problem: null, or why there is no answer. Texts stay as they are."""
    text = F.col("target_season_salary_text")
    places = [F.when(F.col(c).isNull() | (F.col(c) < 1), F.lit(f"invalid {c}")) for c in POSITIVE]
    problem = F.coalesce(*places, F.when(text.isNull(), "missing target_season_salary_text"), F.when(~S.money_is_valid(text), "malformed target_season_salary_text"))
    return rows.withColumns({AMOUNT: S.money_digits(text), "amount_problem": problem})


def normalised(rows: DataFrame, position: str | None = None) -> DataFrame:
    """with_amounts() of rows that all have an answer; raises MoneyError, which names the first rows that don't. Nothing is collapsed or put in another order."""
    out = with_amounts(rows)
    if found := _first(out, F.col("amount_problem").isNotNull(), F.col("amount_problem"), position):
        raise MoneyError("; ".join(found))
    return out.drop("amount_problem")


def with_identity(rows: DataFrame) -> DataFrame:
    """rows with player, a struct<kind,value>: the id, else the canonical URL, else the folded name; null where that isn't valid."""
    link = F.nullif(F.col("player_url"), F.lit(""))
    named = rows.withColumn("__name", F.nullif(U.folded(F.when(F.col("player_id").isNull() & link.isNull(), F.col("player_display_text"))), F.lit("")))
    kind = F.when(F.col("player_id").isNotNull(), "player_id").when(link.isNotNull(), "player_url").otherwise("player_display_text")
    named = named.withColumns({"__kind": kind, "__value": F.coalesce("player_id", F.when(link.isNotNull(), S.linked_url(link)).otherwise(F.col("__name")))})
    return named.withColumn("player", F.when(F.col("__value").isNotNull(), F.struct(F.col("__kind").alias("kind"), F.col("__value").alias("value")))).drop("__name", "__kind", "__value")


def with_canonical(rows: DataFrame) -> DataFrame:
    """rows with the columns that their payload is made of: player, __marker, __description, __logo, and __cells, an array<struct<heading,amount,marker>> sorted by heading."""
    cells = F.col("salary_season_cells")
    out = with_identity(rows).withColumns({
        "__marker": U.normal_form(F.col("target_season_marker_text")), "__description": U.normal_form(F.col("source_row_description")),
        "__markers": U.normal_forms(F.transform(cells, lambda c: c["marker_text"])), "__logo": S.full_http_url(F.col("team_logo_url")),
    })
    cell = lambda x: F.struct(x["cells"]["heading"].alias("heading"), S.money_digits(x["cells"]["salary_text"]).alias("amount"), S.strip(x["markers"]).alias("marker"))
    said = F.transform(F.arrays_zip(cells.alias("cells"), F.col("__markers").alias("markers")), cell)
    return out.withColumns({"__marker": S.strip(F.col("__marker")), "__description": S.canonical_description(F.col("__description")), "__cells": F.array_sort(said)}).drop("__markers")


def canonical_rules() -> dict[tuple[str, str], tuple[Column, str]]:
    """(field, code) to (condition, message) over with_canonical(): what keeps a row from having a payload."""
    col = F.col
    cells = col("salary_season_cells")
    target = F.filter("__cells", lambda c: c["heading"] == col("target_season"))
    one = F.get(target, F.lit(0))
    anything = lambda test: F.coalesce(F.exists(cells, test), F.lit(False))
    missing = lambda c: c.isNull() | c["heading"].isNull() | c["salary_text"].isNull() | c["marker_text"].isNull()
    rules = {(c, "required"): (col(c).isNull(), "must be text") for c in STRINGS}
    rules |= {(c, "invalid_positive_integer"): (F.coalesce(col(c) < 1, F.lit(True)), "must be a positive integer") for c in POSITIVE}
    rules |= {(c, "invalid_unsigned_integer"): (F.coalesce(~col(c).rlike(r"\A(0|[1-9][0-9]*)\z"), F.lit(False)), "must be the digits of an integer, or null") for c in DIGITS}
    headings = F.transform(cells, lambda c: c["heading"])
    return rules | {
        ("target_season", "invalid_season"): (col("target_season").isNotNull() & ~S.season_is_valid(col("target_season")), "must be a season, yyyy-yy"),
        ("player_display_text", "empty_identity"): (S.collapse_whitespace(col("player_display_text")) == "", "must hold more than white space"),
        ("player_url", "invalid_url"): ((col("player_url") != "") & S.linked_url(col("player_url")).isNull(), "must be http(s), begin with a host or with the root"),
        ("team_logo_url", "invalid_url"): (col("team_logo_url").isNotNull() & col("__logo").isNull(), "must be a full http(s) URL"),
        ("target_season_salary_text", "invalid_salary"): (col("target_season_salary_text").isNotNull() & ~S.money_is_valid(col("target_season_salary_text")), "must be whole dollars or a text for none"),
        (AMOUNT, "inconsistent_amount"): (~col(AMOUNT).eqNullSafe(S.money_digits(col("target_season_salary_text"))), "must be the amount of the text"),
        ("salary_season_cells", "required"): (cells.isNull(), "must be a list"),
        ("salary_season_cells", "invalid_cell_type"): (anything(missing), "cells have a heading, an amount's text and a marker"),
        ("salary_season_cells", "invalid_heading"): (anything(lambda c: ~S.season_is_valid(c["heading"])), "headings must be seasons"),
        ("salary_season_cells", "duplicate_heading"): (F.size(F.array_distinct(headings)) < F.size(headings), "headings must differ"),
        ("salary_season_cells", "invalid_cell_salary"): (anything(lambda c: ~S.money_is_valid(c["salary_text"])), "amounts must be whole dollars or a text for none"),
        ("salary_season_cells", "target_cell_count"): (F.size(target) != 1, "one cell must be the target season's"),
        ("salary_season_cells", "target_cell_mismatch"): ((F.size(target) == 1) & (~one["amount"].eqNullSafe(col(AMOUNT)) | ~one["marker"].eqNullSafe(col("__marker"))), "the target season's cell must agree with the row"),
    }


def with_payload(rows: DataFrame, domain: bytes = E.DOMAIN, prefix: str = E.PREFIX, digest: Callable[[Column], Column] = E.sha256_hex) -> DataFrame:
    """rows with payload, fingerprint and problems, the codes that keep a row from having them (both null then).

    The payload has seven named fields in their order; the names are fixed values. It is made in steps, as each level of it needs the length of the one below.
    """
    names = rows.columns
    text = E.encode_string
    made = with_canonical(rows)
    bad = F.array_compact(F.array(*(F.when(F.coalesce(test, F.lit(False)), F.lit(f"{field}:{code}")) for (field, code), (test, _) in canonical_rules().items())))
    made = made.withColumn("problems", bad)
    player, asset, good = F.col("player"), F.col("team_logo_asset_id"), F.size("problems") == 0
    made = made.withColumns({
        "__who_hex": E.to_hex(F.when(good & (player["kind"] == "player_id"), player["value"])), "__team_hex": E.to_hex(F.when(good, asset)), "__amount_hex": E.to_hex(F.when(good, F.col(AMOUNT))),
        "__hexes": E.all_to_hex(F.when(good, F.transform("__cells", lambda c: c["amount"]))),
    })
    parts = F.transform(F.arrays_zip(F.col("__cells").alias("c"), F.col("__hexes").alias("x")), lambda z: F.concat(text(z["c"]["heading"]), E.nullable(E.encode_hex, z["x"]), text(z["c"]["marker"])))
    made = made.withColumns({
        "__who": F.concat(text(player["kind"]), F.when(F.col("__who_hex").isNotNull(), E.encode_hex(F.col("__who_hex"))).otherwise(text(player["value"]))),
        "__team": F.when(asset.isNotNull(), F.concat(text(F.lit("team_logo_asset_id")), E.encode_hex(F.col("__team_hex")))).otherwise(F.concat(text(F.lit("team_logo_url")), text(F.col("__logo")))),
        "__parts": parts,
    })
    made = made.withColumn("__seasons", F.aggregate("__parts", F.lit(b""), lambda acc, x: F.concat(acc, E.encode_sequence(x))))
    values = {
        "target_season": text(F.col("target_season")), "player_identity": E.encode_sequence(F.col("__who")), "team_identity": E.encode_sequence(F.col("__team")), AMOUNT: E.nullable(E.encode_hex, F.col("__amount_hex")),
        "target_season_marker": text(F.col("__marker")), "source_row_description": E.nullable(text, F.col("__description")), "salary_season_cells": E.encode_sequence(F.col("__seasons")),
    }
    made = made.withColumns({f"__v{i}": v for i, v in enumerate(values.values())})
    made = made.withColumn("__body", F.concat(*(E.encode_field(name, F.col(f"__v{i}")) for i, name in enumerate(values))))
    made = made.withColumn("payload", F.when(good, E.encode_sequence(F.col("__body"))))
    return made.withColumn("fingerprint", E.fingerprint(F.col("payload"), domain, prefix, digest)).select(*names, "problems", "payload", "fingerprint")


def fingerprinted(rows: DataFrame, position: str = "input_position", **options) -> DataFrame:
    """with_payload() of rows that all have one; raises FingerprintError, which names the first that don't and why."""
    out = with_payload(rows, **options)
    if found := _first(out, F.size("problems") > 0, F.array_join("problems", " "), position):
        raise FingerprintError("; ".join(found))
    return out.drop("problems")
