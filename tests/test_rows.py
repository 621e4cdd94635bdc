import hashlib
import unicodedata

import pytest
from pyspark.sql import functions as F

from attestry.errors import DecisionError, FingerprintError, MoneyError, PolicyError, SeasonError
from attestry.functions import encoding as E
from attestry.operators import aggregate, dedup, ordering, rows
from attestry.session import settled

ONE = {
    "target_season": "2026-27", "source_page_number": 2, "source_row_position": 3, "rank_text": "T23", "player_display_text": "Example Player", "player_url": "/players/example-player/12345/", "player_id": "12345",
    "team_logo_url": "https://CDN.EXAMPLE.test/logos/9.png?width=30", "team_logo_asset_id": "9", "target_season_salary_text": "$1,000", "target_season_marker_text": "", "source_row_description": None,
    "source_locator": "https://example.test/players/#page-2", "imported_at": "2026-08-07T20:00:00Z", "salary_season_cells": [("2026-27", "$1,000", ""), ("2027-28", "-", "P")], rows.AMOUNT: "1000",
}


def table(spark, *changes):
    made = [{**ONE, **c} for c in changes]
    names = [x.split()[0] for x in rows.ROW.split(", ")]
    return spark.createDataFrame([(i, *(m[n] for n in names)) for i, m in enumerate(made, start=1)], f"input_position int, {rows.ROW}")


def typed(tag, body):
    return tag + len(body).to_bytes(8, "big") + body


def text(x):
    return typed(b"S", x.encode())


def number(n):
    return typed(b"I", n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def seq(*xs):
    return typed(b"L", b"".join(xs))


def by_hand(row):
    """The payload of a row, written down from the format alone."""
    none = typed(b"N", b"")
    amount = lambda t: none if t in ("", "-") else number(int(t.strip().replace("$", "").replace(",", "")))
    who = seq(text("player_id"), number(int(row["player_id"]))) if row["player_id"] is not None else seq(text("player_url"), text(row["player_url"].split("?")[0])) if row["player_url"] else seq(text("player_display_text"), text(" ".join(unicodedata.normalize("NFC", row["player_display_text"]).split()).casefold()))
    logo = "https://cdn.example.test/logos/9.png"
    team = seq(text("team_logo_asset_id"), number(int(row["team_logo_asset_id"]))) if row["team_logo_asset_id"] is not None else seq(text("team_logo_url"), text(logo))
    cells = [seq(text(h), amount(t), text(unicodedata.normalize("NFC", m).strip())) for h, t, m in sorted(row["salary_season_cells"])]
    note = " ".join(unicodedata.normalize("NFC", row["source_row_description"] or "").split())
    fields = {"target_season": text(row["target_season"]), "player_identity": who, "team_identity": team, "target_season_salary_dollars": amount(row["target_season_salary_text"]),
              "target_season_marker": text(unicodedata.normalize("NFC", row["target_season_marker_text"]).strip()), "source_row_description": text(note) if note else none, "salary_season_cells": seq(*cells)}
    return seq(*(seq(text(k), v) for k, v in fields.items()))


CHANGES = [
    {}, {"player_id": None}, {"player_id": None, "player_url": None, "player_display_text": " STRASSE é \x1f x"}, {"player_id": None, "player_url": ""}, {"team_logo_asset_id": None}, {"source_row_description": " a\t é "}, {"source_row_description": " \n"},
    {"target_season_salary_text": "-", rows.AMOUNT: None, "salary_season_cells": [("2026-27", "-", "")]}, {"target_season_salary_text": "$0", rows.AMOUNT: "0", "salary_season_cells": [("2027-28", "", "x"), ("2026-27", "0", "")]},
    {"player_id": "9" * 60, "target_season_salary_text": "8" * 4301, rows.AMOUNT: "8" * 4301, "salary_season_cells": [("2026-27", "8" * 4301, "")]}, {"target_season_marker_text": " é", "salary_season_cells": [("2026-27", "1000", "é ")]},
]


def test_payloads_by_hand(spark):
    import sys

    sys.set_int_max_str_digits(0)
    got = rows.with_payload(table(spark, *CHANGES)).orderBy("input_position").collect()
    for r, c in zip(got, CHANGES, strict=True):
        assert not r["problems"] and bytes(r["payload"]) == by_hand({**ONE, **c}), c
        assert r["fingerprint"] == E.PREFIX + hashlib.sha256(E.DOMAIN + bytes(r["payload"])).hexdigest()


SAME = [
    {"rank_text": "1", "source_page_number": 9, "source_row_position": 1, "source_locator": "z", "imported_at": "x"}, {"player_display_text": "Other", "player_url": None}, {"player_id": "12345"}, {"team_logo_url": "http://other.test/x.png"},
    {"target_season_salary_text": " 1000 ", "salary_season_cells": [("2027-28", "–", " P"), ("2026-27", "$1,000", "")]}, {"source_row_description": " \t"},
]
OTHER = [{"player_id": "12346"}, {"target_season": "2027-28", "target_season_salary_text": "-", rows.AMOUNT: None, "target_season_marker_text": "P"}, {"team_logo_asset_id": None}, {"source_row_description": "x"}, {"salary_season_cells": [("2026-27", "$1,000", "")]}, {"player_id": None}]


def test_what_changes_a_fingerprint_and_what_does_not(spark):
    got = [r["fingerprint"] for r in rows.fingerprinted(table(spark, {}, *SAME, *OTHER)).orderBy("input_position").collect()]
    assert set(got[1 : len(SAME) + 1]) == {got[0]} and len(set(got)) == 1 + len(OTHER)


RULES = [
        ({"target_season": None}, "target_season:required"), ({"target_season": "2026-28"}, "target_season:invalid_season"), ({"source_page_number": 0}, "source_page_number:invalid_positive_integer"), ({"source_row_position": None}, "source_row_position:invalid_positive_integer"),
        ({"player_id": "01"}, "player_id:invalid_unsigned_integer"), ({"player_display_text": " \t"}, "player_display_text:empty_identity"), ({"player_url": "ftp://x"}, "player_url:invalid_url"), ({"team_logo_url": "/x.png"}, "team_logo_url:invalid_url"), ({"team_logo_url": "http://:80/x"}, "team_logo_url:invalid_url"),
        ({"target_season_salary_text": "1.5"}, "target_season_salary_text:invalid_salary"), ({rows.AMOUNT: "999"}, f"{rows.AMOUNT}:inconsistent_amount"), ({rows.AMOUNT: None}, f"{rows.AMOUNT}:inconsistent_amount"), ({"salary_season_cells": None}, "salary_season_cells:required"),
        ({"salary_season_cells": [("2026-27", None, "")]}, "salary_season_cells:invalid_cell_type"), ({"salary_season_cells": [("2026-27", "$1,000", ""), ("x", "-", "")]}, "salary_season_cells:invalid_heading"),
        ({"salary_season_cells": [("2026-27", "$1,000", "")] * 2}, "salary_season_cells:duplicate_heading"), ({"salary_season_cells": [("2026-27", "$1,000", ""), ("2027-28", "x", "")]}, "salary_season_cells:invalid_cell_salary"), ({"salary_season_cells": []}, "salary_season_cells:target_cell_count"),
        ({"salary_season_cells": [("2026-27", "$1,001", "")]}, "salary_season_cells:target_cell_mismatch"), ({"salary_season_cells": [("2026-27", "$1,000", "x")]}, "salary_season_cells:target_cell_mismatch"), ({"rank_text": None}, "rank_text:required"),
]


def test_row_rules(spark):
    got = rows.with_payload(table(spark, *(change for change, _ in RULES))).orderBy("input_position").collect()
    for r, (_, problem) in zip(got, RULES, strict=True):
        assert problem in r["problems"] and r["payload"] is None and r["fingerprint"] is None


def test_faults_name_their_rows(spark):
    with pytest.raises(FingerprintError, match="target_cell_count at input position 2, source page 2, source row 3, player 'Ex\\?mple'"):
        rows.fingerprinted(table(spark, {}, {"target_season": "x", "player_display_text": "Ex\x07mple"}))


def test_amounts(spark):
    raw = table(spark, {"target_season_salary_text": " $12,000\t"}, {"target_season_salary_text": "n/a"}).drop(rows.AMOUNT)
    assert [r[rows.AMOUNT] for r in rows.normalised(raw).orderBy("input_position").collect()] == ["12000", None]
    for change, says in (({"target_season_salary_text": "12,34"}, "malformed"), ({"target_season_salary_text": None}, "missing"), ({"source_page_number": 0}, "invalid source_page_number")):
        with pytest.raises(MoneyError, match=says):
            rows.normalised(table(spark, {}, change).drop(rows.AMOUNT), "input_position")


def made(spark, *changes):
    return dedup.deduplicate(settled(rows.with_payload(table(spark, *changes))).drop("problems"))


def test_players_and_totals(spark):
    amount = lambda n, **more: {"target_season_salary_text": str(n), rows.AMOUNT: str(n), "salary_season_cells": [("2026-27", str(n), "")], **more}
    big = amount("7" * 60, player_id="5")
    out = aggregate.aggregate(made(spark, amount(10), amount(10), amount(20), big, amount(3, player_id=None, player_url=None, player_display_text="ß"), amount(4, player_id=None, player_url=None, player_display_text=" SS ")), "2026-27")
    got = {(r["kind"], r["value"]): r for r in out.players.collect()}
    assert got["player_id", "12345"]["n_review_required"] == 2 and got["player_id", "12345"]["total"] is None and got["player_id", "12345"]["subtotal"] == "0"
    assert got["player_id", "5"]["total"] == "7" * 60 and [d["input_position"] for d in got["player_display_text", "ss"]["dispositions"]] == [5, 6]
    assert {k: v.count() for k, v in aggregate.subsets(out.dispositions).items()} == {"included": 1, "excluded": 0, "review_required": 4}
    chosen = out.dispositions.where("input_position in (1, 3)").select("fingerprint", F.lit("included").alias("status"), F.lit("seen").alias("reason"))
    again = aggregate.aggregate(made(spark, amount(10), amount(10), amount(20)), "2026-27", chosen)
    assert [(r["total"], r["completion"]) for r in again.players.collect()] == [("30", "complete")]
    with pytest.raises(DecisionError):
        aggregate.aggregate(made(spark, amount(10)), "2026-27", chosen.withColumn("more", F.lit(1)))
    with pytest.raises(DecisionError):
        aggregate.aggregate(made(spark, amount(10), amount(20)), "2026-27", chosen.withColumn("reason", F.lit("a​b")))


def test_a_forged_table_is_not_believed(spark):
    d = made(spark, {}, {"player_id": "7"}, {})
    check = lambda u=d.unique, o=d.occurrences, s="2026-27": {r["problem"] for r in aggregate.deduplication_problems(dedup.Deduplicated(u, o), s).collect()}
    assert check() == set()
    col = F.when(F.col("input_position") == 1, F.lit("x"))
    assert check(u=d.unique.withColumn("player_id", F.lit("8"))) == {"fingerprint differs"}
    assert check(u=d.unique.withColumn("target_season_salary_text", F.lit("z"))) == {"no canonical form: target_season_salary_text:invalid_salary target_season_salary_dollars:inconsistent_amount"}
    assert check(s="2027-28") == {"another season"}
    assert "invalid fingerprint" in check(u=d.unique.withColumn("fingerprint", F.coalesce(col, "fingerprint")))
    assert check(o=d.occurrences.withColumn("rank_text", F.lit(None).cast("string"))) == {"invalid rank_text", "provenance_differs"}
    assert check(o=d.occurrences.where("input_position <> 2")) == {"no_occurrence", "positions are not 1 to n"}
    assert check(o=d.occurrences.withColumn("source_page_number", F.lit(0))) == {"invalid source_page_number", "provenance_differs"}
    assert check(u=d.unique.withColumn("unique_position", F.lit(3) - F.col("input_position"))) == {"out of first-seen order"}
    assert check(u=d.unique.withColumn("unique_position", F.col("input_position"))) == set()
    with pytest.raises(PolicyError, match="fingerprint differs"):
        aggregate.aggregate(dedup.Deduplicated(d.unique.withColumn("player_id", F.lit("8")), d.occurrences), "2026-27")
    for season in ("2026-28", None, "٢٠٢٦-27"):
        with pytest.raises(SeasonError):
            aggregate.aggregate(d, season)


def test_numbering_and_neighbours(spark):
    df = spark.createDataFrame([(i * 7919 % 1000, chr(97 + i % 3)) for i in range(1000)], "k int, v string")
    got = ordering.numbered(df, "n", "k").collect()
    assert sorted(r["n"] for r in got) == list(range(1, 1001)) and all(r["n"] == r["k"] + 1 for r in got)
    near = {r["k"]: (r["before"], r["was"]) for r in ordering.with_previous(df, "k", before="k", was="v").collect()}
    said = {r["k"]: r["v"] for r in df.collect()}
    assert near == {k: (k - 1, said[k - 1]) if k else (None, None) for k in range(1000)}
    assert ordering.numbered(df.limit(0), "n", "k").count() == ordering.with_previous(df.limit(0), "k", b="k").count() == 0
