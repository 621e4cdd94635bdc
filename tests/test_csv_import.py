import json

import pytest
from pyspark.sql import functions as F

from attestry.errors import DiagnosticsError, PublishError
from attestry.operators import aggregate
from attestry.sources import csv_import as C

CELLS = [{"heading": "2026-27", "salary_text": "$1,000", "marker_text": ""}, {"heading": "2027-28", "salary_text": "-", "marker_text": "P"}]
RECORD = {
    "player_display_text": "Fixture A", "player_url": "/players/a/1001/", "player_id": "001001", "team_display_text": "Team", "team_logo_url": "https://cdn.example.test/logos/9.png", "team_logo_asset_id": "0009", "target_season": "2026-27",
    "target_season_salary_text": "$1,000", "target_season_marker_text": "", "source_row_description": "", "salary_season_cells_json": json.dumps(CELLS), "source_row_reference": "",
}
META = {"source_system": "commissioner_salary_csv", "source_locator": "exports/a.csv", "retrieved_at": "2026-08-07T20:00:00Z", "generated_at": None, "source_event_time": None, "season": "2026-27", "league_scope": None, "artifact_version": "1.0", "schema_version": "1.0", "redaction_status": "unredacted-local"}


def field(x):
    return '"' + x.replace('"', '""') + '"' if any(c in x for c in ',"') else x


def content(*changes):
    rows = [list({**RECORD, **c}.values()) if isinstance(c, dict) else c for c in changes]
    return (",".join(C.HEADER) + "\r\n" + "".join(",".join(map(field, r)) + "\r\n" for r in rows)).encode()


def put(tmp_path, body, meta=META, name="a"):
    (tmp_path / f"{name}.csv").write_bytes(body)
    if meta is not None:
        (tmp_path / f"{name}.metadata.json").write_bytes(meta if isinstance(meta, bytes) else json.dumps(meta).encode())
    return str(tmp_path / f"{name}.csv")


def codes(spark, path, season="2026-27", at="2026-08-08T00:00:00Z", **more):
    with pytest.raises(DiagnosticsError) as e:
        C.read_import(spark, path, season, at, **more)
    return [(d["location"], d["record_number"], d["field"], d["code"]) for d in e.value.diagnostics]


def test_import_publish_and_reload(spark, tmp_path):
    path = put(tmp_path, content({}, {}, {"player_display_text": "Fixture B", "player_id": "7" * 40, "target_season_salary_text": "", "target_season_marker_text": "TW", "salary_season_cells_json": json.dumps([{"heading": "2026-27", "salary_text": "", "marker_text": "TW"}])}))
    counts = C.run_import(spark, path, "2026-27", str(tmp_path / "out.json"), str(tmp_path), now=lambda: "2026-08-08T00:00:00Z")
    assert counts == {"physical_csv_row_count": 3, "unique_row_count": 2, "duplicate_occurrence_count": 1}
    back = C.load_derived(spark, str(tmp_path / "out.json"))
    rows = {r["player_display_text"]: r for r in back.unique.collect()}
    assert (rows["Fixture A"]["player_id"], rows["Fixture A"]["team_logo_asset_id"], rows["Fixture A"]["target_season_salary_dollars"]) == ("1001", "9", "1000")
    assert rows["Fixture B"]["player_id"] == "7" * 40 and rows["Fixture B"]["target_season_salary_dollars"] is None and rows["Fixture A"]["source_locator"] == "exports/a.csv (CSV data record 1)"
    assert [r["representative_position"] for r in back.occurrences.orderBy("input_position").collect()] == [1, 1, 3]
    assert aggregate.aggregate(back, "2026-27").players.count() == 2
    C.run_import(spark, path, "2026-27", str(tmp_path / "out.json"), str(tmp_path), now=lambda: "2026-08-08T00:00:00Z")
    with pytest.raises(PublishError):
        C.run_import(spark, path, "2026-27", str(tmp_path / "out.json"), str(tmp_path), now=lambda: "2026-08-09T00:00:00Z")
    head = json.loads(next((tmp_path / "out.json" / "head").glob("part*")).read_text())

    def forged(change, unique=lambda df: df):
        there = tmp_path / f"f{len(list(tmp_path.iterdir()))}.json"
        spark.createDataFrame([(json.dumps(change(json.loads(json.dumps(head)))),)], "value string").coalesce(1).write.text(str(there / "head"))
        unique(spark.read.parquet(str(tmp_path / "out.json" / "unique_rows"))).write.parquet(str(there / "unique_rows"))
        spark.read.parquet(str(tmp_path / "out.json" / "occurrences")).write.parquet(str(there / "occurrences"))
        with pytest.raises(PublishError) as e:
            C.load_derived(spark, str(there))
        return str(e.value)

    same = lambda h: h
    assert "counts" in forged(lambda h: h | {"counts": h["counts"] | {"unique_row_count": 3}})
    assert "shape" in forged(lambda h: h | {"more": 1}) and "lineage" in forged(lambda h: h | {"lineage": {}})
    assert "unsupported_version" in forged(lambda h: h | {"metadata": h["metadata"] | {"schema_version": "2.0"}})
    assert "fingerprint differs" in forged(same, lambda df: df.withColumn("player_id", F.struct(F.lit("3ea").alias(C.HEX))))
    assert "integer" in forged(same, lambda df: df.withColumn("player_id", F.struct(F.lit("03E9").alias(C.HEX))))
    with pytest.raises(PublishError):
        C.load_derived(spark, str(tmp_path / "nothing"))


def test_all_faults_come_at_once_and_in_order(spark, tmp_path):
    cell = lambda **c: json.dumps([CELLS[0], {**CELLS[1], **c}])
    said = {
        "cell_control_character": cell(marker_text="a\x07"), "invalid_heading": cell(heading="2027"), "duplicate_heading": json.dumps([CELLS[0], CELLS[1], CELLS[1]]), "invalid_cell_salary": cell(salary_text="1.5"), "invalid_cell_type": cell(marker_text=1), "invalid_cell_shape": cell(x="y"),
        "target_cell_count": json.dumps(CELLS[1:]), "target_cell_mismatch": json.dumps([{**CELLS[0], "salary_text": "1000"}]), "invalid_json": '[{"heading":"a","heading":"b"}]', "wrong_json_shape": "[]",
    }
    changes = [{"salary_season_cells_json": x} for x in said.values()]
    changes += [[""], ["x"], {"player_display_text": ""}, {"player_display_text": " "}, {"player_id": "1a"}, {"team_logo_asset_id": "-1"}, {"player_url": "ftp://x"}, {"team_logo_url": "/x"}, {"team_logo_url": ""}, {"target_season": "2026-28"}, {"target_season": "2027-28"}, {"target_season_salary_text": "x"}]
    path = put(tmp_path, content(*changes), META | {"season": "2025-26", "more": 1, "league_scope": "x"})
    got = codes(spark, path, at="now")
    assert got[:4] == [("metadata", None, "more", "extra"), ("metadata", None, "season", "season_mismatch"), ("metadata", None, "league_scope", "must_be_null"), ("file", None, "imported_at", "invalid_timestamp")]
    rows = {}
    for _, n, f, code in got[4:]:
        rows.setdefault(n, []).append((f, code))
    cells = "salary_season_cells_json"
    assert [rows[i + 1] for i in range(10)] == [[(cells, c)] for c in said]
    assert [n for _, n, _, _ in got[4:]] == sorted(n for _, n, _, _ in got[4:])
    assert rows[11] == [("record", "blank_record")] and rows[12] == [("record", "column_count")]
    assert rows[13] == [("player_display_text", "empty_identity"), ("player_display_text", "required")] and rows[14] == [("player_display_text", "empty_identity")]
    assert rows[15] == [("player_id", "invalid_unsigned_integer")] and rows[16] == [("team_logo_asset_id", "invalid_unsigned_integer")] and rows[17] == [("player_url", "invalid_url")] and rows[18] == [("team_logo_url", "invalid_url")] and rows[19] == [("team_logo_url", "required")]
    assert rows[20] == [("target_season", "invalid_season"), (cells, "target_cell_count")] and rows[21] == [("target_season", "season_mismatch"), (cells, "target_cell_mismatch")] and rows[22] == [("target_season_salary_text", "invalid_salary"), (cells, "target_cell_mismatch")]


def test_sidecars_paths_and_fixtures(spark, tmp_path):
    for body, code in ((None, "missing"), (b"\xef\xbb\xbf{}", "bom"), (b"\xff", "invalid_utf8"), (b'{"a":1,"a":2}', "invalid_json"), (b"[]", "wrong_type")):
        assert C.parse_sidecar(body)[1][3 - 1] == code
    rules = lambda mode, **change: {(r["field"], r["code"]) for r in C.metadata_problems(C.metadata_row(spark, {k: v for k, v in (META | change).items() if v != "drop"}), mode, "2026-27").collect()}
    assert rules("production") == set()
    assert rules("production", retrieved_at=None, generated_at="x", source_locator="/etc/x", source_event_time="x", season="2026-28", artifact_version=1, schema_version="drop", redaction_status="synthetic", source_system="x") == {
        ("retrieved_at", "invalid_timestamp"), ("generated_at", "must_be_null"), ("source_locator", "unsafe"), ("source_event_time", "invalid_timestamp"), ("season", "invalid_season"), ("artifact_version", "unsupported_version"),
        ("schema_version", "missing"), ("schema_version", "unsupported_version"), ("redaction_status", "invalid_value"), ("source_system", "invalid_value"),
    }
    fixture = META | {"source_system": "synthetic", "redaction_status": "synthetic", "retrieved_at": None, "generated_at": "2026-08-07T20:00:00Z"}
    assert C.load_synthetic(spark, put(tmp_path, content({}), fixture, "fixture"), "2026-27", "2026-08-08T00:00:00Z").unique.count() == 1
    (tmp_path / "in").mkdir()
    bad = C.path_problems(spark, str(tmp_path / "in"), str(tmp_path / "A.csv"), str(tmp_path / "in" / ".." / "x.txt")).collect()
    assert {(r["field"], r["code"]) for r in bad} == {("input_storage", "outside_private"), ("input_basename", "unsafe_basename"), ("output_storage", "outside_private"), ("output_basename", "unsafe_basename")}
    assert codes(spark, str(tmp_path / "nothing.csv")) == [("metadata", None, "sidecar", "missing"), ("file", None, "input", "unreadable")]
    assert codes(spark, put(tmp_path, b"a,b\r\n", name="b"), season="x") == [("metadata", None, "selected_season", "invalid_season"), ("file", None, "header", "header_mismatch")]
