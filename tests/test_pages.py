import json

import pytest

from attestry import cli
from attestry.errors import CollectionError, SeasonError, StructureError
from attestry.sources import browser, html_table, pages

SITE = "https://h.example/players/"
HEADINGS = ["", "Player", "2026-27", "2027-28"]


def shown(n, last=3, **change):
    rows = [{"display_text": f"P{n}.{i}", "url": f"/p/{n}{i}/", "logo_url": "/logos/9.png", "rank_text": str(i), "description": None, "cells": [{"heading": "2026-27", "salary_text": "$1", "marker_text": ""}, {"heading": "2027-28", "salary_text": "-", "marker_text": "P"}]} for i in (1, 2)]
    return {"indicator_text": f"{n} of {last}", "back_disabled": n == 1, "forward_disabled": n == last, "headings": HEADINGS, "rows": rows, "content_token": f"t{n}"} | change


class Fake:
    def __init__(self, *snapshots, fails=None):
        self.snapshots, self.at, self.closed, self.fails = snapshots, 0, 0, fails

    def open(self, season):
        self.season = season

    def snapshot(self):
        return self.snapshots[0]

    def advance(self, before):
        if self.fails:
            raise self.fails
        self.at += 1
        return self.snapshots[self.at]

    def close(self):
        self.closed += 1


def test_a_walk_is_imported_once(spark, tmp_path):
    source = Fake(*(shown(n) for n in (1, 2, 3)))
    made = pages.import_pages(spark, source, "2026-27", str(tmp_path / "a.json"), SITE, lambda: "2026-08-07T20:00:00Z")
    assert source.closed == 1 and made["collection"] == {"observed_page_count": 3, "total_physical_row_count": 6, "page_counts": {1: 2, 2: 2, 3: 2}}
    first = made["data"][0]
    assert (first["player_id"], first["team_logo_url"], first["team_logo_asset_id"], first["target_season_salary_text"], first["source_locator"]) == ("11", "https://h.example/logos/9.png", "9", "$1", f"{SITE}#rendered-page-1")
    assert json.loads((tmp_path / "a.json").read_text())["metadata"]["retrieved_at"] == "2026-08-07T20:00:00Z"
    with pytest.raises(SeasonError):
        pages.import_pages(spark, Fake(), "2026-28", str(tmp_path / "b.json"), SITE, lambda: "x")
    assert not (tmp_path / "b.json").exists()


@pytest.mark.parametrize(
    "snapshots,error,says",
    [
        ([shown(1), shown(1), shown(3)], CollectionError, "step"), ([shown(1), shown(2, rows=[]), shown(3)], CollectionError, "empty_page"), ([shown(1), shown(2, content_token="t1"), shown(3)], CollectionError, "content_unchanged"),
        ([shown(1), shown(2, last=4), shown(3), shown(4, last=4)], CollectionError, "final_page_changed"), ([shown(1, indicator_text="x")], CollectionError, "paginator"), ([shown(1, last=1, headings=["", "Player", "2025-26", "x"])], StructureError, "season_missing"),
        ([shown(1, last=1, headings=["", "Name", "2026-27", "2027-28"])], StructureError, "header_shape"), ([shown(1, last=1, rows=[shown(1)["rows"][0] | {"cells": []}])], StructureError, "row 1: cell count"), ([shown(1, last=1, rows=[shown(1)["rows"][0] | {"logo_url": ""}])], StructureError, "row 1: bad logo"),
    ],
)
def test_faulty_walks(spark, tmp_path, snapshots, error, says):
    source = Fake(*snapshots)
    with pytest.raises(error, match=says):
        pages.import_pages(spark, source, "2026-27", str(tmp_path / "a.json"), SITE, lambda: "2026-08-07T20:00:00Z")
    assert source.closed == 1 and not list(tmp_path.iterdir())


def test_gaps_of_any_size_cost_a_row(spark):
    raw = spark.createDataFrame([(1, json.dumps(shown(1, last=999_999_999)))], "walk int, value string")
    found = pages.walk_problems(pages.numbered(pages.decode(raw)).withColumn("n_rows", pages.F.size("rows"))).collect()
    assert ("missing_page", 2) in {(r["problem"], r["page"]) for r in found}


def test_saved_html_has_placeholders_and_no_surplus_cells():
    headings, rows = html_table.snapshot('<table><tr><th></th><th>Player</th><th>2026-27</th></tr><tr><td>only</td></tr><tr aria-description="n"><td>1</td><td>A</td><td><sup>TW</sup> $1 </td><td>more</td></tr></table>')
    assert headings == ["", "Player", "2026-27"] and rows[0] == {"display_text": "", "url": None, "logo_url": "", "rank_text": "only", "description": None, "cells": []}
    assert rows[1]["cells"] == [{"heading": "2026-27", "salary_text": "$1", "marker_text": "TW"}] and rows[1]["description"] == "n" and rows[1]["display_text"] == "A"


class Page:
    """A browser's page that answers each script with what is given for it."""

    def __init__(self, snapshots, controls=True, late=False):
        self.snapshots, self.at, self.controls, self.late, self.seen = snapshots, 0, controls, late, []

    def goto(self, url):
        self.seen.append(url)

    def evaluate(self, script, arg=None):
        if script == browser.CHOOSE:
            return self.controls
        if script == browser.FORWARD:
            self.at += 1
            return self.at < len(self.snapshots)
        return self.snapshots[self.at]

    def wait_for_function(self, script, arg=None, timeout=None):
        if self.late and script == browser.ADVANCED:
            raise RuntimeError("late")


def opened(page):
    closed = []
    source = browser.BrowserSource(SITE, choices=(("All salaries", ""),), opener=lambda url: (page, lambda: closed.append(1)))
    return source, closed


def test_browser_source(spark, tmp_path, capsys):
    source, closed = opened(Page([shown(1, last=2), shown(2, last=2)]))
    assert cli.main(["pages", "--url", SITE, "--season", "2026-27", "--output", str(tmp_path / "a.json")], spark, source=lambda url: source, now=lambda: "2026-08-07T20:00:00Z") == 0
    assert capsys.readouterr().out == "pages=2 rows=4\n" and closed == [1]
    source.close()
    assert closed == [1]
    with pytest.raises(CollectionError):
        source.snapshot()
    for page, error in ((Page([shown(1)], controls=False), StructureError), (Page([{"error": "no_pager"}]), StructureError), (Page([shown(1), shown(2)], late=True), CollectionError), (Page([shown(1)]), StructureError)):
        source, closed = opened(page)
        with pytest.raises(error):
            pages.walk(source, "2026-27")
        assert closed == [1]


def test_entry_point_says_what_is_wrong(spark, tmp_path, capsys):
    assert cli.main(["csv", "--input", str(tmp_path / "a.csv"), "--root", str(tmp_path), "--season", "2026-27", "--output", str(tmp_path / "o.json")], spark) == 1
    said = capsys.readouterr()
    assert "sidecar: missing" in said.err and "input: unreadable" in said.err and not said.out
