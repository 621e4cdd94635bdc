"""Queries of row rules, imports and validated aggregation over rows made from the driver's orders, customers and suppliers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.functions import encoding as E
from attestry.functions import scalars as S
from attestry.functions import unicode as U
from attestry.operators import aggregate, dedup, policy, reconcile
from attestry.operators import rows as R
from attestry.plans.queries import document_rows, query, read
from attestry.session import scratch, settled
from attestry.sources import csv_import, html_table, pages, publish, strict_csv

SEASON = "2026-27"
AT = "2026-08-07T20:00:00Z"


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as priced rows of customers: ids, links or names, images, notes and two seasons each."""
    k, who = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    text = F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.concat(F.lit("$"), F.format_number(F.floor("o_totalprice"), 0)))
    marker = F.when(F.col("o_orderpriority").startswith("1"), " TW").when(F.col("o_orderpriority").startswith("2"), "H").otherwise(" ")
    rows = read(spark, sf_dir, "orders").withColumns({"__text": text, "__marker_text": marker})
    cell = lambda h, t, m: F.struct(F.lit(h).alias("heading"), t.alias("salary_text"), m.alias("marker_text"))
    rows = rows.select(
        (k + 1).cast("int").alias("input_position"), F.lit(SEASON).alias("target_season"), (k % 27 + 1).cast("int").alias("source_page_number"), (k + 1).cast("int").alias("source_row_position"), F.lit("").alias("rank_text"),
        F.concat(F.lit("Customer  "), who, F.when(k % 5 == 0, " ß").otherwise("")).alias("player_display_text"), F.when(k % 3 == 1, F.concat(F.lit("/P/"), who, F.lit("/?q="), k.cast("string"))).alias("player_url"), F.when(k % 3 == 0, who).alias("player_id"),
        F.concat(F.lit("https://CDN.Example.test/logos/"), (k % 30).cast("string"), F.lit(".png?w="), k.cast("string")).alias("team_logo_url"), F.when(k % 2 == 0, (k % 30).cast("string")).alias("team_logo_asset_id"), F.col("__text").alias("target_season_salary_text"),
        F.col("__marker_text").alias("target_season_marker_text"), F.when(k % 11 == 0, "note  x").when(k % 11 == 1, " ").alias("source_row_description"), F.lit("exports/orders").alias("source_locator"), F.lit(AT).alias("imported_at"),
        F.array(cell("2027-28", F.lit("-"), F.lit("P")), cell(SEASON, F.col("__text"), F.trim(F.col("__marker_text")))).alias("salary_season_cells"),
    )
    return settled(rows)  # so that rules see columns and not what they are made of


def _s(x: str) -> str:
    return f"('53' || printf('%016X', octet_length(encode({x}))) || hex(encode({x})))"


def _i(x: str) -> str:
    h = f"printf('%X', {x})"
    return f"('49' || printf('%016X', (length({h}) + 1) // 2) || case when length({h}) % 2 = 1 then '0' else '' end || {h})"


def _l(x: str) -> str:
    return f"('4C' || printf('%016X', length({x}) // 2) || {x})"


_N = "'4E0000000000000000'"
PRICED_SQL = f"""
o as (select o_orderkey as k, o_custkey as c, case when o_orderstatus <> 'P' then cast(floor(o_totalprice) as bigint) end as amount,
  case when o_orderpriority like '1%' then 'TW' when o_orderpriority like '2%' then 'H' else '' end as marker, 'customer ' || o_custkey || case when o_orderkey % 5 = 0 then ' ss' else '' end as name from orders),
keyed as (select *, case k % 3 when 0 then 'player_id' when 1 then 'player_url' else 'player_display_text' end as kind, case k % 3 when 0 then cast(c as varchar) when 1 then '/P/' || c || '/' else name end as value from o),
h1 as (select *, {_s('kind')} || case when k % 3 = 0 then {_i('c')} else {_s('value')} end as who,
  case when k % 2 = 0 then {_s("'team_logo_asset_id'")} || {_i('k % 30')} else {_s("'team_logo_url'")} || {_s("'https://cdn.example.test/logos/' || (k % 30) || '.png'")} end as team,
  case when amount is null then {_N} else {_i('amount')} end as amt, case when k % 11 = 0 then {_s("'note x'")} else {_N} end as note from keyed),
h2 as (select *, {_s(f"'{SEASON}'")} || amt || {_s('marker')} as c1, {_s("'2027-28'")} || {_N} || {_s("'P'")} as c2 from h1),
h3 as (select *, {_l('c1')} || {_l('c2')} as cs from h2),
h4 as (select *, {_s("'target_season'")} || {_s(f"'{SEASON}'")} as f1, {_s("'player_identity'")} || {_l('who')} as f2, {_s("'team_identity'")} || {_l('team')} as f3, {_s("'target_season_salary_dollars'")} || amt as f4,
  {_s("'target_season_marker'")} || {_s('marker')} as f5, {_s("'source_row_description'")} || note as f6, {_s("'salary_season_cells'")} || {_l('cs')} as f7 from h3),
h5 as (select *, {' || '.join(_l(f'f{i}') for i in range(1, 8))} as body from h4),
rows_ as (select k + 1 as k, c, kind, value, amount, marker, '{E.PREFIX}' || sha256(unhex('{E.DOMAIN.hex()}' || {_l('body')})) as fingerprint from h5)
"""


@query(f"with {PRICED_SQL} select cast(k as integer) as input_position, kind, value, fingerprint, cast(amount as varchar) as amount from rows_")
def row_fingerprints(spark, sf_dir):
    made = settled(R.with_payload(settled(R.normalised(priced(spark, sf_dir)))).where(F.size("problems") == 0))
    return R.with_identity(made).select("input_position", "player.kind", "player.value", "fingerprint", F.col(R.AMOUNT).alias("amount"))


@query("""select cast(o_orderkey + 1 as integer) as input_position, case (o_orderkey + 1) % 7 when 1 then 'player_display_text:empty_identity' when 2 then 'player_url:invalid_url' when 3 then 'salary_season_cells:target_cell_count' when 4 then 'team_logo_url:invalid_url'
when 5 then 'target_season_salary_dollars:inconsistent_amount salary_season_cells:target_cell_mismatch' when 6 then 'salary_season_cells:duplicate_heading' else '' end as problems from orders""")
def row_rules(spark, sf_dir):
    k = F.col("input_position") % 7
    cells = F.col("salary_season_cells")
    rows = R.normalised(priced(spark, sf_dir)).withColumns({
        "player_display_text": F.when(k == 1, " \t").otherwise(F.col("player_display_text")), "player_url": F.when(k == 2, "ftp://x").otherwise(F.col("player_url")),
        "salary_season_cells": F.when(k == 3, F.slice(cells, 1, 1)).when(k == 6, F.concat(cells, F.slice(cells, 1, 1))).otherwise(cells), "team_logo_url": F.when(k == 4, "http://:80/x").otherwise(F.col("team_logo_url")),
        R.AMOUNT: F.when(k == 5, "1").otherwise(F.col(R.AMOUNT)),
    })
    return R.with_payload(settled(rows)).select("input_position", F.array_join("problems", " ").alias("problems"))


@query("""select cast(o_orderkey + 1 as integer) as input_position, case when (o_orderkey + 1) % 4 in (1, 2) or o_orderstatus = 'P' then null else cast(cast(floor(o_totalprice) as bigint) as varchar) end as amount,
case (o_orderkey + 1) % 4 when 1 then 'malformed target_season_salary_text' when 2 then 'missing target_season_salary_text' when 3 then 'invalid source_page_number' end as problem from orders""")
def row_amounts(spark, sf_dir):
    k = F.col("input_position") % 4
    rows = priced(spark, sf_dir).withColumns({"target_season_salary_text": F.when(k == 1, "12,34").when(k == 2, F.lit(None)).otherwise(F.col("target_season_salary_text")), "source_page_number": F.when(k == 3, 0).otherwise(F.col("source_page_number"))})
    return R.with_amounts(rows).select("input_position", F.col(R.AMOUNT).alias("amount"), F.col("amount_problem").alias("problem"))


def fingerprinted_orders(spark: SparkSession, sf_dir: str) -> dedup.Deduplicated:
    rows = settled(R.with_payload(settled(R.normalised(priced(spark, sf_dir)))).drop("problems"))
    return dedup.Deduplicated(*(settled(x) for x in dedup.deduplicate(rows)))


FORGED_SQL = f"""with {PRICED_SQL}, u as (select fingerprint, min(k) as k from rows_ group by 1)
select cast(k as bigint) as position, fingerprint, 'fingerprint differs' as problem from u where k % 50 = 1
union all select cast(k as bigint), fingerprint, 'another season' from u where k % 50 = 2
union all select null, fingerprint, 'provenance_differs' from u where k % 50 = 3
union all select cast(k as bigint), 'x', 'invalid fingerprint' from u where k % 50 = 4 union all select cast(k as bigint), 'x', 'fingerprint differs' from u where k % 50 = 4
union all select null, 'x', 'no_occurrence' from u where k % 50 = 4 having count(*) > 0
union all select null, fingerprint, 'no_unique_row' from u where k % 50 = 4
union all select null, null, 'positions are not 1 to n' from (select count(*) n, max(k) m from rows_) where n <> m"""


@query(FORGED_SQL)
def forged_table(spark, sf_dir):
    """A table that was changed behind its fingerprints, and the audit that says where."""
    unique, occurrences = fingerprinted_orders(spark, sf_dir)
    k = F.col("input_position") % 50
    forged = unique.withColumns({
        "source_row_description": F.when(k == 1, "forged").otherwise(F.col("source_row_description")), "rank_text": F.when(k == 3, "9").otherwise(F.col("rank_text")), "fingerprint": F.when(k == 4, "x").otherwise(F.col("fingerprint")),
        "target_season": F.when(k == 2, "2027-28").otherwise(F.col("target_season")),
    })
    # a row of another season would have no canonical form, were its cells not turned round as well
    turned = F.transform("salary_season_cells", lambda c: F.struct(F.when(c["heading"] == SEASON, "2027-28").otherwise(SEASON).alias("heading"), c["salary_text"].alias("salary_text"), c["marker_text"].alias("marker_text")))
    forged = forged.withColumn("salary_season_cells", F.when(k == 2, turned).otherwise(F.col("salary_season_cells")))
    found = settled(aggregate.deduplication_problems(dedup.Deduplicated(forged, occurrences), SEASON))
    # the digest of a row that says another season differs too, which the rule of the season stands for here
    two = found.where("problem = 'another season'").select(F.col("position").alias("p"))
    return found.join(two, (F.col("position") == F.col("p")) & (F.col("problem") == "fingerprint differs"), "left_anti").where("problem <> 'repeated_unique_row'")


TOTALS_SQL = f"""with {PRICED_SQL}, u as (select min(k) as k, fingerprint, any_value(kind) as kind, any_value(value) as value, any_value(amount) as amount, any_value(marker) as marker from rows_ group by fingerprint),
d as (select *, case when amount is null then 'excluded' when marker <> '' or (k - 1) % 11 = 0 or count(amount) over (partition by kind, value) > 1 then 'review_required' else 'included' end as status from u)
select kind, value, cast(min(k) as integer) as first_position, 'Customer  ' || arg_min(c2, k) as display, count(*) filter (status = 'included') as n_included, count(*) filter (status = 'excluded') as n_excluded, count(*) filter (status = 'review_required') as n_review_required,
  cast(coalesce(sum(amount) filter (status = 'included'), 0) as varchar) as subtotal, case when count(*) filter (status = 'review_required') = 0 then cast(coalesce(sum(amount) filter (status = 'included'), 0) as varchar) end as total,
  case when count(*) filter (status = 'review_required') = 0 then 'complete' else 'review_required' end as completion, string_agg(k || ' ' || status, ',' order by k) as dispositions
from (select d.*, o_custkey || case when o_orderkey % 5 = 0 then ' ß' else '' end as c2 from d join orders on o_orderkey + 1 = k) group by kind, value"""


@query(TOTALS_SQL)
def player_totals(spark, sf_dir):
    """Of a table whose fingerprints are made anew and whose trail is audited first; positions that lack in the orders are closed up before."""
    unique, occurrences = fingerprinted_orders(spark, sf_dir)
    made = settled(aggregate.dispositions(unique))
    per = aggregate.player_totals(made)
    return per.withColumn("dispositions", F.array_join(F.transform("dispositions", lambda d: F.concat(d["input_position"].cast("string"), F.lit(" "), d["status"])), ","))


@query("""select r_regionkey as k, case r_regionkey when 0 then 'artifact_version:unsupported_version retrieved_at:invalid_timestamp' when 1 then 'league_scope:must_be_null season:season_mismatch' when 2 then 'more:extra schema_version:missing schema_version:unsupported_version'
when 3 then 'source_locator:unsafe source_system:invalid_value' else 'generated_at:must_be_null redaction_status:invalid_value season:invalid_season source_event_time:invalid_timestamp' end as problems from region""")
def sidecar_rules(spark, sf_dir):
    good = {"source_system": csv_import.SOURCE_SYSTEM, "source_locator": "exports/a.csv", "retrieved_at": AT, "generated_at": None, "source_event_time": None, "season": SEASON, "league_scope": None, "artifact_version": "1.0", "schema_version": "1.0", "redaction_status": "unredacted-local"}
    bad = [
        {"artifact_version": 1, "retrieved_at": "2026-02-30T00:00:00Z"}, {"league_scope": "x", "season": "2027-28"}, {"more": 1, "schema_version": ...}, {"source_locator": "https://u@h/a", "source_system": "x"},
        {"generated_at": AT, "redaction_status": "synthetic", "season": "2026-28", "source_event_time": "now"},
    ]
    made = [csv_import.metadata_row(spark, {k: v for k, v in (good | b).items() if v is not ...}).withColumn("record_number", F.lit(i).cast("long")) for i, b in enumerate(bad)]
    every = made[0]
    for x in made[1:]:
        every = every.unionByName(x)
    found = csv_import.metadata_problems(every, "production", SEASON)
    per = found.groupBy("record_number").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "field", "code"))), " ").alias("problems"))
    return read(spark, sf_dir, "region").join(per, F.col("r_regionkey") == F.col("record_number")).select(F.col("r_regionkey").alias("k"), "problems")


def customer_csv(spark: SparkSession, sf_dir: str, faulty: bool) -> str:
    """Customers as a file of the import, in their order; the faulty one breaks a rule in most records."""
    k = F.col("c_custkey")
    text = F.concat(F.lit("$"), F.format_number(F.floor(F.abs("c_acctbal")), 0))
    cells = F.to_json(F.array(F.struct(F.lit(SEASON).alias("heading"), text.alias("salary_text"), F.lit("").alias("marker_text"))))
    bad = lambda code, value, good: F.when(k % 12 == code, value).otherwise(good) if faulty else good
    quoted = lambda c: F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))
    none = F.lit("")
    two = F.regexp_replace(cells, r"\]\z", "," + json.dumps({"heading": "2027", "salary_text": "1.5", "marker_text": 7}) + "]")
    said = bad(1, F.lit("[]"), bad(2, F.regexp_replace(cells, r"\]\z", ",{}]"), bad(3, two, bad(4, F.regexp_replace(cells, SEASON, "2027-28"), cells))))
    fields = [
        quoted(bad(5, F.lit(" "), F.col("c_name"))), bad(6, F.lit("ftp://x"), none), bad(7, F.lit("1a"), k.cast("string")), none, bad(8, F.lit("/x.png"), F.lit("https://h.example/logos/1.png")), none, bad(9, F.lit("2026-28"), F.lit(SEASON)), quoted(bad(10, F.lit("1.5"), text)), none, none, quoted(said), none,
    ]
    line = F.concat_ws(",", *fields)
    line = F.when(k % 12 == 11, "x,y").otherwise(line) if faulty else line
    path = scratch(spark)
    rows = read(spark, sf_dir, "customer").select(k.alias("k"), line.alias("value"))
    head = spark.range(1).select(F.lit(-1).cast("long").alias("k"), F.lit(",".join(csv_import.HEADER)).alias("value"))
    head.unionByName(rows).coalesce(1).sortWithinPartitions("k").select("value").write.option("lineSep", "\r\n").text(path)  # a file is one value of the reader
    return path


@query("""with f as (select c_custkey as k, row_number() over (order by c_custkey) as n from customer), cells as (select 'salary_season_cells_json' as f)
select n as record_number, unnest(case k % 12 when 1 then ['salary_season_cells_json:wrong_json_shape'] when 2 then ['salary_season_cells_json:invalid_cell_shape'] when 3 then ['salary_season_cells_json:invalid_cell_type'] when 4 then ['salary_season_cells_json:target_cell_count']
when 5 then ['player_display_text:empty_identity'] when 6 then ['player_url:invalid_url'] when 7 then ['player_id:invalid_unsigned_integer'] when 8 then ['team_logo_url:invalid_url'] when 9 then ['target_season:invalid_season', 'salary_season_cells_json:target_cell_count']
when 10 then ['target_season_salary_text:invalid_salary', 'salary_season_cells_json:target_cell_mismatch'] when 11 then ['record:column_count'] else [] end) as problem from f""")
def csv_record_problems(spark, sf_dir):
    records = strict_csv.as_columns(strict_csv.read_strict_csv(spark, customer_csv(spark, sf_dir, True), csv_import.HEADER), csv_import.HEADER)
    return csv_import.record_problems(settled(records), SEASON).select("record_number", F.concat_ws(":", "field", "code").alias("problem"))


@query(f"""select cast(row_number() over (order by c_custkey) as integer) as input_position, cast(c_custkey as varchar) as player_id, cast(cast(floor(abs(c_acctbal)) as bigint) as varchar) as amount, c_name as name,
'exports/a.csv (CSV data record ' || row_number() over (order by c_custkey) || ')' as source_locator, true as reloaded from customer""")
def csv_import_rows(spark, sf_dir):
    """From a file by rows and payloads to what is derived, and back from it."""
    records = settled(strict_csv.as_columns(strict_csv.read_strict_csv(spark, customer_csv(spark, sf_dir, False), csv_import.HEADER), csv_import.HEADER))
    rows = settled(R.with_payload(settled(R.normalised(csv_import.raw_rows(records, "exports/a.csv", AT)))).drop("problems"))
    made = dedup.deduplicate(rows)
    back = settled(csv_import.decoded(settled(csv_import.encoded(made.unique.drop("payload")))))
    anew = R.with_payload(back.drop("decode_problem").withColumnRenamed("fingerprint", "told"))
    return anew.select("input_position", "player_id", F.col(R.AMOUNT).alias("amount"), F.col("player_display_text").alias("name"), "source_locator", (F.col("told") == F.col("fingerprint")).alias("reloaded"))


def supplier_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as landed HTML, 20 to a page."""
    k = F.col("s_suppkey")
    row = F.concat(
        F.lit('<tr data-description="d &amp; e"><td>'), k.cast("string"), F.lit('</td><td><img src="/logos/'), (k % 30).cast("string"), F.lit('.png"><a href="/p/'), k.cast("string"), F.lit('/">'), F.col("s_name"), F.lit("</a></td><td><sup>TW</sup>$"), k.cast("string"), F.lit("</td><td>-</td></tr>"),
    )
    numbers = read(spark, sf_dir, "supplier").withColumns({"n": F.floor(k / 20).cast("int") + 1, "row": row})
    per = numbers.groupBy("n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), "row"))), lambda x: x["row"]), "").alias("body"))
    last = read(spark, sf_dir, "supplier").agg((F.floor(F.max("s_suppkey") / 20) + 1).cast("int").alias("m"))
    html = F.concat(F.lit(f"<table><thead><tr><th></th><th>Player</th><th>{SEASON}</th><th>2027-28</th></tr></thead><tbody>"), "body", F.lit("</tbody></table>"))
    return per.crossJoin(F.broadcast(last)).select(F.col("n").alias("walk"), F.concat(F.col("n").cast("string"), F.lit(" of "), F.col("m").cast("string")).alias("indicator_text"), (F.col("n") == 1).alias("back_disabled"), (F.col("n") == F.col("m")).alias("forward_disabled"), html.alias("html"))


@query(f"""select cast(s_suppkey // 20 + 1 as integer) as source_page_number, cast(s_suppkey % 20 + 1 as integer) as source_row_position, s_name as player_display_text, cast(s_suppkey as varchar) as player_id, cast(s_suppkey % 30 as varchar) as team_logo_asset_id,
'https://h.example/logos/' || s_suppkey % 30 || '.png' as team_logo_url, '$' || s_suppkey as target_season_salary_text, 'TW' as target_season_marker_text, 'd & e' as source_row_description, 'https://h.example/#rendered-page-' || (s_suppkey // 20 + 1) as source_locator from supplier""")
def page_rows(spark, sf_dir):
    """Saved HTML to snapshots, a proved walk, and rows."""
    landed = pages.from_html(supplier_pages(spark, sf_dir), "html")
    rows = pages.collected(settled(landed), SEASON, AT, "https://h.example/")
    return rows.select("source_page_number", "source_row_position", "player_display_text", "player_id", "team_logo_asset_id", "team_logo_url", "target_season_salary_text", "target_season_marker_text", "source_row_description", "source_locator")


@query("""select cast(k % 6 as integer) as page, p as problem from (select unnest(range(0, 6)) as k), (select unnest(['season_missing', 'season_repeated', 'header_shape', 'row 1: missing display text', 'row 1: bad logo', 'row 1: cell headings']) as p, unnest(range(0, 6)) as j) where k = j""")
def page_faults(spark, sf_dir):
    cell = lambda h: F.struct(F.lit(h).alias("heading"), F.lit("$1").alias("salary_text"), F.lit("").alias("marker_text"))
    k = F.col("r_regionkey")
    base = read(spark, sf_dir, "region").select(k.cast("int").alias("page")).unionByName(spark.range(5, 6).select(F.col("id").cast("int").alias("page")))
    p = F.col("page")
    row = F.struct(F.when(p == 3, "").otherwise("A").alias("display_text"), F.lit(None).cast("string").alias("url"), F.when(p == 4, "ftp://x").otherwise("/logos/1.png").alias("logo_url"), F.lit("1").alias("rank_text"), F.lit(None).cast("string").alias("description"), F.array(cell(SEASON), F.when(p == 5, cell("x")).otherwise(cell("2027-28"))).alias("cells"))
    head = F.when(p == 0, F.array(*map(F.lit, ("", "Player", "2025-26", "2027-28")))).when(p == 1, F.array(*map(F.lit, ("", "Player", SEASON, SEASON)))).when(p == 2, F.array(*map(F.lit, ("", "Name", SEASON, "2027-28")))).otherwise(F.array(*map(F.lit, ("", "Player", SEASON, "2027-28"))))
    found = pages.page_problems(base.select(p, head.alias("headings"), F.array(row).alias("rows")), SEASON, "https://h.example/")
    return found.where("page > 2 or problem not like 'row%'").select("page", "problem")


@query("""select doc_id, lower(replace(trim(regexp_replace(nfc_normalize(coalesce(source, '') || '  Straße ' || doc_id), '[ \t]+', ' ', 'g')), 'ß', 'ss')) as name from documents""")
def folded_names(spark, sf_dir):
    text = F.concat(F.coalesce("source", F.lit("")), F.lit("  Straße "), F.col("doc_id").cast("string"))
    return read(spark, sf_dir, "documents").select("doc_id", U.folded(text).alias("name"))


@query("""select p_partkey, case p_partkey % 18 when 0 then true when 1 then true when 2 then true when 3 then true else false end as safe from part""")
def locator_rules(spark, sf_dir):
    values = ["exports/a.csv", "https://h/a#x?y", "commissioner salary CSV: a", "https://[::1]:8/a", " exports/a.csv ", "http:///x", "exports/file://q", "a​b", "Authorization", "x-bearer", "COOKIE", "session.csv", "\\\\host", "~/x", "C:\\x", "http://:80/x", "https://h?q=1", "https://[x"]
    said = F.get(F.array(*map(F.lit, values)), (F.col("p_partkey") % len(values)).cast("int"))
    return read(spark, sf_dir, "part").select("p_partkey", S.is_safe_locator(said).alias("safe"))


@query("select o_orderkey, case when o_orderkey % 2 = 0 then 'unknown' end as problem from orders where o_orderkey % 2 = 0")
def unknown_decisions(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.lit(1).alias("amount"))
    made = rows.select("o_orderkey", F.lit("excluded").alias("status"), F.lit("seen").alias("reason"))
    return policy.check_decisions(rows.where("o_orderkey % 2 = 1"), made, "o_orderkey", "amount")


@query("""with d as (select text, lang, min(doc_id) as at from documents group by 1, 2) select 'equivalent' as side, count(*) as n from d having count(*) > 0""")
def checked_reconciliation(spark, sf_dir):
    """With the checks of repeats and collisions: a source against itself."""
    unique = settled(dedup.deduplicate(document_rows(spark, sf_dir)).unique)
    return reconcile.reconcile(unique, unique).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query("select cast(count(*) as bigint) as pages_, cast(sum(n) as bigint) as rows_ from (select conv_id, count(*) as n from conversations group by 1)")
def envelope_counts(spark, sf_dir):
    counts = {r["conv_id"]: r["n_rows"] for r in pages.page_counts(read(spark, sf_dir, "conversations"), "conv_id").collect()}
    made = publish.envelope(dict.fromkeys(publish.METADATA), {}, [{}] * sum(counts.values()), counts)
    return spark.createDataFrame([(len(made["collection"]["page_counts"]), len(made["data"]))], "pages_ long, rows_ long")


