"""Queries over the driver's tables, each one operator of the engine, with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.functions import encoding as E
from attestry.functions import scalars as S
from attestry.functions import unicode as U
from attestry.operators import audit, dedup, diagnostics, policy, reconcile
from attestry.session import scratch
from attestry.sources import html_table, pages, strict_csv, strict_json

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ fingerprints and deduplication

DOCUMENT_FP = f"""
v as (select *, case when lang is null then '4E0000000000000000' else '53' || printf('%016X', octet_length(encode(lang))) || hex(encode(lang)) end as lv,
      case when text is null then '4E0000000000000000' else '53' || printf('%016X', octet_length(encode(text))) || hex(encode(text)) end as tv from documents),
f as (select *, '530000000000000004' || hex(encode('lang')) || lv as a, '530000000000000004' || hex(encode('text')) || tv as b from v),
g as (select *, '4C' || printf('%016X', length(a) // 2) || a || '4C' || printf('%016X', length(b) // 2) || b as p from f),
fp as (select doc_id, lang, text, source, '4C' || printf('%016X', length(p) // 2) || p as payload, '{E.PREFIX}' || sha256(unhex('{E.DOMAIN.hex()}' || '4C' || printf('%016X', length(p) // 2) || p)) as fingerprint from g)
"""


def document_rows(spark: SparkSession, sf_dir: str, digest=E.sha256_hex) -> DataFrame:
    rows = read(spark, sf_dir, "documents").withColumn("payload", E.payload({c: E.nullable(E.encode_string, F.col(c)) for c in ("lang", "text")}))
    return rows.select(F.col("doc_id").alias("input_position"), "lang", "source", "payload", E.fingerprint(F.col("payload"), digest=digest).alias("fingerprint"))


@query(f"with {DOCUMENT_FP} select doc_id as input_position, fingerprint from fp")
def fingerprint_rows(spark, sf_dir):
    return document_rows(spark, sf_dir).select("input_position", "fingerprint")


@query(f"with {DOCUMENT_FP} select min(doc_id) as input_position, fingerprint, count(*) as n_occurrences from fp group by fingerprint")
def dedup_unique(spark, sf_dir):
    return dedup.deduplicate(document_rows(spark, sf_dir), check=False).unique.select("input_position", "fingerprint", "n_occurrences")


@query(f"with {DOCUMENT_FP} select doc_id as input_position, fingerprint, min(doc_id) over (partition by fingerprint) as representative_position from fp")
def dedup_occurrences(spark, sf_dir):
    return dedup.deduplicate(document_rows(spark, sf_dir), check=False).occurrences.select("input_position", "fingerprint", "representative_position")


@query(f"with {DOCUMENT_FP} select '{E.PREFIX}' || substr(fingerprint, {len(E.PREFIX) + 1}, 2) as fingerprint, count(*) as n_rows from fp group by 1 having min(payload) <> max(payload)")
def collision_audit(spark, sf_dir):
    """With a digest of two digits, so that there are collisions."""
    return dedup.collisions(document_rows(spark, sf_dir, digest=lambda c: F.substring(F.sha2(c, 256), 1, 2)))


@query(f"with {DOCUMENT_FP} select count(*) as physical, count(distinct fingerprint) as \"unique\", count(*) - count(distinct fingerprint) as duplicate from fp")
def run_counts(spark, sf_dir):
    return dedup.run_counts(document_rows(spark, sf_dir))


@query("""select l_orderkey, count(*) as n_rows, min(l_linenumber) as low, max(l_linenumber) as high, count(distinct l_linenumber) as n_positions from lineitem
group by 1 having min(l_linenumber) <> 1 or max(l_linenumber) <> count(*) or count(distinct l_linenumber) <> count(*)""")
def position_audit(spark, sf_dir):
    return dedup.position_gaps(read(spark, sf_dir, "lineitem"), "l_linenumber", "l_orderkey")


@query(f"""with {DOCUMENT_FP}, u as (select min(doc_id) as u_at, fingerprint as u_fp from fp where source <> 'src3' group by 2),
o as (select fingerprint as o_fp, min(doc_id) as first, min(r) as low, max(r) as high from (select *, min(doc_id) over (partition by fingerprint) as r from fp) where source <> 'src4' group by 1)
select coalesce(u_fp, o_fp) as fingerprint, case when o_fp is null then 'no_occurrence' when u_fp is null then 'no_unique_row' when low <> first then 'representative_not_first' when u_at <> first then 'position_differs' end as problem
from u full join o on u_fp = o_fp where o_fp is null or u_fp is null or low <> first or u_at <> first""")
def provenance_audit(spark, sf_dir):
    """Of a table that lacks one source against a trail that lacks another."""
    rows = document_rows(spark, sf_dir)
    unique = dedup.deduplicate(rows.where("source <> 'src3'"), check=False).unique
    trail = dedup.deduplicate(rows, check=False).occurrences.where("source <> 'src4'")
    return audit.audit(unique, trail)


@query(f"""with {DOCUMENT_FP}, a as (select fingerprint, min(doc_id) as left_position from fp where doc_id % 3 <> 0 group by 1), b as (select fingerprint, min(doc_id) as right_position from fp where doc_id % 3 <> 1 group by 1)
select coalesce(a.fingerprint, b.fingerprint) as fingerprint, case when right_position is null then 'left_only' when left_position is null then 'right_only' else 'equivalent' end as side, left_position, right_position from a full join b on a.fingerprint = b.fingerprint""")
def reconcile_sources(spark, sf_dir):
    rows = document_rows(spark, sf_dir)
    left, right = (dedup.deduplicate(rows.where(F.col("input_position") % 3 != k), check=False).unique for k in (0, 1))
    return reconcile.reconcile(left, right, check=False)


# ------------------------------------------------------------------ scalars


def rendered(price: Column, key: Column) -> Column:
    text = F.concat(F.lit("$"), F.format_number(F.floor(price), 0))
    return F.when(key % 50 == 0, F.lit("N/A")).when(key % 50 == 1, F.lit(" – ")).when(key % 50 == 2, F.concat(F.lit(" "), text, F.lit("\t"))).when(key % 50 == 3, F.concat(text, F.lit(".5"))).otherwise(text)


@query("""select l_orderkey, l_linenumber, case when l_orderkey % 50 in (0, 1, 3) then null else cast(cast(floor(l_extendedprice) as bigint) as varchar) end as amount, l_orderkey % 50 <> 3 as valid from lineitem""")
def parse_money(spark, sf_dir):
    text = rendered(F.col("l_extendedprice"), F.col("l_orderkey"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.money_amount(text).cast("string").alias("amount"), S.money_is_valid(text).alias("valid"))


@query("""with s as (select o_orderkey, year(o_orderdate) - case when month(o_orderdate) < 7 then 1 else 0 end as y from orders)
select o_orderkey, cast(y as varchar) || '-' || lpad(cast((y + 1) % 100 as varchar), 2, '0') as season, true as valid, y % 2 = 0 or (y + 1) % 100 = 0 as shifted_valid from s""")
def season_of_date(spark, sf_dir):
    season = S.season_of(F.col("o_orderdate"))
    shifted = F.when(F.substring(season, 1, 4).cast("int") % 2 == 0, season).otherwise(F.concat(F.substring(season, 1, 5), F.lit("00")))
    return read(spark, sf_dir, "orders").select("o_orderkey", season.alias("season"), S.season_is_valid(season).alias("valid"), S.season_is_valid(shifted).alias("shifted_valid"))


@query(r"""with p as (select page_id, url, regexp_extract(url, '^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)', 1) as s, regexp_extract(url, '^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)', 2) as a, regexp_extract(url, '^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)', 3) as t from pages)
select page_id, lower(s) || '://' || lower(a) || t as canonical, nullif(regexp_replace(regexp_extract(t, '/([0-9]+)/?$', 1), '^0+([0-9])', '\1'), '') as id from p""")
def canonical_url(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", S.full_http_url(F.col("url")).alias("canonical"), S.trailing_id(F.col("url")).alias("id"))


@query(r"""select page_id, case page_id % 6 when 0 then false when 1 then false when 2 then false when 3 then true when 4 then false else not contains(url, '?') end as safe from pages""")
def safe_locators(spark, sf_dir):
    url, k = F.col("url"), F.col("page_id") % 6
    made = F.when(k == 0, F.concat(F.lit("/etc/"), url)).when(k == 1, F.lit("https://user@host.example/a")).when(k == 2, F.lit("file:///a")).when(k == 3, F.lit("exports/a.csv")).when(k == 4, F.lit("https://[x")).otherwise(url)
    return read(spark, sf_dir, "pages").select("page_id", S.is_safe_locator(made).alias("safe"))


SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query(rf"select doc_id, nullif(trim(regexp_replace(nfc_normalize(text), '{SPACES}+', ' ', 'g'), ' '), '') as canonical from documents")
def canonical_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", S.canonical_description(U.nfc("text")).alias("canonical"))


@query("select o_orderkey, printf('%x', o_orderkey) as hex, o_orderkey as back from orders")
def hex_roundtrip(spark, sf_dir):
    sent = E.to_hex(F.col("o_orderkey"))
    return read(spark, sf_dir, "orders").select("o_orderkey", sent.alias("hex"), E.from_hex(sent).cast("long").alias("back"))


@query("""select event_id, event_id % 4 in (0, 3) as valid from events""")
def utc_timestamps(spark, sf_dir):
    said = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    made = F.when(F.col("event_id") % 4 == 1, F.lit("2026-02-30T00:00:00Z")).when(F.col("event_id") % 4 == 2, F.concat(said, F.lit("\n"))).otherwise(said)
    return read(spark, sf_dir, "events").select("event_id", S.is_utc_timestamp(made).alias("valid"))


@query("""select event_id, case when event_id % 3 = 0 then cast(json_extract(props, '$.k') as bigint) end as k, event_id % 3 = 0 as strict from events""")
def strict_json_values(spark, sf_dir):
    made = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, F.concat("props", F.lit(" x"))).otherwise(F.lit('{"k": 1, "k": 2}'))
    found = strict_json.canonical_json(made)
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object(found, "$.k").cast("long").alias("k"), found.isNotNull().alias("strict"))


# ------------------------------------------------------------------ policy

CLAIMS_SQL = """claims as (select o_orderkey, o_custkey, case when o_orderstatus <> 'P' then cast(floor(o_totalprice) as bigint) end as amount,
  case when o_orderpriority like '1%' then ' TW' when o_orderpriority like '2%' then 'H' else ' ' end as marker, case when o_orderkey % 11 = 0 then 'note' when o_orderkey % 11 = 1 then ' ' end as description from orders)"""
DISPOSED_SQL = f"""{CLAIMS_SQL},
decisions as (select o_orderkey, case when amount is null or o_orderkey % 2 = 0 then 'excluded' else 'included' end as decision from claims where o_orderkey % 97 = 0),
counted as (select claims.*, decision, count(amount) over (partition by o_custkey) as n_amounts, trim(marker) <> '' or trim(coalesce(description, '')) <> '' as evidence from claims left join decisions using (o_orderkey)),
disposed as (select *, case when decision is not null then decision when amount is null then 'excluded' when evidence or n_amounts > 1 then 'review_required' else 'included' end as status,
  case when decision = 'included' then 'decision_included' when decision is not null then 'decision_excluded' when amount is null then 'no_amount' when evidence then 'source_evidence_requires_review' when n_amounts > 1 then 'multiple_amounts' else 'single_ordinary_amount' end as reason_code,
  case when decision is null then 'default' else 'manual' end as decision_source from counted)"""


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = F.col("o_orderpriority"), F.col("o_orderkey") % 11
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") != "P", F.floor("o_totalprice")).cast("decimal(20,0)").alias("amount"),
        F.when(p.startswith("1"), " TW").when(p.startswith("2"), "H").otherwise(" ").alias("marker"), F.when(k == 0, "note").when(k == 1, " ").alias("description"),
    )


def disposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = claims(spark, sf_dir)
    made = rows.where(F.col("o_orderkey") % 97 == 0).select("o_orderkey", F.when(F.col("amount").isNull() | (F.col("o_orderkey") % 2 == 0), policy.EXCLUDED).otherwise(policy.INCLUDED).alias("status"), F.lit("reviewed").alias("reason"))
    return policy.apply_policy(rows, "o_custkey", "amount", "marker", "description", "o_orderkey", made)


@query(f"with {DISPOSED_SQL} select o_orderkey, n_amounts, status, reason_code, decision_source from disposed")
def apply_decisions(spark, sf_dir):
    return disposed(spark, sf_dir).select("o_orderkey", "n_amounts", "status", "reason_code", "decision_source")


@query(f"""with {CLAIMS_SQL} select o_orderkey, concat_ws(',', case when trim(marker) = 'TW' then 'two_way_contract_marker= TW' when trim(marker) <> '' then 'source_target_marker=' || marker end,
case when trim(coalesce(description, '')) <> '' then 'source_row_description=' || description end) as evidence from claims""")
def evidence_trail(spark, sf_dir):
    found = policy.evidence(F.col("marker"), F.col("description"))
    return claims(spark, sf_dir).select("o_orderkey", F.array_join(F.transform(found, lambda e: F.concat(e["code"], F.lit("="), e["value"])), ",").alias("evidence"))


@query(f"""with {DISPOSED_SQL}, t as (select o_custkey, min(o_orderkey) as first_position, count(*) filter (status = 'included') as n_included, count(*) filter (status = 'excluded') as n_excluded, count(*) filter (status = 'review_required') as n_review_required,
cast(coalesce(sum(amount) filter (status = 'included'), 0) as bigint) as subtotal from disposed group by 1)
select *, case when n_review_required = 0 then subtotal end as total, case when n_review_required = 0 then 'complete' else 'review_required' end as completion from t""")
def entity_totals(spark, sf_dir):
    per = policy.entity_totals(disposed(spark, sf_dir), "o_custkey", "amount", "o_orderkey")
    return per.withColumns({"subtotal": F.col("subtotal").cast("long"), "total": F.col("total").cast("long")})


@query("""select o_custkey, cast(sum(cast(o_orderkey as hugeint)) as varchar) || repeat('0', 45) as subtotal from orders group by 1""")
def unbounded_totals(spark, sf_dir):
    """Amounts of more digits than a decimal has."""
    rows = read(spark, sf_dir, "orders").select("o_custkey", F.concat(F.col("o_orderkey").cast("string"), F.repeat(F.lit("0"), 45)).alias("digits"), F.lit(policy.INCLUDED).alias("status"))
    sums = policy.entity_totals_unbounded(rows, "o_custkey", "digits")
    return sums


@query(f"""with {CLAIMS_SQL} select o_orderkey, case when o_orderkey % 5 = 1 then 'status' when o_orderkey % 5 = 2 then 'reason' else 'included_without_amount' end as problem from claims
where o_orderkey % 5 in (1, 2) or o_orderkey % 5 = 3 and amount is null""")
def decision_problems(spark, sf_dir):
    rows, k = claims(spark, sf_dir), F.col("o_orderkey") % 5
    made = rows.select("o_orderkey", F.when(k == 1, "maybe").when(k == 3, "included").otherwise("excluded").alias("status"), F.when(k == 2, " ").otherwise("seen").alias("reason"))
    return policy.check_decisions(rows, made, "o_orderkey", "amount")


@query("""select c_nationkey, min(c_custkey) as first_position, arg_min(c_name, c_custkey) as display, string_agg(cast(c_custkey as varchar), ' ' order by c_custkey) as members from customer group by 1""")
def first_seen_groups(spark, sf_dir):
    members = F.array_join(F.transform(F.array_sort(F.collect_list("c_custkey")), lambda x: x.cast("string")), " ")
    return read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.min("c_custkey").alias("first_position"), F.min_by("c_name", "c_custkey").alias("display"), members.alias("members"))


# ------------------------------------------------------------------ nested cells, diagnostics, pages, sources

CELL_KEYS = "cells as (select distinct l_orderkey, l_linenumber, first_value(cast(floor(l_extendedprice) as bigint)) over (partition by l_orderkey, l_linenumber order by l_extendedprice) as price from lineitem)"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.floor(F.min("l_extendedprice")).alias("price"))
    cell = F.struct(F.col("l_linenumber").cast("string").alias("heading"), F.format_number("price", 0).alias("salary_text"), F.lit("").alias("marker_text"))
    return one.groupBy("l_orderkey").agg(F.to_json(F.array_sort(F.collect_list(cell))).alias("cells"))


@query(f"with {CELL_KEYS} select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber) as cell_position, cast(l_linenumber as varchar) as heading, price as amount from cells")
def explode_cells(spark, sf_dir):
    rows = cells(spark, sf_dir).withColumn("report", strict_json.cell_report("cells")).select("l_orderkey", F.posexplode("report.cells").alias("k", "c"))
    return rows.select("l_orderkey", (F.col("k") + 1).cast("long").alias("cell_position"), F.col("c.heading").alias("heading"), S.money_amount(F.col("c.salary_text")).cast("long").alias("amount"))


@query(f"""with {CELL_KEYS} select l_orderkey, case l_orderkey % 4 when 0 then 'invalid_json' when 1 then 'wrong_json_shape' end as code, case when l_orderkey % 4 > 1 then count(*) end as n_cells, case when l_orderkey % 4 > 1 then count(*) filter (l_linenumber = 1) = 1 end as one_target from cells group by 1""")
def cell_rules(spark, sf_dir):
    made = F.when(F.col("l_orderkey") % 4 == 0, F.concat("cells", F.lit("]"))).when(F.col("l_orderkey") % 4 == 1, F.lit("[]")).otherwise(F.col("cells"))
    rows = cells(spark, sf_dir).select("l_orderkey", strict_json.checked_cells(made).alias("checked"))
    bad = F.col("checked").startswith("!")
    parsed = F.when(~bad, F.from_json("checked", strict_json.CELLS))
    rows = rows.withColumn("parsed", parsed)
    return rows.select("l_orderkey", F.when(bad, F.substring("checked", 2, 100)).alias("code"), F.when(~bad, F.size("parsed")).cast("long").alias("n_cells"), F.when(~bad, F.size(F.filter("parsed", lambda c: c["heading"] == "1")) == 1).alias("one_target"))


@query("""with d as (select c_custkey as record_number, 'c_acctbal' as field, 'negative' as code, 'must not be negative' as message from customer where c_acctbal < 0 union all
select c_custkey, 'c_name', 'even', 'must not be even', from customer where c_custkey % 2 = 0 union all select c_custkey, 'c_name', 'ten', 'must not end in 0' from customer where c_custkey % 10 = 0)
select 'row' as location, field, code, message, record_number, row_number() over (order by record_number, case field when 'c_name' then 1 else 2 end, code) as position from d""")
def diagnostics_ordered(spark, sf_dir):
    rules = {
        ("c_acctbal", "negative"): (F.col("c_acctbal") < 0, "must not be negative"),
        ("c_name", "even"): (F.col("c_custkey") % 2 == 0, "must not be even"),
        ("c_name", "ten"): (F.col("c_custkey") % 10 == 0, "must not end in 0"),
    }
    found = diagnostics.violations(read(spark, sf_dir, "customer"), rules, "c_custkey")
    ranked = diagnostics.positioned(found, ["c_name", "c_acctbal"])
    return ranked.select("location", "field", "code", "message", "record_number", "position")


@query("select conv_id, count(*) as n_rows from conversations group by 1")
def page_counts(spark, sf_dir):
    return pages.page_counts(read(spark, sf_dir, "conversations"), "conv_id")


@query("""select * from (values (3, 'headings_changed'), (4, 'headings_changed'), (4, 'content_unchanged'), (2, 'back_button'), (5, 'forward_button')) t(page, problem)""")
def walk_proof(spark, sf_dir):
    """Five pages of the suppliers, some of them made wrong."""
    page = F.floor((F.col("k") - 1) % 5).cast("int") + 1
    landed = read(spark, sf_dir, "region").select((F.col("r_regionkey") + 1).alias("k")).select("k", page.alias("p")).select(
        F.col("k").alias("walk"), F.concat(F.col("p").cast("string"), F.lit(" of 5")).alias("indicator_text"), (F.col("p") <= 2).alias("back_disabled"), F.lit(False).alias("forward_disabled"),
        F.when(F.col("p") == 3, F.array(F.lit("b"))).otherwise(F.array(F.lit("a"))).alias("headings"), F.lit(20).alias("n_rows"), F.when(F.col("p") == 4, F.lit("t3")).otherwise(F.concat(F.lit("t"), F.col("p").cast("string"))).alias("content_token"),
    )
    return pages.walk_problems(pages.numbered(landed))


@query(r"""with l as (select page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) as h from pages) select page_id, cast(unnest(range(1, len(h) + 1)) as integer) as link_position, unnest(h) as href from l""")
def html_links(spark, sf_dir):
    return html_table.lateral(spark, read(spark, sf_dir, "pages"), html_table.Links, "html", ("page_id",)).select("page_id", "link_position", "href")


HEADER = ("n_nationkey", "n_name", "n_regionkey")
CSV_SQL = "'n_nationkey,n_name,n_regionkey' || chr(13) || chr(10) || string_agg(n_nationkey || ',\"' || n_name || '\",' || n_regionkey || chr(13) || chr(10), '' order by n_nationkey)"


def nation_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch(spark)
    rows = read(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.col("n_nationkey").cast("string"), F.lit(',"'), "n_name", F.lit('",'), F.col("n_regionkey").cast("string")).alias("value"))
    head = spark.range(1).select(F.lit(-1).alias("n_nationkey"), F.lit(",".join(HEADER)).alias("value"))
    head.unionByName(rows).coalesce(1).sortWithinPartitions("n_nationkey").select("value").write.option("lineSep", "\r\n").text(path)
    return path


@query("select row_number() over (order by n_nationkey) as record_number, cast(n_nationkey as varchar) as n_nationkey, n_name, cast(n_regionkey as varchar) as n_regionkey from nation")
def strict_csv_scan(spark, sf_dir):
    return strict_csv.as_columns(strict_csv.read_strict_csv(spark, nation_csv(spark, sf_dir), HEADER), HEADER).select("record_number", *HEADER)


@query(f"select octet_length(encode({CSV_SQL})) as bytes, sha256({CSV_SQL}) as sha256 from nation")
def file_lineage(spark, sf_dir):
    from attestry.sources.publish import lineage

    return lineage(spark, nation_csv(spark, sf_dir)).select("bytes", "sha256")
