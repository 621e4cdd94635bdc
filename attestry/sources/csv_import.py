"""Priced rows from a strict CSV with a sidecar: rules, rows, a derived artifact, and its verified reload.

All that is wrong is reported at once, in one order; only then are rows deduplicated and published. Rules are expressions over rows, and
the sidecar is a table of one row under the same rules.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping
from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.errors import CollisionError, DiagnosticsError, PublishError
from attestry.functions import encoding as E
from attestry.functions import scalars as S
from attestry.operators import dedup, diagnostics
from attestry.operators import rows as R
from attestry.operators.aggregate import deduplication_problems
from attestry.operators.dedup import Deduplicated
from attestry.session import settled
from attestry.sources import strict_csv, strict_json
from attestry.sources.publish import METADATA

#: The columns of the CSV in their order, those that must hold something, and those whose empty text is null.
HEADER = (
    "player_display_text", "player_url", "player_id", "team_display_text", "team_logo_url", "team_logo_asset_id", "target_season", "target_season_salary_text",
    "target_season_marker_text", "source_row_description", "salary_season_cells_json", "source_row_reference",
)
REQUIRED = ("player_display_text", "team_logo_url", "target_season", "salary_season_cells_json")
NULLABLE = ("player_url", "player_id", "team_display_text", "team_logo_asset_id", "source_row_description", "source_row_reference")
#: Fixed values of the sidecar and of what is derived.
SOURCE_SYSTEM, SYNTHETIC, VERSION = "commissioner_salary_csv", "synthetic", "1.0"
REDACTION = {"production": ("unredacted-local", "redacted-reviewed"), "synthetic": ("synthetic",)}
#: Key of an integer that is sent as hexadecimal.
HEX = "unsigned_integer_hex"
FIELDS = (*METADATA, *HEADER)


class CsvImport(NamedTuple):
    deduplicated: Deduplicated
    metadata: dict
    physical: int
    lineage: dict


def utc_now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def _report(spark: SparkSession, *items: tuple[str, str, str, str]) -> DataFrame:
    return spark.createDataFrame([(*x, None) for x in items], diagnostics.SCHEMA)


# ------------------------------------------------------------------ the sidecar


def metadata_rules(mode: str, season: str | None) -> dict[tuple[str, str], tuple[Column, str]]:
    """Rules over a sidecar's row: a column for each field with its text, and one named field__kind: text, null, other or missing."""
    if mode not in REDACTION:
        raise ValueError(f"no such mode: {mode}")
    kind = lambda f: F.col(f"{f}__kind")
    null = lambda f: kind(f).isin("null", "missing")
    stamp = lambda f: (kind(f) == "text") & S.is_utc_timestamp(F.col(f))
    equals = lambda f, *values: F.coalesce((kind(f) == "text") & F.col(f).isin(*values), F.lit(False))
    right = F.coalesce((kind("season") == "text") & S.season_is_valid(F.col("season")), F.lit(False))
    stamped, empty = ("retrieved_at", "generated_at") if mode == "production" else ("generated_at", "retrieved_at")
    rules = {(f, "missing"): (kind(f) == "missing", "the field must be there") for f in METADATA}
    rules |= {
        ("source_system", "invalid_value"): (~equals("source_system", SOURCE_SYSTEM if mode == "production" else SYNTHETIC), "must name the kind of source"),
        (stamped, "invalid_timestamp"): (~stamp(stamped), "must be a UTC timestamp"),
        (empty, "must_be_null"): (~null(empty), "must be null"),
        ("source_locator", "unsafe"): (~((kind("source_locator") == "text") & S.is_safe_locator(F.col("source_locator"))), "must be a locator without secrets"),
        ("source_event_time", "invalid_timestamp"): (~null("source_event_time") & ~stamp("source_event_time"), "must be a UTC timestamp or null"),
        ("season", "invalid_season"): (~right, "must be a season, yyyy-yy"),
        ("league_scope", "must_be_null"): (~null("league_scope"), "must be null"),
        ("artifact_version", "unsupported_version"): (~equals("artifact_version", VERSION), f"must be {VERSION}"),
        ("schema_version", "unsupported_version"): (~equals("schema_version", VERSION), f"must be {VERSION}"),
        ("redaction_status", "invalid_value"): (~equals("redaction_status", *REDACTION[mode]), "isn't allowed here"),
    }
    if season is not None:
        rules["season", "season_mismatch"] = (right & (F.col("season") != season), "must be the season that was asked for")
    return rules


def metadata_row(spark: SparkSession, value: Mapping) -> DataFrame:
    """A sidecar's object as one row, with record_number null and its keys."""
    kind = lambda f: "missing" if f not in value else "null" if value[f] is None else "text" if isinstance(value[f], str) else "other"
    fields = [x for f in METADATA for x in (value[f] if kind(f) == "text" else None, kind(f))]
    schema = ", ".join(f"{f} string, {f}__kind string" for f in METADATA)
    return spark.createDataFrame([(None, sorted(map(str, value)), *fields)], f"record_number long, keys array<string>, {schema}")


def metadata_problems(rows: DataFrame, mode: str, season: str | None) -> DataFrame:
    """Diagnostics of metadata_row()s: rules, and keys that have no place, sorted."""
    found = diagnostics.violations(rows, metadata_rules(mode, season), "record_number", "metadata")
    surplus = F.array_sort(F.array_except("keys", F.array(*(F.lit(f) for f in METADATA))))
    extra = rows.select(F.lit("metadata").alias("location"), F.explode(surplus).alias("field"), F.lit("extra").alias("code"), F.lit("the field has no place here").alias("message"), "record_number")
    return found.unionByName(extra)


def parse_sidecar(content: bytes | None) -> tuple[dict | None, tuple[str, str, str, str] | None]:
    """The object of a sidecar's bytes, or the one diagnostic that says why there is none."""
    if content is None:
        return None, ("metadata", "sidecar", "missing", "the sidecar with the same name is missing or can't be read")
    if content.startswith(b"\xef\xbb\xbf"):
        return None, ("metadata", "encoding", "bom", "the sidecar must be UTF-8 without a byte order mark")
    try:
        value = strict_json.loads(content.decode())
    except UnicodeDecodeError:
        return None, ("metadata", "encoding", "invalid_utf8", "the sidecar must be valid UTF-8")
    except (ValueError, RecursionError):
        return None, ("metadata", "json", "invalid_json", "the sidecar must be one JSON object with keys that differ")
    return (value, None) if isinstance(value, dict) else (None, ("metadata", "root", "wrong_type", "the sidecar must be a JSON object"))


# ------------------------------------------------------------------ records


def cell_problems(cells: Column, season: Column, amount: Column, marker: Column) -> Column:
    """array<struct<code,cell>> of what is wrong with a record's cells, from 1; cells are null where the JSON has another shape or type.

    Cells with control characters, as those that are null, take no part in the rules after.
    """
    said = F.transform(cells, lambda c: F.when(~(c["heading"].rlike(r"\p{C}") | c["salary_text"].rlike(r"\p{C}") | c["marker_text"].rlike(r"\p{C}")), c))
    note = lambda bad, code, i: F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(code).alias("code"), (i + 1).alias("cell")))
    each = F.transform(cells, lambda c, i: F.array_compact(F.array(
        note(c.isNotNull() & F.get(said, i).isNull(), "cell_control_character", i),
        note(~S.season_is_valid(F.get(said, i)["heading"]) & F.get(said, i).isNotNull(), "invalid_heading", i),
        note(S.season_is_valid(c["heading"]) & F.exists(F.slice(said, 1, i), lambda d: d["heading"] == F.get(said, i)["heading"]), "duplicate_heading", i),
        note(F.get(said, i).isNotNull() & ~S.money_is_valid(c["salary_text"]), "invalid_cell_salary", i),
    )))
    target = F.filter(said, lambda c: c["heading"] == season)
    whole = F.lit(-1)
    last = F.array_compact(F.array(
        note(F.size(target) != 1, "target_cell_count", whole),
        note((F.size(target) == 1) & ~((F.get(target, F.lit(0))["salary_text"] == amount) & (F.get(target, F.lit(0))["marker_text"] == marker)), "target_cell_mismatch", whole),
    ))
    return F.concat(F.flatten(each), last)


def record_problems(records: DataFrame, season: str | None) -> DataFrame:
    """Diagnostics of strict_csv.as_columns() with the CSV's header, empty texts kept: a record's width, then its fields, then its cells."""
    whole = F.col("n_fields") == len(HEADER)
    col = lambda f: F.when(whole, F.col(f))
    right = S.season_is_valid(F.col("target_season"))
    rules = {
        ("record", "blank_record"): (F.col("n_fields") == 0, "blank records aren't allowed"),
        ("record", "column_count"): ((F.col("n_fields") != 0) & ~whole, "the record must have the header's fields"),
        **{(f, "required"): (whole & (F.col(f) == ""), "must not be empty") for f in REQUIRED},
        ("player_display_text", "empty_identity"): (whole & (S.collapse_whitespace(F.col("player_display_text")) == ""), "must hold more than white space"),
        **{(f, "invalid_unsigned_integer"): (whole & (F.col(f) != "") & S.unsigned_digits(F.col(f)).isNull(), "must be ASCII digits") for f in ("player_id", "team_logo_asset_id")},
        ("player_url", "invalid_url"): (whole & (F.col("player_url") != "") & S.linked_url(F.col("player_url")).isNull(), "must be http(s), begin with a host or with the root"),
        ("team_logo_url", "invalid_url"): (whole & (F.col("team_logo_url") != "") & S.full_http_url(F.col("team_logo_url")).isNull(), "must be a full http(s) URL"),
        ("target_season", "invalid_season"): (whole & ~right, "must be a season, yyyy-yy"),
        ("target_season_salary_text", "invalid_salary"): (whole & ~S.money_is_valid(F.col("target_season_salary_text")), "must be whole dollars or a text for none"),
    }
    if season is not None:
        rules["target_season", "season_mismatch"] = (whole & right & (F.col("target_season") != season), "must be the season that was asked for")
    cells = with_cells(records.where(whole))
    shape = F.transform(F.filter("report.codes", lambda c: c["code"].isNotNull()), lambda c: F.struct(c["code"].alias("code"), c["cell"].alias("cell")))
    rest = F.when(F.col("report.cells").isNotNull(), cell_problems(F.col("report.cells"), F.col("target_season"), F.col("target_season_salary_text"), F.col("target_season_marker_text")))
    found = cells.select("record_number", F.explode(F.concat(F.coalesce(shape, F.array().cast("array<struct<code:string,cell:int>>")), F.coalesce(rest, F.array().cast("array<struct<code:string,cell:int>>")))).alias("d"))
    said = F.when(F.col("d.cell") > 0, F.concat(F.lit("cell "), F.col("d.cell").cast("string"))).otherwise("the cells")
    own = found.select(F.lit("row").alias("location"), F.lit("salary_season_cells_json").alias("field"), F.col("d.code").alias("code"), F.concat(said, F.lit(" break a rule")).alias("message"), F.col("record_number").cast("long").alias("record_number"))
    return diagnostics.violations(records.withColumns({f: col(f) for f in HEADER}), rules, "record_number").unionByName(own)


def with_cells(records: DataFrame) -> DataFrame:
    """records with report: the cells of their JSON and what is wrong with its shape; an empty text has neither."""
    text = F.col("salary_season_cells_json")
    return records.withColumn("report", strict_json.cell_report(F.when(text != "", text)))


def raw_rows(records: DataFrame, locator: str, imported_at: str) -> DataFrame:
    """Sound records as raw rows, which keep the texts of the file beside what was read from them."""
    empty = lambda f: F.nullif(F.col(f), F.lit(""))
    rows = with_cells(records)
    return rows.select(
        F.col("record_number").cast("int").alias("input_position"), "target_season", F.lit(1).alias("source_page_number"), F.col("record_number").cast("int").alias("source_row_position"), F.lit("").alias("rank_text"),
        "player_display_text", empty("player_url").alias("player_url"), S.unsigned_digits(F.col("player_id")).alias("player_id"), "team_logo_url", S.unsigned_digits(F.col("team_logo_asset_id")).alias("team_logo_asset_id"),
        "target_season_salary_text", "target_season_marker_text", empty("source_row_description").alias("source_row_description"),
        F.concat(F.lit(f"{locator} (CSV data record "), F.col("record_number").cast("string"), F.lit(")")).alias("source_locator"), F.lit(imported_at).alias("imported_at"), F.col("report.cells").alias("salary_season_cells"),
        F.lit(SOURCE_SYSTEM).alias("source_system"), empty("team_display_text").alias("team_display_text"), empty("source_row_reference").alias("source_row_reference"), "salary_season_cells_json",
        empty("player_id").alias("player_id_csv_text"), empty("team_logo_asset_id").alias("team_logo_asset_id_csv_text"),
    )


# ------------------------------------------------------------------ from files to rows


def _bytes(spark: SparkSession, path: str) -> bytes | None:
    """A small file's bytes from any store, null if it isn't there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(where) or fs.getFileStatus(where).isDirectory():
        return None
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def confined(path: str, root: str) -> bool:
    """Whether a path lies under a folder once links and parents are followed; paths of other stores are compared by their parts."""
    local = lambda p: os.path.realpath(p.removeprefix("file://")) if "://" not in p or p.startswith("file://") else os.path.normpath(p)
    return os.path.commonpath([local(path), local(root)]) == local(root) if ("://" in path.removeprefix("file://")) == ("://" in root.removeprefix("file://")) else False


def path_problems(spark: SparkSession, root: str, source: str, output: str | None = None) -> DataFrame:
    """Diagnostics of where files lie and how they are called."""
    named = [("input", source, ".csv")] + ([("output", output, ".json")] if output is not None else [])
    rows = spark.createDataFrame([(kind, os.path.basename(p), os.path.splitext(p)[1] == end, confined(p, root)) for kind, p, end in named], "kind string, name string, ends boolean, inside boolean")
    found = [("_storage", "outside_private", "must lie under the private folder", ~F.col("inside")), ("_basename", "unsafe_basename", "must be a safe name with its ending", ~(F.col("ends") & S.is_safe_basename(F.col("name"))))]
    parts = [rows.where(bad).select(F.lit("file").alias("location"), F.concat("kind", F.lit(f)).alias("field"), F.lit(code).alias("code"), F.lit(message).alias("message"), F.lit(None).cast("long").alias("record_number")) for f, code, message, bad in found]
    return parts[0].unionByName(parts[1])


def read_import(spark: SparkSession, path: str, season: str, imported_at: str, mode: str = "production", before: DataFrame | None = None) -> CsvImport:
    """The deduplicated rows of a CSV and its sidecar (same name, .metadata.json). Raises DiagnosticsError with all that is wrong with season, time, sidecar, file and records, and with `before`."""
    beside = f"{os.path.splitext(path)[0]}.metadata.json"
    content = _bytes(spark, beside)
    value, fault = parse_sidecar(content)
    asked = spark.createDataFrame([(season, imported_at)], "season string, at string").select(S.season_is_valid(F.col("season")), S.is_utc_timestamp(F.col("at"))).first()
    known = season if asked[0] else None
    found = [before] if before is not None else []
    if not asked[0]:
        found.append(_report(spark, ("metadata", "selected_season", "invalid_season", "the season asked for must be yyyy-yy")))
    if not asked[1]:
        found.append(_report(spark, ("file", "imported_at", "invalid_timestamp", "the time of the import must be a UTC timestamp")))
    if fault:
        found.append(_report(spark, fault))
    else:
        found.append(metadata_problems(metadata_row(spark, value), mode, known))
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)
    if there:
        scanned = settled(strict_csv.read_strict_csv(spark, path, HEADER))
        records = strict_csv.as_columns(scanned, HEADER)
        wrong = settled(record_problems(records, known))
        found += [strict_csv.file_faults(scanned), wrong]
        locator = _safe_locator(spark, value) or "commissioner salary CSV"
        rows = R.with_payload(settled(R.with_amounts(raw_rows(records.where(F.col("n_fields") == len(HEADER)), locator, imported_at if asked[1] else "1970-01-01T00:00:00Z")).drop("amount_problem")))
        rows = settled(rows)
        other = wrong.select("record_number").distinct()
        late = rows.where(F.size("problems") > 0).select(F.col("input_position").cast("long").alias("record_number")).join(other, "record_number", "left_anti")
        found.append(late.select(F.lit("row").alias("location"), F.lit("row").alias("field"), F.lit("fingerprint_validation").alias("code"), F.lit("the row has no canonical form").alias("message"), "record_number"))
    else:
        found.append(_report(spark, ("file", "input", "unreadable", "the CSV is missing or can't be read")))
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    diagnostics.raise_if_any(every, FIELDS)
    try:
        made = dedup.deduplicate(rows.drop("problems"), position="input_position")
    except CollisionError as e:
        raise DiagnosticsError([{"location": "file", "field": "rows", "code": "boundary_validation", "message": "rows can't be told apart by their fingerprints", "record_number": None}]) from e
    sums = {name: {"basename": os.path.basename(p), "sha256": spark.read.format("binaryFile").load(p).select(F.sha2("content", 256)).first()[0]} for name, p in (("input_csv", path), ("input_metadata", beside))}
    return CsvImport(made, value, rows.count(), sums)


def _safe_locator(spark: SparkSession, value: Mapping | None) -> str | None:
    locator = (value or {}).get("source_locator")
    if not isinstance(locator, str):
        return None
    return locator if spark.createDataFrame([(locator,)], "x string").select(S.is_safe_locator(F.col("x"))).first()[0] else None


def import_csv(spark: SparkSession, path: str, season: str, root: str, imported_at: str | None = None) -> Deduplicated:
    """Rows of a CSV of the private folder `root`."""
    return read_import(spark, path, season, imported_at or utc_now(), before=path_problems(spark, root, path)).deduplicated


def load_synthetic(spark: SparkSession, path: str, season: str, imported_at: str) -> Deduplicated:
    """Rows of a reviewed fixture, wherever it lies."""
    return read_import(spark, path, season, imported_at, mode="synthetic").deduplicated


# ------------------------------------------------------------------ what is derived


def encoded(rows: DataFrame, tag: str = HEX) -> DataFrame:
    """rows with their integers as {tag: hexadecimal}, null for null."""
    return rows.withColumns({c: F.when(F.col(c).isNotNull(), F.struct(E.to_hex(F.col(c)).alias(tag))) for c in R.DIGITS})


def decoded(rows: DataFrame, tag: str = HEX) -> DataFrame:
    """The inverse of encoded(), with decode_problem: whether an integer isn't as encoded() makes it."""
    back = {c: E.from_hex(F.col(c)[tag]) for c in R.DIGITS}
    bad = [F.col(c).isNotNull() & v.isNull() for c, v in back.items()]
    return rows.withColumn("decode_problem", bad[0] | bad[1] | bad[2]).withColumns(back)


def run_summary(imported: CsvImport) -> dict[str, int]:
    unique = imported.deduplicated.unique.count()
    return {"physical_csv_row_count": imported.physical, "unique_row_count": unique, "duplicate_occurrence_count": imported.physical - unique}


def build_derived(imported: CsvImport, generated_at: str) -> dict:
    """The head of what is derived: metadata from the sidecar's, counts and lineage. Counts must agree with the occurrences."""
    spark = imported.deduplicated.unique.sparkSession
    if not spark.createDataFrame([(generated_at,)], "x string").select(S.is_utc_timestamp(F.col("x"))).first()[0]:
        raise PublishError("generated_at must be a UTC timestamp")
    counts = run_summary(imported)
    if imported.deduplicated.occurrences.count() != imported.physical:
        raise PublishError("the occurrences don't add up to the records")
    old = imported.metadata
    status = "redacted-reviewed" if old["redaction_status"] == "synthetic" else old["redaction_status"]
    metadata = {
        "source_system": SOURCE_SYSTEM, "source_locator": old["source_locator"], "retrieved_at": None, "generated_at": generated_at, "source_event_time": old["source_event_time"],
        "season": old["season"], "league_scope": None, "artifact_version": VERSION, "schema_version": VERSION, "redaction_status": status,
    }
    return {"metadata": metadata, "counts": counts, "lineage": imported.lineage}


def publish_derived(imported: CsvImport, path: str, generated_at: str, tag: str = HEX) -> dict:
    """Writes head, unique rows and occurrences beside their place and renames them there at once; what is there already stays, and raises PublishError unless it is the same."""
    head = build_derived(imported, generated_at)
    spark = imported.deduplicated.unique.sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs
    target = jvm.Path(path)
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    said = json.dumps(head, sort_keys=True, ensure_ascii=False)
    if fs.exists(target):
        if fs.exists(jvm.Path(f"{path}/head")) and spark.read.text(f"{path}/head").collect() == [(said,)]:
            return head
        raise PublishError(f"{os.path.basename(path)} exists with other content")
    staged = f"{path.rstrip('/')}.staged-{os.urandom(6).hex()}"
    try:
        encoded(imported.deduplicated.unique.drop("payload"), tag).write.parquet(f"{staged}/unique_rows")
        imported.deduplicated.occurrences.select("input_position", "fingerprint", "representative_position", *R.PROVENANCE).write.parquet(f"{staged}/occurrences")
        spark.createDataFrame([(said,)], "value string").coalesce(1).write.text(f"{staged}/head")
        if fs.exists(target) or not fs.rename(jvm.Path(staged), target):
            raise PublishError(f"{os.path.basename(path)} appeared meanwhile and stays")
    finally:
        fs.delete(jvm.Path(staged), True)
    return head


def lineage_problems(value: object, spark: SparkSession) -> bool:
    """Whether a lineage isn't two names with their digests."""
    if not isinstance(value, dict) or set(value) != {"input_csv", "input_metadata"} or any(not isinstance(x, dict) or set(x) != {"basename", "sha256"} for x in value.values()):
        return True
    rows = spark.createDataFrame([tuple(x[k] if isinstance(x[k], str) else None for k in ("basename", "sha256")) for x in value.values()], "name string, digest string")
    return rows.where(~(S.is_safe_basename(F.col("name")) & F.coalesce(F.col("digest").rlike(r"\A[0-9a-f]{64}\z"), F.lit(False)))).count() > 0


def load_derived(spark: SparkSession, path: str, tag: str = HEX) -> Deduplicated:
    """What publish_derived() wrote, verified: shape, metadata, versions, integers, fingerprints made anew, provenance, counts and lineage. Raises PublishError."""
    try:
        (said,) = spark.read.text(f"{path}/head").collect()
        head = strict_json.loads(said[0])
        unique, occurrences = spark.read.parquet(f"{path}/unique_rows"), spark.read.parquet(f"{path}/occurrences")
    except Exception as e:
        raise PublishError(f"{os.path.basename(path)} can't be read") from e
    if not isinstance(head, dict) or set(head) != {"metadata", "counts", "lineage"} or not isinstance(head["metadata"], dict):
        raise PublishError("the head has another shape")
    metadata = head["metadata"]
    if set(metadata) != set(METADATA) or metadata["retrieved_at"] is not None or metadata["generated_at"] is None:
        raise PublishError("the metadata have another shape")
    # what is derived has its times the other way round than a sidecar
    turned = metadata | {"retrieved_at": metadata["generated_at"], "generated_at": None}
    if bad := metadata_problems(metadata_row(spark, turned), "production", None).limit(5).collect():
        raise PublishError("; ".join(f"{r['field']}: {r['code']}" for r in bad))
    if lineage_problems(head["lineage"], spark):
        raise PublishError("the lineage has another shape")
    rows = decoded(unique, tag)
    rows = settled(rows)
    if rows.where("decode_problem").head(1):
        raise PublishError("an integer has another form")
    made = R.with_payload(rows.drop("decode_problem").withColumnRenamed("fingerprint", "__told"))
    result = Deduplicated(settled(made.drop("fingerprint", "problems").withColumnRenamed("__told", "fingerprint")), occurrences)
    if bad := deduplication_problems(result, metadata["season"]).limit(5).collect():
        raise PublishError("; ".join(f"{r['fingerprint'] or r['position']}: {r['problem']}" for r in bad))
    n, m = unique.count(), occurrences.count()
    if head["counts"] != {"physical_csv_row_count": m, "unique_row_count": n, "duplicate_occurrence_count": m - n}:
        raise PublishError("the counts don't agree with the rows")
    return result


def run_import(spark: SparkSession, path: str, season: str, output: str, root: str, now: Callable[[], str] = utc_now) -> dict[str, int]:
    """From a CSV and its sidecar to what is derived, all or nothing; one time stands for the import and for what it makes. The counts of the run."""
    at = now()
    imported = read_import(spark, path, season, at, before=path_problems(spark, root, path, output))
    return publish_derived(imported, output, at)["counts"]
