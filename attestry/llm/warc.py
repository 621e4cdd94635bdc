"""WARC archives: writing captures with revisits, and assembling transactions from the records read back.

Writing goes through Spark's text writer with a record's trailing CRLF CRLF as its line separator, so that archives reach any
store that Spark can write. Reading streams through each archive's bytes by Content-Length. Request, response (or revisit)
and metadata records that are connected by WARC-Concurrent-To, in any direction and over any number of records, are joined into one nested
row per capture.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestry.llm.common import map_rows, spread_join, table, workdir, written
from attestry.llm.components import components

#: Payloads below this many bytes are always written in full.
LEAST_BYTES = 1000
CRLF = "\r\n"
DATE = "1970-01-01T00:00:00Z"
RECORD = "record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, payload_bytes long, payload_digest string, declared_digest string, payload binary"
#: Revisits up to which they are broadcast (some 32 MB), and beyond which they are joined.
BROADCAST_ROWS = 1 << 17
#: Captures in an archive at most, which bounds the bytes that are one value when it is read.
ARCHIVE_ROWS = 10_000


def _urn(kind: str, *columns):
    """A record id that depends on its capture alone, so that a rewritten task writes the same record."""
    digest = F.md5(F.concat_ws("\x1f", F.lit(kind), *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns)))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(headers: list[tuple[str, object]], block):
    """A record without its trailing separator; headers with a null value are left out."""
    lines = [F.coalesce(F.concat(F.lit(f"{CRLF}{name}: "), value if not isinstance(value, str) else F.lit(value)), F.lit("")) for name, value in headers]
    return F.concat(F.lit("WARC/1.1"), *lines, F.concat(F.lit(f"{CRLF}Content-Length: "), F.octet_length(block).cast("string")), F.lit(CRLF * 2), block)


def captures(pages: DataFrame, least: int = LEAST_BYTES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """pages (page_id, url, html) -> rows with payload, bytes, digest, copy, and for revisits original, the (page_id, url) kept.

    Of equal payloads of at least `least` bytes one record is kept in full, that of the largest page_id, then of the largest url;
    all others revisit it. Rows that repeat page_id, url and html are numbered by copy from 1, and later copies revisit the
    first. Null page_ids and urls come before all others. Null html is an empty payload. Roles are found on rows without
    payloads, which are joined to them by page, so that a payload that many pages share doesn't meet in one task. Up to broadcast_rows
    revisits are broadcast. An empty table gives an empty one; other columns of pages don't matter.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("bytes"), F.sha1(payload.cast("binary")).alias("digest"))
    narrow = rows.where(F.col("bytes") >= least).select("page_id", "url", "bytes", "digest")
    same = F.concat_ws(" ", "digest", "bytes")
    kept = narrow.groupBy(same.alias("k_same")).agg(F.max(F.struct("page_id", "url")).alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = spread_join(narrow.withColumn("same", same), kept, "same", "k_same").where(~F.struct("page_id", "url").eqNullSafe(F.col("original")))
    again = written(again.select(F.col("page_id").alias("r_page"), F.col("url").alias("r_url"), F.col("digest").alias("r_digest"), "original").distinct(), "revisits")
    few = again.count() <= broadcast_rows
    whole = rows.join(F.broadcast(again) if few else again, F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("url") == F.col("r_url")) & (F.col("digest") == F.col("r_digest")), "left").drop("r_page", "r_url", "r_digest")
    if few and not rows.groupBy("page_id", "url", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").head(1):
        return whole.withColumn("copy", F.lit(1))  # no row repeats, so that payloads need not be brought together
    whole = whole.withColumn("copy", F.row_number().over(Window.partitionBy("page_id", "url", "digest").orderBy("bytes")))
    return whole.withColumn("original", F.coalesce("original", F.when((F.col("copy") > 1) & (F.col("bytes") >= least), F.struct("page_id", "url"))))


def write_warc(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """Writes a request, a response or revisit, and a metadata record for each row of pages (page_id, url, html); nulls and repeats as captures() has them, none for an empty table."""
    rows = captures(pages, least)
    key = (F.col("page_id"), F.col("url"), F.col("digest"), F.col("copy"))
    me, request, meta = (_urn(k, *key) for k in ("response", "request", "metadata"))
    uri = F.regexp_replace("url", r"[\r\n]", " ")
    head = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF * 2}")
    http = ("Content-Type", "application/http; msgtype=response")
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    base = lambda kind, urn: [("WARC-Type", kind), ("WARC-Record-ID", urn), ("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    refers = ("WARC-Refers-To", _urn("response", F.col("original.page_id"), F.col("original.url"), F.col("digest"), F.lit(1)))
    revisit = _record([*base("revisit", me), http, digest, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), refers], head)
    response = _record([*base("response", me), http, digest], F.concat(head, F.col("payload")))
    asked = _record([*base("request", request), ("Content-Type", "application/http; msgtype=request"), ("WARC-Concurrent-To", me)], F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{CRLF * 2}")))
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    noted = _record([*base("metadata", meta), ("Content-Type", "application/warc-fields"), ("WARC-Concurrent-To", me)], F.concat(F.lit("page-id: "), number, F.lit(CRLF)))
    records = rows.select(F.concat_ws(CRLF * 2, asked, F.when(F.col("original").isNull(), response).otherwise(revisit), noted).alias("value"))
    records.write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", ARCHIVE_ROWS).text(path)


def parse_records(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of one archive, one at a time: headers by lower-case name, the list of concurrent-to, and the block.

    Headers that aren't UTF-8 are read as Latin-1. Where there should be a record and is none, one without a length, or one that is cut short,
    a record with nothing but the type `damaged` comes, and reading goes on at the next line that begins a record.
    """
    line = stream.readline()
    while line:
        if not line.strip():
            line = stream.readline()
            continue
        headers: dict = {"concurrent": []}
        sound = line.startswith(b"WARC/")
        while sound and (line := stream.readline()).strip():
            try:
                said = line.decode()
            except UnicodeDecodeError:
                said = line.decode("latin-1")
            name, _, value = said.partition(":")
            if name.strip().lower() == "warc-concurrent-to":
                headers["concurrent"].append(value.strip())
            else:
                headers[name.strip().lower()] = value.strip()
        length = headers.get("content-length", "")
        block = stream.read(int(length)) if sound and re.fullmatch("[0-9]{1,18}", length) else None
        if block is None or len(block) != int(length):
            yield {"warc-type": "damaged", "concurrent": [], "block": b""}
            line = stream.readline()
            while line and not line.startswith(b"WARC/"):
                line = stream.readline()
            continue
        yield headers | {"block": block}
        line = stream.readline()


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives under path, damaged ones included; what a record's headers lack is null.

    An archive's compressed bytes are one value, so they must stay below 2 GB; write_warc() keeps them below by ARCHIVE_ROWS. Without
    payloads only those of metadata records are kept.
    """

    def run(rows):
        for (content,) in rows:
            raw = io.BytesIO(content)
            stream = gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw
            for r in parse_records(io.BufferedReader(stream) if stream is not raw else raw):
                body = r["block"].partition(b"\r\n\r\n")[2] if r.get("content-type", "").startswith("application/http") else r["block"]
                digest = hashlib.sha1(body).hexdigest() if r.get("warc-type") in ("response", "resource") else None
                yield (
                    r.get("warc-record-id"), r.get("warc-type"), r["concurrent"], r.get("warc-refers-to"), r.get("warc-target-uri"), len(body), digest,
                    r.get("warc-payload-digest", "").removeprefix("sha1:") or None, body if payloads or r.get("warc-type") == "metadata" else None,
                )

    files = spark.read.format("binaryFile").load(path).select("content")
    return map_rows(files, run, RECORD)


def captures_of(records: DataFrame) -> DataFrame:
    """(record_id, capture_id) of the records that belong to another's capture: the connected records of WARC-Concurrent-To, named by the smallest id of
    those that no plain link names.

    Most links are plain: a record's only one, to a record without links. Those are followed at once, and components are searched among the others alone.
    """
    links = records.where("record_id is not null").select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b")).where("a <> b").distinct()
    ends = links.groupBy(F.col("a").alias("e")).agg(F.count(F.lit(1)).alias("n"))
    told = links.join(ends, F.col("a") == F.col("e")).drop("e")
    plain = told.where("n = 1").join(ends.select("e"), F.col("b") == F.col("e"), "left_anti").select(F.col("a").alias("p"), F.col("b").alias("to"))
    rest = told.join(plain, F.col("a") == F.col("p"), "left_anti").select("a", "b")
    rest = rest.join(plain, F.col("b") == F.col("p"), "left").select("a", F.coalesce("to", "b").alias("b"))
    label = components(rest)
    far = plain.join(label, F.col("to") == F.col("node"), "left").select(F.col("p").alias("record_id"), F.coalesce("label", "to").alias("capture_id"))
    return far.unionByName(label.select(F.col("node").alias("record_id"), F.col("label").alias("capture_id")))


def transactions(records: DataFrame) -> DataFrame:
    """Records -> one nested row per capture: capture_id, main (response, revisit or resource), requests, metadata, others.

    Records belong together if WARC-Concurrent-To connects them, in any direction. A record that names none and that none names is a capture of its
    own; one without a response has no main. requests and metadata are sorted lists by record id; of several mains the one with the smallest record id is
    main and the rest are others, as are records of other types. Records that repeat an id count once, the smallest; those without an id, damaged ones among them, are left out.
    """
    whole = F.struct(*records.columns)
    held = records.where("record_id is not null")
    root = captures_of(held).withColumnRenamed("record_id", "r_id")
    rows = held.join(root, F.col("record_id") == F.col("r_id"), "left").select(F.coalesce("capture_id", "record_id").alias("capture_id"), whole.alias("record"))
    per = rows.groupBy("capture_id").agg(F.array_sort(F.array_distinct(F.collect_list("record"))).alias("all"))  # a capture's records are one row of the result
    kept = F.filter("all", lambda r, i: (i == 0) | (r["record_id"] != F.get(F.col("all"), F.greatest(i - 1, F.lit(0)))["record_id"]))
    per = per.select("capture_id", kept.alias("all"))
    of = lambda *kinds: F.filter("all", lambda r: F.coalesce(r["type"].isin(*kinds), F.lit(False)))
    main = of("response", "revisit", "resource")
    rest = F.filter("all", lambda r: ~F.coalesce(r["type"].isin("response", "revisit", "resource", "request", "metadata"), F.lit(False)))
    return per.select("capture_id", F.get(main, F.lit(0)).alias("main"), of("request").alias("requests"), of("metadata").alias("metadata"), F.concat(F.slice(main, 2, 1 << 30), rest).alias("others"))


def revisited(nested: DataFrame) -> DataFrame:
    """transactions() with digest and bytes of the full payload: a revisit has those of the response that it refers to.

    original is that response's record id and original_metadata its capture's; a revisit of a record that isn't there has a null payload_bytes. A
    response that many records revisit is joined in several parts.
    """
    is_revisit = F.col("main.type") == "revisit"
    held = nested.where("main.type = 'response'").select(F.col("main.record_id").alias("h_id"), F.col("main.payload_digest").alias("h_digest"), F.col("main.payload_bytes").alias("h_bytes"), F.col("metadata").alias("original_metadata"))
    rows = nested.withColumn("original", F.when(is_revisit, F.col("main.refers_to")))
    again = spread_join(rows.where("original is not null"), held, "original", "h_id", "left").drop("h_id")
    rest = rows.where("original is null")
    empty = dict(held.dtypes)
    rows = again.unionByName(rest.withColumns({c: F.lit(None).cast(empty[c]) for c in ("h_digest", "h_bytes", "original_metadata")}))
    return rows.withColumns({
        "payload_bytes": F.when(is_revisit, F.col("h_bytes")).otherwise(F.col("main.payload_bytes")),
        "payload_digest": F.when(is_revisit, F.coalesce("h_digest", "main.declared_digest")).otherwise(F.col("main.payload_digest")),
    }).drop("h_digest", "h_bytes")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back: payload, record type and what a revisit refers to; a row for each page."""
    path = f"{workdir(spark)}/attestry-{uuid.uuid4().hex}/warc"
    write_warc(table(spark, sf_dir, "pages"), path)
    page = lambda notes: F.nullif(F.regexp_extract(F.get(F.col(notes), F.lit(0)).payload.cast("string"), r"page-id: (.*)\r\n", 1), F.lit("")).cast("long")
    records = written(read_warc(spark, path, payloads=False).drop("target_uri"), "records")  # narrow rows, so that the archives are read once
    return revisited(written(transactions(records), "captures")).select(page("metadata").alias("page_id"), "payload_bytes", "payload_digest", F.col("main.type").alias("record_type"), page("original_metadata").alias("refers_to"))


ORACLE = """
with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, octet_length(encode(h)) as b, sha1(h) as d, max(page_id) over (partition by h) as m from p)
select page_id, cast(b as bigint) as payload_bytes, d as payload_digest,
  case when b >= 1000 and m <> page_id then 'revisit' else 'response' end as record_type,
  case when b >= 1000 and m <> page_id then m end as refers_to
from q
"""
