import json

import pytest
from pyspark.sql import functions as F

from attestry.errors import DiagnosticsError, PublishError
from attestry.sources import html_table, publish, strict_csv, strict_json

H = ("a", "b")


@pytest.mark.parametrize(
    "content,codes",
    [
        (b"a,b\r\n1,2\r\n", []), (b'a,b\r\n"x ""y"", z",2\r\n', []), (b"\xef\xbb\xbfa,b\r\n1,2\r\n", ["bom", "control_character"]), (b"a,b\r\n\xff,2\r\n", ["invalid_utf8"]), (b"a,b\r\n1\x00,2\r\n", ["nul"]), (b"a,b\r\n1,2", ["missing_final_crlf"]),
        (b"a,b\n1,2\r\n", ["non_crlf"]), (b"a,b\r\n1\t,2\r\n", ["control_character"]), (b'a,b\r\n"1\r\n",2\r\n', ["embedded_newline"]), (b'a,b\r\n"1"x,2\r\n', ["invalid_quote_escape"]), (b'a,b\r\n1"x",2\r\n', ["bare_quote"]),
        (b'a,b\r\n"1,2', ["missing_final_crlf", "unclosed_quote"]), (b"b,a\r\n1,2\r\n", ["header_mismatch"]), (b"a,b\r\n", ["missing_data"]), (b"", ["missing_final_crlf"]),
    ],
)
def test_csv_bytes(content, codes):
    assert strict_csv.parse(content, H)[0] == codes


def test_csv_records():
    assert strict_csv.parse(b'a,b\r\n"x ""y"", z",2\r\n\r\n,\r\n"",1,2\r\n', H) == ([], [['x "y", z', "2"], [], ["", ""], ["", "1", "2"]])


def test_csv_long_field():
    text = "x" * 300_000
    assert strict_csv.parse(f"a,b\r\n{text},2\r\n".encode(), H)[1] == [[text, "2"]]


def test_csv_load(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b"a,b\r\n1,\r\n001,z\r\n")
    got = strict_csv.load(spark, str(tmp_path / "x.csv"), H, nullable=("b",)).orderBy("record_number").collect()
    assert [(r["record_number"], r["a"], r["b"]) for r in got] == [(1, "1", None), (2, "001", "z")]
    (tmp_path / "y.csv").write_bytes(b"a,b\r\n1\r\n\r\n")
    with pytest.raises(DiagnosticsError) as e:
        strict_csv.load(spark, str(tmp_path / "y.csv"), H)
    assert [d["code"] for d in e.value.diagnostics] == ["column_count", "blank_record"]


def test_strict_json(spark):
    texts = ['{"b":1,"a":2}', '{"a":1,"a":2}', "NaN", "[1] x", "[Infinity]", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", strict_json.canonical_json("t").alias("c")).orderBy("i")
    assert [r["c"] for r in rows.collect()] == ['{"a":2,"b":1}'] + [None] * 6
    cell = {"heading": "h", "salary_text": "", "marker_text": ""}
    texts = [json.dumps([cell]), "{", "[]", json.dumps([cell | {"x": ""}]), json.dumps([cell | {"heading": 1}])]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", strict_json.checked_cells("t").alias("c")).orderBy("i")
    assert [r["c"][0] + r["c"][1:] if r["c"][0] == "!" else "ok" for r in rows.collect()] == ["ok", "!invalid_json", "!wrong_json_shape", "!invalid_cell_shape", "!invalid_cell_type"]


HTML = '<table><thead><tr><th></th><th>Player</th></tr></thead><tbody><tr><td>1</td><td><img src="/logos/9.png"><a href="/p/a/12/">A &amp; B</a></td><td><sup>TW</sup>$1,000</td></tr></b><tr><td>2</td><td>C</tr></tbody></table>'


def test_html_rows(spark):
    got = list(html_table.table_rows(HTML))
    assert got[0] == (1, ["", "Player"], ["1", "A & B", "$1,000"], ["", "", "TW"], "/p/a/12/", "/logos/9.png")
    assert got[1][2] == ["2", "C"] and got[1][4] is None
    docs = spark.createDataFrame([(1, HTML), (2, None), (3, "")], "id int, html string")
    assert html_table.lateral(spark, docs, html_table.TableRows, "html", ("id",)).count() == 2


def test_publication_never_overwrites(spark, tmp_path):
    meta = dict.fromkeys(publish.METADATA, "x")
    one = publish.envelope(meta, {}, [{"a": 1}], {1: 1})
    assert publish.publish_file(tmp_path / "a.json", one) is True
    assert publish.publish_file(tmp_path / "a.json", one) is False
    with pytest.raises(PublishError):
        publish.publish_file(tmp_path / "a.json", publish.envelope(meta, {}, [], {}))
    assert [p.name for p in tmp_path.iterdir()] == ["a.json"]
    assert publish.load_artifact(tmp_path / "a.json")["data"] == [{"a": 1}]
    with pytest.raises(PublishError):
        publish.envelope(meta, {}, [], {1: 1})
    publish.publish_table(spark.range(3), str(tmp_path / "t"))
    with pytest.raises(PublishError):
        publish.publish_table(spark.range(4), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    (tmp_path / "bad.json").write_text('{"metadata": {}}')
    with pytest.raises(PublishError):
        publish.load_artifact(tmp_path / "bad.json")


def test_lineage(spark, tmp_path):
    import hashlib

    (tmp_path / "f").write_bytes(b"abc")
    r = publish.lineage(spark, str(tmp_path / "f")).first()
    assert (r["source"], r["bytes"], r["sha256"]) == ("f", 3, hashlib.sha256(b"abc").hexdigest())


def test_stream_drops_repeats(spark, tmp_path):
    from attestry.streaming.dedup import deduplicate_stream

    made = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "fp string, n int").withColumn("at", F.timestamp_seconds(F.col("n")))
    made.write.parquet(str(tmp_path / "in"))
    stream = deduplicate_stream(spark.readStream.schema(made.schema).parquet(str(tmp_path / "in")), "fp", "at")
    q = stream.writeStream.format("memory").queryName("attestry_repeats").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["fp"] for r in spark.sql("select fp from attestry_repeats").collect()) == ["a", "b"]
