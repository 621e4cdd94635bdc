import pytest
from pyspark.sql import functions as F

from attestry.errors import CollectionError, CollisionError, DecisionError, DiagnosticsError, ReconcileError
from attestry.functions import encoding as E
from attestry.operators import audit, dedup, diagnostics, policy, reconcile
from attestry.sources import pages


def rows(spark, items):
    df = spark.createDataFrame([(i + 1, *x) for i, x in enumerate(items)], "input_position int, name string, amount long")
    df = df.withColumn("payload", E.payload({"name": E.nullable(E.encode_string, F.col("name")), "amount": E.nullable(E.encode_integer, F.col("amount"))}))
    return df.withColumn("fingerprint", E.fingerprint(F.col("payload")))


def test_payload_bytes(spark):
    got = rows(spark, [("a", 0), (None, 256)]).orderBy("input_position").collect()
    typed = lambda t, b: t + len(b).to_bytes(8, "big") + b
    field = lambda n, v: typed(b"L", typed(b"S", n) + v)
    assert bytes(got[0]["payload"]) == typed(b"L", field(b"name", typed(b"S", b"a")) + field(b"amount", typed(b"I", b"\0")))
    assert bytes(got[1]["payload"]) == typed(b"L", field(b"name", typed(b"N", b"")) + field(b"amount", typed(b"I", b"\1\0")))


def test_null_zero_and_empty_differ(spark):
    got = rows(spark, [("", None), ("", 0), (None, None), (None, 0)])
    assert got.select("fingerprint").distinct().count() == 4


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_first_seen_order_is_kept_however_rows_are_dealt(spark, parts):
    made = rows(spark, [("a", 1), ("b", 2), ("a", 1), ("c", None), ("b", 2), ("a", 1)]).repartition(parts)
    out = dedup.deduplicate(made)
    assert [tuple(r) for r in out.unique.orderBy("input_position").select("input_position", "name", "n_occurrences").collect()] == [(1, "a", 3), (2, "b", 2), (4, "c", 1)]
    assert [r[0] for r in out.occurrences.orderBy("input_position").select("representative_position").collect()] == [1, 2, 1, 4, 2, 1]
    assert audit.audit(out.unique, out.occurrences, same=("name",)).count() == 0
    assert tuple(dedup.run_counts(made).first()) == (6, 3, 3)


def test_collisions_fail_the_whole_call(spark):
    made = rows(spark, [("a", 1), ("b", 2)]).withColumn("fingerprint", F.lit("x"))
    with pytest.raises(CollisionError):
        dedup.deduplicate(made)


def test_audit_finds_faults(spark):
    out = dedup.deduplicate(rows(spark, [("a", 1), ("b", 2), ("a", 1)]))
    assert {r["problem"] for r in audit.audit(out.unique.where("name = 'a'"), out.occurrences).collect()} == {"no_unique_row"}
    assert {r["problem"] for r in audit.audit(out.unique, out.occurrences.where("input_position <> 1")).collect()} == {"representative_not_first"}
    assert {r["problem"] for r in audit.audit(out.unique.withColumn("name", F.lit("z")), out.occurrences, same=("name",)).collect()} == {"provenance_differs"}


def test_reconcile(spark):
    a, b = rows(spark, [("a", 1), ("b", 2)]), rows(spark, [("b", 2), ("c", 3)])
    got = {(r["side"], r["left_position"], r["right_position"]) for r in reconcile.reconcile(a, b).collect()}
    assert got == {("left_only", 1, None), ("equivalent", 2, 1), ("right_only", None, 2)}
    with pytest.raises(ReconcileError):
        reconcile.reconcile(rows(spark, [("a", 1), ("a", 1)]), b)


def claims(spark):
    return spark.createDataFrame(
        [("f1", "x", 10, "", None, 1), ("f2", "x", 5, "", None, 2), ("f3", "y", None, "", None, 3), ("f4", "z", 7, " TW", None, 4), ("f5", "w", 3, " ", " ", 5)],
        "fp string, who string, amount long, marker string, note string, pos int",
    )


def test_policy_truth_table(spark):
    out = policy.apply_policy(claims(spark), "who", "amount", "marker", "note", "fp")
    assert {r["fp"]: r["reason_code"] for r in out.collect()} == {"f1": "multiple_amounts", "f2": "multiple_amounts", "f3": "no_amount", "f4": "source_evidence_requires_review", "f5": "single_ordinary_amount"}
    assert out.where("fp = 'f4'").first()["evidence"][0]["value"] == " TW"


def test_deciding_one_row_does_not_settle_the_other(spark):
    made = spark.createDataFrame([("f1", "excluded", "seen")], "fp string, status string, reason string")
    out = policy.apply_policy(claims(spark), "who", "amount", "marker", "note", "fp", made)
    assert {r["fp"]: r["status"] for r in out.collect()}["f2"] == "review_required"
    totals = {r["who"]: r for r in policy.entity_totals(out, "who", "amount", "pos").collect()}
    assert totals["x"]["total"] is None and totals["w"]["total"] == 3 and totals["y"]["total"] == 0


@pytest.mark.parametrize("bad", [("nope", "included", "r"), ("f1", "maybe", "r"), ("f1", "excluded", " "), ("f3", "included", "r")])
def test_bad_decisions(spark, bad):
    with pytest.raises(DecisionError):
        policy.apply_policy(claims(spark), "who", "amount", "marker", "note", "fp", spark.createDataFrame([bad], "fp string, status string, reason string"))


def test_diagnostics_are_raised_once_and_sorted(spark):
    made = spark.createDataFrame([("row", "b", "x", "m", 2), ("row", "a", "y", "m", 2), ("file", "quoting", "z", "m", None), ("metadata", "season", "w", "m", None)], diagnostics.SCHEMA)
    with pytest.raises(DiagnosticsError) as e:
        diagnostics.raise_if_any(made, ["a", "b"])
    assert [d["code"] for d in e.value.diagnostics] == ["w", "z", "y", "x"]
    diagnostics.raise_if_any(made.limit(0), ["a", "b"])


def landed(spark, change=lambda i, p: p):
    made = [change(i, {"walk": i, "indicator_text": f"{i} of 3", "back_disabled": i == 1, "forward_disabled": i == 3, "headings": ["", "Player"], "n_rows": 20, "content_token": f"t{i}"}) for i in (1, 2, 3)]
    return pages.numbered(spark.createDataFrame(made, "walk int, indicator_text string, back_disabled boolean, forward_disabled boolean, headings array<string>, n_rows int, content_token string"))


def test_a_whole_walk_is_proved(spark):
    pages.prove_walk(landed(spark))


@pytest.mark.parametrize(
    "key,value,problem",
    [("indicator_text", "x", "paginator"), ("indicator_text", "2 of 4", "final_page_changed"), ("indicator_text", "3 of 3", "step"), ("headings", ["b"], "headings_changed"), ("content_token", "t1", "content_unchanged"), ("back_disabled", True, "back_button"), ("n_rows", 0, "empty_page")],
)
def test_walk_faults(spark, key, value, problem):
    with pytest.raises(CollectionError, match=problem):
        pages.prove_walk(landed(spark, lambda i, p: p | {key: value} if i == 2 else p))


def test_decode_has_defaults(spark):
    got = pages.decode(spark.createDataFrame([('{"indicator_text": "1 of 1"}',)], "value string")).first()
    assert got["back_disabled"] is False and got["headings"] == [] and got["content_token"] == ""
