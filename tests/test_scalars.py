import pytest
from pyspark.sql import functions as F

from attestry.functions import scalars as S
from attestry.functions import encoding as E
from attestry.functions.unicode import folded, folded_name, has_control, nfc, normal_form, normal_forms
from attestry.operators.policy import entity_totals_unbounded


def values(spark, f, items):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string").select("i", f(F.col("x")).alias("y"))
    return [r["y"] for r in rows.orderBy("i").collect()]


def test_money_amounts(spark):
    texts = ["  $850,000\t", "$00", "$9,007,199,254,740,993", "0012", "\x1c$7\x1f", "$1"]
    assert values(spark, S.money_digits, texts) == ["850000", "0", "9007199254740993", "12", "7", "1"]
    assert values(spark, S.money_digits, ["9" * 4301]) == ["9" * 4301]


def test_money_sentinels_and_rejects(spark):
    none = ["", " ", "-", "–", "—", "N/A", "n/a"]
    bad = ["$ 850,000", "12,34", "1234,567", "＄1,000", "$١٠٠٠", "$", "1.5", "-5", "$1\n$2", "1e3", None]
    assert values(spark, S.money_digits, none + bad) == [None] * (len(none) + len(bad))
    assert values(spark, S.money_is_valid, none) == [True] * len(none)
    assert values(spark, S.money_is_valid, bad) == [False] * len(bad)


def test_seasons(spark):
    assert values(spark, S.season_is_valid, ["2026-27", "2099-00", "1999-00", "2026-28", "2026-27\n", "٢٠٢٦-27", "", None]) == [True, True, True, False, False, False, False, False]


def test_urls(spark):
    links = ["/a/b/12/?x#y", "//CDN.example/A", "HTTP://Host.Example:80/P?q", "https://u@h/x", "ftp://h/x", "https://h/a b", "https://h:99999/x", "", "a/b", "///x", None]
    assert values(spark, S.linked_url, links) == ["/a/b/12/", "//cdn.example/A", "http://host.example:80/P", None, None, None, None, None, None, None, None]
    assert values(spark, S.trailing_id, ["/p/x/00012/", "/p/x", "https://h/9?x=1", None]) == ["12", None, "9", None]
    assert values(spark, S.image_id, ["https://h/logos/007.png?w=3", "https://h/logos/a.png"]) == ["7", None]
    assert values(spark, lambda c: S.absolute_url(c, "https://h.example"), ["/a", "//b/c", "http://x/y", "z"]) == ["https://h.example/a", "https://b/c", "http://x/y", "https://h.example/z"]


def test_locators_basenames_timestamps_paginators(spark):
    assert values(spark, S.is_safe_locator, ["exports/a.csv", "https://h/a", "https://u@h/a", "https://h/a?b", "file:///a", "/etc/x", "my-token", "https://[x", " ", None]) == [True, True] + [False] * 8
    unsafe = [" exports/a.csv ", "http:///x", "exports/file://q", "a\u200bb", "Authorization", "x-bearer", "COOKIE", "session.csv", "\\\\host", "~/x", "C:\\x", "http://:80/x", "https://h?q=1", "", "a\nb", "ftp://h/x", "https://[::1"]
    assert values(spark, S.is_safe_locator, unsafe) == [False] * len(unsafe)
    assert values(spark, S.is_safe_locator, ["commissioner salary CSV: a", "a?b", "https://h?", "https://h/a#x?y", "https://[::1]:8/a"]) == [True] * 5
    assert values(spark, S.is_safe_basename, ["a-1.csv", ".a", "a/b", "password.csv", None, "A.csv", "a_b.csv", "my-session.csv", "a.csv\n"]) == [True] + [False] * 8
    assert values(spark, S.full_http_url, ["http://:80/x", "http://h:80/x", "http://[::1]/x", "http://u:p@h/x", "http://h:/x"]) == [None, "http://h:80/x", "http://[::1]/x", None, "http://h:/x"]
    assert values(spark, lambda c: S.absolute_image_url(c, "https://h.example"), ["/a.png", "//c/x", "//", "ftp://x/y", "a b", "http://u@h/x", "", "x.png"]) == ["https://h.example/a.png", "https://c/x", None, None, None, None, None, "https://h.example/x.png"]
    assert values(spark, S.is_utc_timestamp, ["2026-08-07T20:00:00Z", "2026-02-30T00:00:00Z", "2026-08-07T20:00:00Z\n", "2026-08-07", None]) == [True, False, False, False, False]
    assert values(spark, lambda c: S.paginator(c)["page"], ["2 of 5", " 5 of 5 ", "6 of 5", "0 of 5", "2of5", None]) == [2, 5, None, None, None, None]
    assert values(spark, S.unsigned_digits, ["0010", "", "1a", "٣"]) == ["10", None, None, None]


def test_text(spark):
    assert values(spark, S.collapse_whitespace, ["  a \x1fb \n", "\x85"]) == ["a b", ""]
    assert values(spark, lambda c: S.canonical_description(nfc(c)), ["é ", " \t", None]) == ["é", None, None]
    assert values(spark, folded_name, ["Straße  X", None]) == ["strasse x", None]
    assert values(spark, has_control, ["a​b", "ab", None]) == [True, False, False]


def test_text_of_ascii_needs_no_python(spark):
    assert values(spark, normal_form, ["e\u0301", "x", None]) == ["é", "x", None]
    assert values(spark, lambda c: normal_forms(F.array(c, F.lit("a"))), ["e\u0301", "x"]) == [["é", "a"], ["x", "a"]]
    assert values(spark, folded, ["Straße  X", "A \t B", None]) == ["strasse x", "a b", None]


def test_integers_of_any_size_go_there_and_back(spark):
    import random

    rng = random.Random(3)
    numbers = [0, 1, 255, 10**17, 10**18 - 1, 10**18, 2**63 - 1, 2**63, 2**64, 10**27, 2**280, 2**84 - 1, *(rng.getrandbits(rng.randint(1, 900)) for _ in range(60)), 10**1300 + 7]
    hexes = values(spark, E.to_hex, [str(n) for n in numbers])
    assert hexes == [format(n, "x") for n in numbers]
    assert values(spark, E.from_hex, hexes) == [str(n) for n in numbers]
    assert values(spark, E.from_hex, ["00", "0f", "F", "", "g", "0x1", "1\n", None]) == [None] * 8
    typed = [bytes(x) for x in values(spark, E.encode_integer, [str(n) for n in numbers])]
    width = lambda n: max(1, (n.bit_length() + 7) // 8)
    assert typed == [b"I" + width(n).to_bytes(8, "big") + n.to_bytes(width(n), "big") for n in numbers]


def test_integers_of_4301_digits(spark):
    import sys

    text = "9" * 4301
    back = values(spark, lambda c: E.from_hex(E.to_hex(c)), [text])
    assert back == [text]
    sys.set_int_max_str_digits(0)
    assert values(spark, E.to_hex, [text]) == [format(int(text), "x")]


def test_unbounded_sums(spark):
    rows = spark.createDataFrame([("a", "9" * 50, "included"), ("a", "1", "included"), ("a", "5", "excluded"), ("b", None, "included"), ("c", "9" * 4301, "included"), ("c", "7", "included"), ("d", "0", "included"), *[("e", "999999999", "included")] * 1000], "k string, d string, status string")
    got = dict(entity_totals_unbounded(rows, "k", "d").collect())
    assert got == {"a": "1" + "0" * 50, "b": "0", "c": "1" + "0" * 4300 + "6", "d": "0", "e": str(999999999 * 1000)}
