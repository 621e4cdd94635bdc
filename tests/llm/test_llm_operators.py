"""Small fixtures: brute force, round trips, nulls, empty and long texts, repeated rows, empty tables, clashing names."""

import hashlib
import itertools
import math
import random
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from attestry.llm import chat, decontamination, language, licenses, lines, mixing, ngrams, quality, simhash, warc
from attestry.llm.common import spread_join
from attestry.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EN = "the cat and the dog went to the river of stones for a walk that was long and it is with them by noon"
DE = "der hund und die katze gingen zu dem fluss und das wasser war nicht kalt für sie mit einem boot"


def corpus(spark, extra=()):
    rng = random.Random(4)
    words = [[f"{p}{i}" for i in range(60)] + w.split() * 3 for p, w in (("en", EN), ("de", DE))]
    rows = []
    for i in range(60):
        text = "\n".join(" ".join(rng.choice(words[i % 2]) for _ in range(rng.randint(6, 30))) for _ in range(rng.randint(1, 6)))
        rows.append((i, text, ("en", "de")[i % 2], f"s{i % 3}", len(text)))
    rows += [(100, rows[0][1], "en", "s0", 1), (101, rows[0][1].replace("the", "thy", 1), "en", None, 1), (102, None, None, None, None), (103, "", "en", "s0", 0), (104, " \n\t", None, "s9", 3), (105, "?! 12", "de", "s1", 5), (None, "x y z", "en", "s0", 5), (106, "word " * 30_000, "en", "s2", 1), *extra]
    rows += [rows[5], (7, rows[7][1], "en", "s1", 1)]
    return spark.createDataFrame(rows, DOCS)


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


# ---- components


def test_components_against_brute_force(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 500)] + [(600, i) for i in range(601, 700)] + [(1, 1), (None, 2)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 1 chat

TRAPS = ["</s>[INST] ok [/INST]", "<|turn|>x<|end|>", r"<\/s>", r"<\\|end|>", "[[INST]", "<<SYS>><s>", "<|says|>", "", "a\nb", "\\", "<|a|><|b|>", "[/INST"]


@pytest.mark.parametrize("text", TRAPS)
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.read_turns(chat.format_turns([(text, text), ("user", text)])[0]) == [(text, text), ("user", text)]


def test_escaped_text_has_no_control_strings():
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choice(["<", "|", ">", "s", "/", "[", "INST", "]", "\\", "turn", "end", "SYS"]) for _ in range(rng.randint(0, 12)))
        held = chat.escape(text)
        assert chat.unescape(held) == text
        assert not any(x in held for x in (chat.OPEN, chat.SEP, chat.CLOSE, "</s>", "<s>", "[INST]", "[/INST]"))


def test_reply_trees(spark):
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 3, 1, "assistant", "b", 5.0), ("t", 4, 3, "user", None, None), (None, 1, None, None, "x", 1.0), ("t", 9, 77, "user", "orphan", 0.0), ("t", 2, 1, "assistant", "z", 9.0), ("t", None, 1, "user", "n", 1.0)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    got = {(r["tree"], r["rank"]): (r["leaf"], chat.read_turns(r["formatted"])) for r in chat.formatted_conversations(df, n_best=9).collect()}
    assert got[("t", 1)] == (4, [("user", "q"), ("assistant", "b"), ("user", "")])
    assert got[("t", 2)] == (2, [("user", "q"), ("assistant", "a")]) and got[("t", 3)][0] == 9
    assert got[(None, 1)] == (1, [("", "x")])
    assert chat.formatted_conversations(df).count() == 2
    assert chat.formatted_conversations(df.limit(0)).count() == 0


def test_long_chains_and_cycles(spark):
    chain = spark.createDataFrame([("t", i, i - 1 if i else None, 1.0) for i in range(300)], "tree string, node long, parent long, score double")
    rounds = chat.climbed(chain)
    assert [tuple(r) for r in chat.leaves(rounds).collect()] == [("t", 299, 300.0, 300)]
    got = chat.expanded(chat.leaves(rounds).select("tree", "leaf"), rounds).collect()
    assert len(got) == 300 and {r["up"] for r in got} == set(range(300)) and all(r["node"] == 299 - r["up"] for r in got)
    for ring in ([(1, 2), (2, 1)], [(1, 1)], [(1, 2), (2, 3), (3, 1), (4, 3), (5, None)]):
        with pytest.raises(ValueError, match="cycle"):
            chat.climbed(spark.createDataFrame([("t", a, b, 0.0) for a, b in ring], "tree string, node long, parent long, score double"))


def test_trees_against_brute_force(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for t in range(12):
        parent, score = {}, {}
        for n in range(rng.randint(1, 40)):
            parent[n], score[n] = (rng.choice([n - 1, rng.randrange(n)]) if n else None), rng.choice([0.25, 1.0, -0.5])
            rows.append((t, n, parent[n], rng.choice(["user", "assistant"]), f"{t}.{n} " + "long " * rng.choice([1, 20_000 if t == 0 and n == 3 else 2]), score[n], "clash"))
        paths = []
        for leaf in set(parent) - set(parent.values()):
            path = [leaf]
            while parent[path[-1]] is not None:
                path.append(parent[path[-1]])
            paths.append((-sum(score[n] for n in path), leaf, path[::-1]))
        want |= {(t, k): (leaf, -total, path) for k, (total, leaf, path) in enumerate(sorted(paths)[:3], start=1)}
    df = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double, up string")
    said = {(r[0], r[1]): (r[3], r[4]) for r in rows}
    got = chat.formatted_conversations(df, n_best=3).collect()
    assert {(r["tree"], r["rank"]) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        leaf, total, path = want[r["tree"], r["rank"]]
        assert (r["leaf"], r["score"], r["n_turns"]) == (leaf, pytest.approx(total), len(path))
        assert chat.read_turns(r["formatted"]) == [said[r["tree"], n] for n in path]


def test_conversation_digests(spark):
    said = [(1, 0, "user", "hi"), (1, 1, "assistant", "<s>é"), (1, 2, "user", None), (1, 3, "assistant", "ok"), (None, 0, "user", "x"), (2, 0, "assistant", ""), (2, 0, "assistant", "")]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.digests(chat.linear_conversations(df)).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256("user\nhi\nassistant\n<s>é\nuser\n\nassistant\nok\n".encode()).hexdigest()
    assert got[1]["loss_chars"] == 6 and got[1]["loss_sha256"] == hashlib.sha256("<s>éok".encode()).hexdigest()
    assert got[2]["n_turns"] == 2 and got[None]["n_turns"] == 1


# ---- 2 quality


def counts(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    ls = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(ls) - len(set(ls)), len(covered)


def test_quality_counts(spark):
    rng = random.Random(3)
    made = ["a b c d e f a b c d e g", "a a a a a a a", "x\n\n x\nx\n", "a\vb\fc", "é ü#*$%&|<>", " a b", "a b ", "   ", "a b c d e", *(" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(60))]
    df = corpus(spark, [(1000 + i, x, None, None, None) for i, x in enumerate(made)]).withColumn("words", F.lit(1))
    for r in quality.judged(df).collect():
        q = r["quality"]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == counts(r["text"]), r["text"]
    assert quality.judged(df.limit(0)).count() == 0
    plan = quality.judged(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- 3 language


def test_language(spark):
    docs = corpus(spark)
    found = language.classified(docs.withColumn("score", F.lit("old")), language.learn(docs)).collect()
    assert len(found) == docs.count()
    by = {r["doc_id"]: r for r in found}
    assert sum(by[i]["lang_pred"] == ("en", "de")[i % 2] for i in range(60)) >= 58
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (102, 103, 104, 105))
    assert all(0 <= r["score"] <= 1 for r in found) and by[106]["lang_pred"] in ("en", "de")
    assert language.classified(docs, []).where("lang_pred <> 'und'").count() == 0
    assert language.learn(docs.limit(0)) == [] and language.classified(docs.limit(0), [("en", b"x")]).count() == 0


def test_unlearned_languages_and_noise_are_narrow():
    rng = random.Random(11)
    syllables = lambda n: ["".join(rng.choice("bcdfghklmnprstvwz") + rng.choice("aeiou") for _ in range(rng.randint(1, 2))) for _ in range(n)]
    spoken = {k: syllables(120) for k in "abc"}
    say = lambda words, n: " ".join(f"{rng.choice(words)}{rng.choice(words)}" for _ in range(n))
    classify = language.Classifier([(k, say(v, 12000).encode()) for k, v in spoken.items()])
    kept = lambda texts: sum(language.margin(classify(t.encode()))[1] >= language.LEAST_MARGIN for t in texts) / len(texts)
    other = ["õ", "ä", "ü", "kk", "ll", "tt", "aa", "uu", "ja", "on", "sy", "yö"]
    assert kept([say(spoken[k], 80) for k in "abc" * 30]) >= 0.97
    assert kept([say(other, 80) for _ in range(90)]) <= 0.1
    assert kept([" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(80)) for _ in range(90)]) <= 0.1


def test_every_language_is_learned_from_texts_alone(spark):
    rows = [("en", EN + f" {i}") for i in range(5)] + [("xx", " ".join(f"qo{i % 7}ra zu" for i in range(20_000)))] * 2 + [("12", "12 12"), (None, "who")]
    a = spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string")
    b = spark.createDataFrame([(-i, lang, t) for i, (lang, t) in enumerate(reversed(rows))], "doc_id long, lang string, text string")
    learned = language.learn(a)
    assert [x for x, _ in learned] == ["en", "xx"] and learned == language.learn(b)
    assert 10_000 < len(learned[1][1]) <= 2 * language.SAMPLE_CHARS + 2
    more = [(f"l{k}", " ".join(f"{c}{d}{k}" for c in "abcdefgh" for d in "xyz").encode() * 20) for k, c in enumerate("ijklmno")]
    for block in (1, 2, 64):
        found = {r["doc_id"]: (r["lang_pred"], r["score"], r["n"]) for r in language.classified(a.withColumn("n", F.lit("x")), learned + more, block=block).collect()}
        assert [found[k][0] for k in (0, 5, 7)] == ["en", "xx", "und"]
        assert block == 1 or found == before
        before = found
    private = language.classified(a.withColumn("score", F.lit("kept")), learned, names=("__l", "__m"))
    assert private.where("score = 'kept'").count() == len(rows)


def test_marks_belong_to_words():
    assert language.plain("हिन्दी, ok 12_x") == "हिन्दी ok x".encode()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = docs.where((language.remainder() == 2) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    found = language.classified(held, language.learn(docs.where(language.remainder() != 2)))
    n, right, kept = found.agg(F.count(F.lit(1)), F.count_if(F.col("lang") == F.col("lang_pred")), F.count_if(~language.rejected())).first()
    assert right >= 0.97 * n and kept >= 0.95 * n


# ---- 4 WARC


def test_warc(spark, tmp_path):
    big, small = "<p>é\r\n\r\nWARC/1.1\r\n" + "x" * 1200, "y" * 10
    rows = [(1, "http://a/\n", big), (5, None, big), (3, "http://c/", big), (4, "http://d/", small), (6, "http://e/", small), (7, "u", None), (8, "u", ""), (None, "n", big), (5, None, big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_warc(df, str(tmp_path / "w"))
    records = warc.read_warc(spark, str(tmp_path / "w"))
    got = warc.revisited(warc.transactions(records)).collect()
    assert len(got) == len(rows) and all(len(r["requests"]) == len(r["metadata"]) == 1 and not r["others"] for r in got)
    digest = hashlib.sha1(big.encode()).hexdigest()
    mine = [r for r in got if r["payload_digest"] == digest]
    assert sorted(r["main"]["type"] for r in mine) == ["response"] + ["revisit"] * 4
    kept = next(r for r in mine if r["main"]["type"] == "response")
    assert b"page-id: 5\r\n" == bytes(kept["metadata"][0]["payload"]) and bytes(kept["main"]["payload"]) == big.encode()
    assert all(r["original"] == kept["main"]["record_id"] and r["payload_bytes"] == len(big.encode()) for r in mine if r is not kept)
    assert sum(r["main"]["type"] == "response" for r in got) == 5
    plan = lambda n: sorted(map(str, warc.captures(df.withColumn("digest", F.lit("clash")), broadcast_rows=n).drop("payload").collect()))
    assert plan(0) == plan(1 << 17)
    warc.write_warc(df.limit(0), str(tmp_path / "e"))
    assert warc.transactions(warc.read_warc(spark, str(tmp_path / "e"))).count() == 0


def test_records_are_connected_in_any_direction(spark):
    rows = [
        ("r1", "response", ["q1"]), ("q1", "request", ["r1"]), ("q2", "request", ["r1", "m1"]), ("m1", "metadata", []), ("x", "conversion", ["m1"]),  # a cycle and several links
        ("r2", "revisit", []), ("q3", "request", ["r2"]), ("m3", "metadata", ["q3"]), ("m2", "metadata", ["r2", "r2"]),  # a chain
        ("q9", "request", ["lost"]), ("m9", "metadata", ["lost"]), ("r3", "response", []), ("r4", "resource", ["r3"]), ("me", "response", ["me"]), (None, "damaged", []), ("r3", "response", []),
    ]
    df = spark.createDataFrame(rows, "record_id string, type string, concurrent_to array<string>").withColumn("capture", F.lit("clash"))
    names = lambda xs: [x["record_id"] for x in xs]
    got = {(r["main"] and r["main"]["record_id"], *(tuple(names(r[k])) for k in ("requests", "metadata", "others"))) for r in warc.transactions(df).collect()}
    assert got == {("r1", ("q1", "q2"), ("m1",), ("x",)), ("r2", ("q3",), ("m2", "m3"), ()), (None, ("q9",), ("m9",), ()), ("r3", (), (), ("r4",)), ("me", (), (), ())}


def test_damaged_archives(spark, tmp_path):
    import gzip

    one = b"WARC/1.1\r\nWARC-Record-ID: a\r\nWARC-Type: metadata\r\nWARC-Concurrent-To: b\r\nWARC-Concurrent-To: c\r\nX: caf\xe9\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    bad = b"WARC/1.1\r\nWARC-Type: response\r\n\r\nbody\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(b"junk\r\n" + one + bad + one + b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort")
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(one))
    got = sorted((r["type"], r["record_id"] or "", tuple(r["concurrent_to"])) for r in warc.read_warc(spark, str(tmp_path)).collect())
    assert got == [("damaged", "", ())] * 3 + [("metadata", "a", ("b", "c"))] * 4


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_joined_in_parts(spark, how):
    rng = random.Random(1)
    left = [(i, rng.choice(["hot"] * 5 + [f"k{rng.randrange(30)}", "gone", None])) for i in range(800)]
    a, b = spark.createDataFrame(left, "id long, k string"), spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(30)], "b string, v int")
    want = [(i, k, {"hot": 1}.get(k, int(k[1:]) if k and k[0] == "k" else None)) for i, k in left]
    got = [(r["id"], r["k"], r["v"]) for r in spread_join(a, b, "k", "b", how, least_hot=10).collect()]
    assert sorted(map(str, got)) == sorted(str(w) for w in want if how == "left" or w[2] is not None)


# ---- 5 lines


def test_edit_distance():
    rng = random.Random(1)

    def plain(a, b):
        p = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            c = [i]
            for j, y in enumerate(b, 1):
                c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (x != y)))
            p = c
        return p[-1]

    for _ in range(1500):
        a, b = ("".join(rng.choice("ab ") for _ in range(rng.randint(0, 14))) for _ in range(2))
        d, most = plain(a, b), rng.randint(0, 14)
        got = lines.distance(a, b, most)
        assert got == d if d <= most else got > most
        longer = max(len(a), len(b))
        assert lines.similar(a, b) == (d <= int(0.2 * longer + 1e-9))


def test_edits_of_many_pairs_are_those_of_each_and_cost_less():
    rng = random.Random(4)
    said, most = ["", "", "x" * 5000, "x" * 4990 + "y"], [0, 1200]
    for k in range(600):
        letters, n = ("ab ", "abcdefgh ijk", "日本語中文字abc ")[k % 3], rng.choice([0, 1, 5, 63, 64, 65, 128, 129, 200, 300])
        text = [rng.choice(letters) for _ in range(n)]
        other = [x for c in text for x in rng.choice(([c], [c], [c], [c], [c], [c], [c], [], [rng.choice(letters)], [c, rng.choice(letters)]))]
        said += ["".join(text), "".join(other)]
        most.append(rng.choice([n // 5, rng.randint(0, 100)]))
    one, two = np.arange(0, len(said), 2), np.arange(1, len(said), 2)
    got = lines.Texts(said).edits(one, two, np.array(most)).tolist()
    for a, b, m, n in zip(said[::2], said[1::2], most, got, strict=True):
        d = lines.distance(a, b, len(a) + len(b))
        assert d <= n <= m if d <= m else n == -1
    assert 100 < sum(n >= 0 for n in got) < 500
    base = ["".join(rng.choice("abcdefghijk ") for _ in range(400)) for _ in range(300)]
    assert (lines.Texts(base).edits(np.arange(0, 300, 2), np.arange(1, 300, 2), np.full(150, 200)) < 0).sum() == sum(lines.distance(a, b, 200) > 200 for a, b in zip(base[::2], base[1::2], strict=True))
    t = time.process_time()
    lines.Texts(base).edits(np.arange(0, 300, 2), np.arange(1, 300, 2), np.full(150, 200))
    many, t = time.process_time() - t, time.process_time()
    for a, b in zip(base[::2], base[1::2], strict=True):
        lines.edits(a, b, 200)
    assert many < 0.6 * (time.process_time() - t)


def test_linked_lines_are_those_that_comparing_all_pairs_connects():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    base = [[rng.choice(words) for _ in range(20)] for _ in range(3)]
    said, group = [], []
    for g in range(6):
        for _ in range(40):
            said.append(" ".join(rng.choice(words) if rng.random() < 0.12 else w for w in rng.choice(base)))
            group.append(g)
    size = np.array([len(x) for x in said])
    mins = np.array([[rng.randrange(4) for _ in range(lines.TABLES)] for _ in said], dtype=np.uint64)
    tab = np.repeat([0, 1, 2, 3, 4, 0], 40)
    near = lines.Near(lines.RADIUS, lines.SIMILARITY)
    for held in (1 << 20, 50):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(lines, "PAIRS_HELD", held)
            label = lines.linked(np.array(group), tab, np.stack([size, 0 * size, 0 * size], axis=1), mins, said, near, lines.SIMILARITY)
        root = list(range(len(said)))
        for i, j in itertools.combinations(range(len(said)), 2):
            if group[i] == group[j] and not (mins[i, : tab[i]] == mins[j, : tab[i]]).any() and lines.similar(said[i], said[j]):
                a, b = root[i], root[j]
                root = [a if x == b else x for x in root]
        assert len({*zip(root, label.tolist(), strict=True)}) == len(set(root)) == len(set(label.tolist()))
        assert 6 < len(set(root)) < 200


def test_lines_against_brute_force(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(12)]
    rows = []
    for i in range(40):
        picked = []
        for _ in range(rng.randint(1, 5)):
            w = rng.choice(base).split()
            if rng.random() < 0.7:
                w[rng.randrange(len(w))] = rng.choice(words)
            picked.append(" ".join(w).upper() if rng.random() < 0.3 else " ".join(w) + "!")
        rows.append((i, "\n".join([*picked, "short line", ""])))
    rows += [(50, None), (51, ""), rows[3], (None, rows[4][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("clash")).withColumn("h", F.lit(0))
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in lines.deduplicated(df).collect()), key=str)
    hashed = lines.LineHashes(lines.LEAST_WORDS)
    marks = {x: m for x, m in spark.createDataFrame([(t,) for t in {t for _, t in rows if t is not None}], "t string").select("t", F.xxhash64("t")).collect()}
    spots = sorted({((d is not None, d), marks[t], n, h, lines.normal(t.split("\n")[n])) for d, t in rows if t is not None for n, h, *_ in next(hashed([t]))}, key=lambda x: x[:3] if x[0][0] else ((False, 0), *x[1:3]))
    kinds = {h: said for _, _, _, h, said in spots}
    root = {h: h for h in kinds}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(kinds, 2):
        if lines.similar(kinds[a], kinds[b]) and len(kinds[a]) >= lines.FUZZY_CHARS:
            root[find(a)] = find(b)
    seen, gone = set(), set()
    for d, m, n, h, _ in spots:
        if find(h) in seen:
            gone.add((d, m, n))
        seen.add(find(h))
    want = []
    for k, (d, t) in enumerate(rows):
        if t is None:
            want.append((d, None, 0, 0))
            continue
        said = t.split("\n")
        # a row that repeats another whole loses all its lines with a word
        left = [x for n, x in enumerate(said) if (not x if (d, t) in rows[:k] else ((d is not None, d), marks[t], n) not in gone)]
        want.append((d, "\n".join(left), len(said), len(said) - len(left)))
    assert len(gone) > 40 and any(find(h) != h for h in root)
    assert got == sorted(want, key=str)
    assert lines.deduplicated(df.limit(0)).count() == 0


def test_lines_that_are_similar_are_found_whatever_their_simhash(spark):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    held, rows = [], []
    for n in [6, 10, 15, 20, 40] * 30:
        line = [rng.choice(words) for _ in range(n)]
        other = list(line)
        for i in rng.sample(range(n), max(1, n // 8)):
            other[i] = rng.choice(words)
        if lines.similar(" ".join(line), " ".join(other)):
            held.append((" ".join(line), " ".join(other)))
            rows += [(2 * len(held), held[-1][0]), (2 * len(held) + 1, held[-1][1])]
    got = {r["doc_id"]: r["n_removed"] for r in lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # by brute force without a radius each pair is one group: the second of it goes, and no first
    assert not any(lines.similar(a, b) for (a, _), (b, _) in itertools.combinations(held, 2))
    assert len(held) > 100 and not any(got[2 * k] for k in range(1, len(held) + 1))
    assert sum(got[2 * k + 1] for k in range(1, len(held) + 1)) >= 0.98 * len(held)


def test_short_lines_that_repeat_go_and_differing_ones_stay(spark):
    long = "未来的天气将会变得越来越暖和所以我们今天要出门去公园散步"
    rows = [(1, "Read more\n\nChapter 1\n你好世界\n" + long), (2, "read  more!\n\nChapter 2\n你好世界\n" + long.replace("公园", "海边")), (3, "Read more\n---\nChapter 1\n---")]
    got = {r["doc_id"]: r["text"] for r in lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "\nChapter 2", 3: "---\n---"}


def test_lines_of_documents_are_found_by_edit_similarity_alone(spark):
    said = sorted({x for t in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null").toPandas()["text"] for x in map(lines.normal, t.split("\n")) if len(x) >= lines.FUZZY_CHARS})
    size = np.array([len(x) for x in said])
    letters = np.stack([np.bincount(np.frombuffer(x.encode("utf-32-le"), np.uint32) % 61, minlength=61) for x in said])
    pairs = []
    for i in range(1, len(said)):
        most = 0.2 * np.maximum(size[:i], size[i])
        near = np.flatnonzero((abs(size[:i] - size[i]) <= most) & (abs(letters[:i] - letters[i]).sum(axis=1) <= 2 * most))
        pairs += [(i, j) for j in near.tolist() if lines.similar(said[i], said[j])]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(said)], "doc_id long, text string")
    groups = lines.alike_groups(lines.occurrences(rows).where("mins is not null"))
    of = {}
    for g, h, _ in groups.collect():
        of.setdefault(h, set()).add(g)
    key = {r["doc_id"]: r["h"] for r in lines.occurrences(rows).collect()}
    found = sum(bool(of.get(key[i], set()) & of.get(key[j], set())) for i, j in pairs)
    assert len(pairs) > 20 and found >= 0.9 * len(pairs)


@pytest.mark.parametrize("bucket", [2048, 8])
def test_alike_groups_lose_no_pair(spark, bucket):
    rng = random.Random(2)
    base, rows = rng.getrandbits(128), []
    signed = lambda v: v - (v >> 63 << 64)
    for h in range(150):
        v = base
        for _ in range(rng.randint(0, 26)):
            v ^= 1 << rng.randrange(128)
        mins = b"".join(rng.choice((b"common", bytes(rng.choices(range(256), k=6)))) for _ in range(lines.TABLES))
        rows += [(h, rng.randint(80, 110), signed(v >> 64), signed(v & (1 << 64) - 1), mins)] * rng.randint(1, 2)
    of = {}
    for g, h, _ in lines.alike_groups(spark.createDataFrame(rows, "h long, size int, s long, t long, mins binary"), bucket=bucket).collect():
        of.setdefault(h, set()).add(g)
    tables = lambda m: {(k, m[6 * k : 6 * k + 6]) for k in range(lines.TABLES)}
    bits = lambda x, y: ((x ^ y) & (2**64 - 1)).bit_count()
    n = 0
    for (h, a, s, t, m), (i, b, u, v, o) in itertools.combinations(sorted(set(rows)), 2):
        if bits(s, u) + bits(t, v) <= lines.RADIUS and abs(a - b) <= 0.2 * max(a, b) and tables(m) & tables(o):
            assert of.get(h, set()) & of.get(i, set())
            n += 1
    assert n > 1000


def test_line_hashes_are_those_of_normal_forms():
    rng = random.Random(3)
    texts = ["", "\n", " a\n\nb c ", "Ünï  Σς!x\n--\n" + "é" * 30, "x" * 5000, "İ ß\r\n\x1e", *("".join(rng.choice("ab Éß.\n\t日-") for _ in range(rng.randint(0, 60))) for _ in range(300))]
    for said, found in zip(texts, lines.LineHashes(1)(texts), strict=True):
        want = [(n, x) for n, x in enumerate(lines.normal(y) for y in said.split("\n")) if x]
        assert [(n, h, size) for n, h, size, *_ in found] == [(n, (k := xxhash.xxh3_64_intdigest(x)) - (k >> 63 << 64), len(x)) for n, x in want]


def test_large_buckets_and_joined_places_give_the_same_lines(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(20)]
    rows = [(k, " ".join(rng.choice(words) if rng.random() < 0.06 else w for w in base) + "\n" + " ".join(rng.choice(words) for _ in range(9))) for k in range(60)]
    rows += [(100, "x " * 40_000 + "\n" + "y " * 40_000 + "z"), (101, "y " * 40_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, lines.deduplicated(df).collect()))
    assert sum(r[3] for r in want) > 50
    assert sorted(map(tuple, lines.deduplicated(df, bucket=8, broadcast_lines=0).collect())) == want


# ---- 6 SimHash


def test_bit_sliced_distances():
    rng = random.Random(5)
    values = [rng.getrandbits(8) << rng.choice([0, 30, 56]) for _ in range(200)]
    free = list(range(64))
    block = simhash.planes(values, free)
    for radius in (0, 1, 2, 3, 6):
        q = rng.choice(values)
        got = simhash.within(block, free, len(values), q, radius)
        assert got == sum(1 << i for i, v in enumerate(values) if (v ^ q).bit_count() <= radius)


def test_majorities():
    h = np.random.default_rng(1).integers(0, 2**63, 3000).astype("<u8")
    starts = np.array([0, 1, 3, 700, 1000])
    want = []
    for a, b in zip(starts, [*starts[1:], len(h)], strict=True):
        bits = [sum(int(x) >> k & 1 for x in h[a:b]) * 2 > b - a for k in range(64)]
        v = sum(1 << k for k, on in enumerate(bits) if on)
        want.append(v - (v >> 63 << 64))
    assert simhash.majorities(h, starts).tolist() == want


def test_near_duplicates_against_brute_force(spark):
    docs = corpus(spark).withColumn("fp", F.lit("clash"))
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    fps = {r["fp"] for r in got}
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(fps, 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
            root[find(a)] = find(b)
    least = {}
    for r in got:
        if r["doc_id"] is not None:
            least[find(r["fp"])] = min(r["doc_id"], least.get(find(r["fp"]), 10**9))
    assert all(r["component_id"] == least.get(find(r["fp"])) for r in got)
    assert {r["fp"] for r in got if r["doc_id"] in (102, 103, 104)} == {0}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_chains_of_fingerprints_link(spark):
    df = spark.createDataFrame([((1 << k) - 1,) for k in range(0, 60, 2)], "fp long")
    assert components(simhash.near_fingerprints(df)).select("label").distinct().count() == 1


def test_fingerprints_by_hand(spark):
    """From the text alone: words between ASCII white space, triples with repeats, XXH64 with seed 42, bits set in over half."""
    import re

    def by_hand(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
        return format(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)), "016x")

    rows = [(1, None), (2, ""), (3, "One"), (4, "One\x0btwo\x0cTHREE"), (5, "É a\u00a0b ÉA c"), (6, "x y z " * 4000), (7, "a b c a b c d"), (8, "\u2028 \x1c q")]
    docs = corpus(spark).select("doc_id", "text").where("doc_id > 8").distinct().unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r["doc_id"], format(r["fp"] & (1 << 64) - 1, "016x")) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(r["doc_id"], by_hand(r["text"])) for r in docs.collect()}


# ---- 7 mixing


def test_targets():
    assert mixing.targets([100, 100, 100]) == pytest.approx([187.5, 75, 37.5])
    got = mixing.targets([10, 100, 100])
    assert got[0] == 30 and sum(got) == pytest.approx(210) and got[1] == pytest.approx(120) and got[2] == pytest.approx(60)
    assert mixing.targets([0, 0]) == [0, 0] and mixing.targets([]) == []


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permutations(n):
    x = np.arange(n)
    y = mixing.permuted(x, n, b"k")
    assert sorted(y.tolist()) == x.tolist() and mixing.permuted(y, n, b"k", back=True).tolist() == x.tolist()


@pytest.mark.parametrize("quota", [[5, 0, 1], [1000, 3, 250, 17], [1], []])
def test_shards_are_drawn_exactly_and_alike_in_parts(quota):
    quota = np.array(quota, dtype=np.int64)
    every = list(mixing.draw(quota, 8, 3))
    assert [s for s, _, _ in every] == list(range(mixing.shards_of(quota, 8)))
    before = np.zeros_like(quota)
    for shard, first, counts in every:
        assert first.tolist() == before.tolist() and (counts >= 0).all()
        assert counts.sum() == min(8, quota.sum() - 8 * shard)
        before = before + counts
    assert before.tolist() == quota.tolist()
    for low in range(0, len(every), 3):
        part = list(mixing.draw(quota, 8, 3, low, low + 3))
        assert [(s, f.tolist(), c.tolist()) for s, f, c in part] == [(s, f.tolist(), c.tolist()) for s, f, c in every[low : low + 3]]


def test_mix(spark):
    docs = corpus(spark).withColumn("size", F.lit("clash"))
    once, again = ([tuple(r) for r in mixing.mix_report(docs).orderBy("doc_id", "source", "size").collect()] for _ in range(2))
    assert once == again and len(once) == docs.count()
    per = {}
    for _, source, size, source_size, target, taken in once:
        assert taken <= 3 * size and source_size >= size
        per.setdefault(source, [target, 0])[1] += taken
    assert all(abs(t - n) <= 1 for t, n in per.values())
    assert mixing.mix_report(docs.limit(0)).count() == 0


def test_pieces_fill_the_slots(spark):
    sized = spark.createDataFrame([(i, "ab"[i % 2], 40 + i) for i in range(30)], "doc_id long, source string, size long")
    placed, pieces = mixing.mixed(sized, block=32, shard_slots=8)
    per = pieces.groupBy("shard", "slot").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("n")).collect()
    assert all(r["n"] <= 32 for r in per) and sum(r["n"] == 32 for r in per) >= len(per) - 6
    assert placed.count() == 30


def test_mix_against_brute_force(spark):
    """taken, rebuilt from the drawn slots word by word, on the order in which the documents lie."""
    docs = corpus(spark)
    words = lambda t: len(__import__("re").findall(r"[^\x20\x09-\x0D]+", t or ""))
    rows = docs.collect()
    sized = spark.createDataFrame([(r["doc_id"], r["source"], words(r["text"])) for r in rows], "doc_id long, source string, size long")
    assert sorted((str(r["doc_id"]), r["size"]) for r in mixing.mix_report(docs).collect()) == sorted((str(r["doc_id"]), words(r["text"])) for r in rows)
    for broadcast in (0, 100):
        placed, pieces = (x.collect() for x in mixing.mixed(sized, block=16, shard_slots=32, seed=3, broadcast_sources=broadcast))
        names = sorted({r["source"] for r in placed}, key=lambda s: (s is None, s or ""))
        total = [sum(r["size"] for r in placed if r["source"] == s) for s in names]
        goal = mixing.targets(total)
        line = {}
        for r in sorted(placed, key=lambda r: r["start"]):
            at = line.setdefault(r["source"], [])
            assert r["size"] == 0 or r["start"] == len(at)
            at += [r["row_id"]] * r["size"]
        plans = [mixing._plan(i, n, t, 16, 3) for i, (n, t) in enumerate(zip(total, goal, strict=True))]
        want, slots = Counter(), 0
        for shard, before, counts in mixing.draw(np.array([p["slots"] for p in plans]), 32, 3):
            assert shard == slots // 32
            for i, n in enumerate(counts.tolist()):
                for j in range(int(before[i]), int(before[i]) + n):
                    slots += 1
                    epoch, inner = divmod(j, plans[i]["blocks"])
                    block = int(mixing.permuted(np.array([inner]), plans[i]["blocks"], f"3/{i}/{epoch}".encode())[0])
                    said = line[names[i]][16 * block : 16 * block + 16]
                    if j == plans[i]["slots"] - 1 and plans[i]["last"] is not None:
                        said = said[: plans[i]["last"]]
                    want.update(said)
        got = Counter()
        for p in pieces:
            got[p["row_id"]] += p["to_word"] - p["from_word"]
        assert got == want and slots == sum(p["slots"] for p in plans)
        for s, n, t in zip(names, total, goal, strict=True):
            assert abs(sum(got[x] for x in set(line.get(s, ()))) - t) <= 1 and t <= 3 * n


def test_many_sources(spark):
    n = 3000
    sized = spark.createDataFrame([(i, f"s{i}", i % 5) for i in range(n)], "doc_id long, source string, size long")
    placed, pieces = mixing.mixed(sized, block=4, shard_slots=64)
    took = {r["row_id"]: r["n"] for r in pieces.groupBy("row_id").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("n")).collect()}
    assert all(abs(took.get(r["row_id"], 0) - r["target"]) <= 0.5 for r in placed.collect())


# ---- 8 decontamination


def test_common_subsequence():
    rng = random.Random(3)

    def plain(a, b):
        p = [0] * (len(b) + 1)
        for x in a:
            c = [0]
            for j, y in enumerate(b, 1):
                c.append(p[j - 1] + 1 if x == y else max(p[j], c[-1]))
            p = c
        return p[-1]

    for _ in range(500):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(1, 12))] for _ in range(2))
        assert decontamination.common_subsequence(a, b) == plain(a, b)


def test_leaks(spark):
    rng = random.Random(8)
    words = EN.split() + [f"w{i}" for i in range(1500)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [say(rng.randint(15, 59)) for _ in range(30)]
    rows, want = [], set()
    for i in range(200):
        text = say(rng.randint(5, 400))
        if i % 4 == 0:
            k = rng.randrange(30)
            item = list(items[k])
            if i % 8 == 0:
                for j in range(0, len(item) - 8, 5):
                    item[j] = "other"
            at = rng.randint(0, len(text))
            text[at:at] = item
            want.add((i, k))
        rows.append((i, ("\n" if i % 3 else " ").join(text).upper() if i % 5 else " ".join(text)))
    docs = spark.createDataFrame([*rows, (300, None), (301, ""), (None, " ".join(items[0])), rows[0]], "doc_id long, text string")
    bench = spark.createDataFrame([*((i, " ".join(x) + ".") for i, x in enumerate(items)), (90, None), (91, "too short")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, bench).collect()}
    assert got - {(None, 0)} == want and (None, 0) in got
    blocks = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, bench, items_at_once=7).collect()}
    assert blocks == got
    flat = decontamination.contamination(docs, bench)
    assert flat.count() == 203 and flat.where("contaminated").count() == len({d for d, _ in got})
    assert decontamination.leaks(docs.limit(0), bench).count() == 0 and decontamination.leaks(docs, bench.limit(0)).count() == 0


def test_paraphrases_with_another_ending_are_found(spark):
    rng = random.Random(9)
    words = EN.split() + [f"w{i}" for i in range(1500)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [say(rng.randint(20, 50)) for _ in range(30)]
    rows, want = [], set()
    for i in range(150):
        text = say(rng.randint(50, 300))
        if i % 2:
            k = rng.randrange(30)
            item = list(items[k])
            for j in {len(item) - 1, len(item) - 3, *rng.sample(range(len(item)), len(item) // 4)}:
                item[j] = "other"
            text[40:40] = item
            want.add((i, k))
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, bench).collect()}
    assert not got - want and len(got) >= 0.95 * len(want)


def test_short_copies_of_a_large_benchmark_are_found(spark):
    assert decontamination.ITEMS <= 3 * decontamination.RANK  # beyond that copies of short items were lost in real texts
    rng = random.Random(10)
    words = EN.split() + [f"w{i}" for i in range(4000)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [say(15) for _ in range(1500)]
    rows = []
    for k in range(300):
        text = say(200)
        text[70:70] = items[k]
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, bench).collect()}
    assert got <= {(k, k) for k in range(300)} and len(got) >= 0.95 * 300


def test_short_items_are_found_word_by_word(spark):
    items = ["What is the capital of France, exactly?", "two words", "a b c", "Yes", None, "", "?!"]
    docs = [items[0], "so: what IS the\ncapital of france exactly 9", "what is the capital of big france exactly", "Two, words!", "these two words", "x a b c", "a b x c", "yes", "yes yes", None, "", "long " * 50_000 + "a b c"]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    for key in ("long", "string"):
        b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumn("item_id", F.col("item_id").cast(key))
        got = {(r["doc_id"], int(r["item_id"])) for r in decontamination.leaks(d, b).collect()}
        assert got == {(0, 0), (1, 0), (3, 1), (5, 2), (7, 3), (11, 2)}
        assert decontamination.contamination(d, b).where("contaminated").count() == 6


def test_leaks_against_brute_force(spark):
    """The same verdicts without the latent space: every item against every place of every text."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null").select("doc_id", "text")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    rng = random.Random(4)
    held = [r["text"].split() for r in bench.collect()]
    rows = [tuple(r) for r in docs.collect()]
    for k in range(120):
        item = [w if rng.random() > rng.choice([0, 0.2, 0.3]) else "zzz" for w in held[k % len(held)]]
        text = rng.choice(rows)[1].split()[:300]
        text[len(text) // 2 : len(text) // 2] = item
        rows.append((10_000 + k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(r["item_id"], decontamination.words_in(r["text"])) for r in bench.collect()]
    terms = decontamination.Terms(items)
    counts = Counter(x for _, t in rows for x in set(terms(decontamination.words_in(t)).tolist()))
    weights = np.array([0.0, *(math.log((1 + len(rows)) / (1 + counts[i])) for i in range(1, len(terms.number) + 1))])
    finder = decontamination.Finder([(i, terms(w)) for i, w in items], np.ones((len(weights), 2)), 0.4, decontamination.VERBATIM, decontamination.PARAPHRASE, weights)
    want = set()
    for doc_id, text in rows:
        ids = terms(decontamination.words_in(text))
        for k, (i, item) in enumerate(finder.items):
            if decontamination.common_subsequence(item, ids.tolist()) >= decontamination.PARAPHRASE * len(item) and finder.verdict(item, finder.rare[k], ids) is not None:
                want.add((doc_id, i))
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, bench).collect()}
    assert len(want) > 100 and len(got & want) >= 0.98 * len(want) and len(got - want) <= 0.02 * len(want)


def test_sums_over_runs_of_any_length():
    rng = np.random.default_rng(3)
    values = rng.integers(-9, 9, (50, 7)).astype(np.float32)
    for lengths in ([1], [5, 1, 64, 65, 3], [9000, 1, 1, 129], rng.integers(1, 200, 300).tolist()):
        rows = rng.integers(0, 50, sum(lengths))
        starts = np.cumsum([0, *lengths[:-1]])
        want = [values[rows[a : a + n]].sum(axis=0).tolist() for a, n in zip(starts, lengths, strict=True)]
        assert decontamination.run_sums(values, rows, starts).tolist() == want
    assert decontamination.run_sums(values, np.zeros(0, np.int64), np.zeros(0, np.int64)).shape == (0, 7)


def test_documents_are_compared_together_as_alone():
    rng = np.random.default_rng(6)
    items = [(k, rng.integers(1, 300, int(n))) for k, n in enumerate(rng.integers(8, 50, 30))]
    weights = np.array([0.0, *rng.uniform(1, 5, 299)])
    finder = decontamination.Finder(items, rng.standard_normal((300, 24)) * weights[:, None], 0.4, decontamination.VERBATIM, decontamination.PARAPHRASE, weights)
    docs = [np.zeros(0, np.int64), np.zeros(40, np.int64)]
    for n in (1, 31, 32, 33, 64, 65, 96, 400, 3000):
        text = rng.integers(0, 300, n)
        docs += [text, np.concatenate([text, items[n % 30][1], text])]
    alone = [finder([d])[0] for d in docs]
    assert finder(docs) == alone and finder([]) == []
    assert all(any(i == n % 30 and share == 1.0 for i, share in found.items()) for n, found in zip((1, 31, 32, 33, 64, 65, 96, 400, 3000), alone[3::2], strict=True))
    assert alone[:2] == [{}, {}]
    assert [len(b) for b in decontamination.together(iter([(b"",)] * 10), lambda r: len(r[0]), 3)] == [4, 4, 2]


# ---- 9 n-grams


def test_filter_counts():
    h = ngrams.mix(np.arange(1, 5001, dtype=np.uint64))
    counts = np.concatenate([np.arange(1, 2501), np.full(2500, 1)])
    f = ngrams.LogFrequencyFilter.of(h, counts, 2.0, 36)
    got = f.counts(h)
    assert (got * 2 >= counts).all()  # one-sided but for the middle of a quantum
    assert np.mean(got <= 2 * counts) > 0.99
    assert np.mean(f.counts(ngrams.mix(np.arange(10**6, 10**6 + 5000, dtype=np.uint64))) > 0) < 0.05


@pytest.mark.parametrize("head", [1 << 17, 10])
def test_base_scores(spark, head):
    docs = corpus(spark).select("doc_id", (language.remainder(by=7) == 2).alias("held_out"), "text").withColumn("c", F.lit("clash"))
    train = docs.where("not held_out")
    tokens = lambda t: (t or "").encode().lower().split() + [b""]
    c = Counter(w for r in train.collect() for w in tokens(r["text"]))
    n, v = sum(c.values()), len(c)
    got = ngrams.scored(docs, train, head=head).collect()
    assert len(got) == docs.count()
    of = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        said = tokens(of[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(said), sum(c[w] > 0 for w in said), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in said))
        assert r["score"] <= 0
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def brute_scores(of, train, prior=ngrams.PRIOR):
    """Bigram probabilities from exact counts, each as the middle of its power of two."""
    tokens = lambda t: (t or "").encode().lower().split() + [b""]
    one, two = Counter(), Counter()
    for t in train:
        said = tokens(t)
        one.update(said)
        two.update(zip([None, *said[:-1]], said, strict=True))
    n, v = sum(one.values()), len(one)
    middle = lambda c: 0 if not c else (2 ** (c.bit_length() - 1) + 2 ** c.bit_length() - 1) / 2
    out = []
    for t in of:
        said, score = tokens(t), 0.0
        for before, w in zip([None, *said[:-1]], said, strict=True):
            context = len(train) if before is None else middle(one[before])
            p = (min(middle(two[before, w]), context) + prior * (middle(one[w]) + 1) / (n + v + 1)) / (context + prior)
            score += math.log10(min(p, 1.0))
        out.append(score)
    return out


def test_scores_against_brute_force_in_one_pass_and_in_many(spark, monkeypatch):
    docs = corpus(spark).select("doc_id", (language.remainder(by=7) == 2).alias("held_out"), "text")
    train = docs.where("not held_out")
    rows = docs.collect()
    want = brute_scores([r["text"] for r in rows], [r["text"] for r in train.collect()])
    key = lambda r: (str(r["doc_id"]), r["n_tokens"], round(r["score"], 6))
    exact = sorted(ngrams.scored(docs, train, entry_bits=64).collect(), key=key)
    of = {}
    for r, w in zip(rows, want, strict=True):
        of.setdefault((r["doc_id"], r["text"]), w)
    got = sorted(r["score"] for r in exact)
    assert got == pytest.approx(sorted(want), rel=1e-3)
    monkeypatch.setattr(ngrams, "SEGMENT_TOKENS", 1 << 9)
    for bits in (8, 64):
        one, many = (sorted((key(r), r["base_score"], r["n_known"]) for r in ngrams.scored(docs, train, entry_bits=bits, pass_bits=p).collect()) for p in (1 << 29, bits * 2500))
        assert one == many and len(one) == len(rows)
    assert ngrams.segments_for(2 * 10**13) == ngrams.MOST_SEGMENTS


def test_texts_are_read_as_often_for_a_filter_in_many_parts_as_for_one(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "SEGMENT_TOKENS", 1 << 9)
    monkeypatch.setattr(ngrams, "WINDOW", 1 << 10)
    docs = corpus(spark).select("doc_id", (language.remainder(by=7) == 2).alias("held_out"), "text")

    def run(p, together=False):
        read = spark.sparkContext.accumulator(0)

        def passed(batches):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        rows = docs.mapInArrow(passed, docs.schema)
        out = ngrams.scored(rows, *([] if together else [rows.where("not held_out")]), pass_bits=p).collect()
        return sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in out), read.value

    one, reads = run(1 << 29)
    assert len(one) == docs.count()
    for p in (20_000, 2_000):
        assert run(p) == (one, reads)
        again, less = run(p, together=True)
        assert again == one and less < reads


def test_distinct_ngrams_of_a_window():
    words = ngrams.Vocabulary([b"x", b"a"])
    said = [b"a b a b a".split() + [b""], [b""], b"a b".split() + [b""]]
    numbers, starts = np.array([words[w] for t in said for w in t]), ngrams.first_of(said)
    h, times, places = ngrams.distinct(numbers, words, starts, 3)
    assert (h[1:] > h[:-1]).all()
    of = [tuple([None, None, *t][i : i + 3]) for t in said for i in range(len(t))]
    for n, got in enumerate(places):
        want = [x[2 - n :] for x in of]
        counts = Counter(want)
        assert len(set(zip(got.tolist(), want, strict=True))) == len(counts) == len(set(got.tolist()))
        assert times[got].tolist() == [counts[x] for x in want]
    for x, kind in ((h, np.uint64), (times.astype(np.uint32), np.uint32), (h[:0], np.uint64)):
        assert ngrams.unflat(ngrams.unpacked(ngrams.packed(ngrams.flat(x))), kind).tolist() == x.tolist()


def test_the_filter_grows_and_its_error_does_not():
    for n in (2_000, 200_000):
        h = ngrams.mix(np.arange(1, n + 1, dtype=np.uint64))
        f = ngrams.LogFrequencyFilter.of(h, np.ones(n, np.int64), 2.0, ngrams.ENTRY_BITS)
        assert len(f.words) == -(-n * ngrams.ENTRY_BITS // 64)
        assert np.mean(f.levels(ngrams.mix(np.arange(10**7, 10**7 + 20_000, dtype=np.uint64))) > 0) < 0.05


def test_scores_without_training(spark):
    docs = corpus(spark).select("doc_id", F.lit(False).alias("held_out"), "text")
    assert {r["n_known"] for r in ngrams.scored(docs, docs.limit(0)).collect()} == {0}
    assert ngrams.scored(docs.limit(0), docs.limit(0)).count() == 0


# ---- 10 licences


def test_wrapped_texts_and_notices_are_found():
    scan = licenses.Scanner(licenses.known_sentences())
    mit = ". ".join(licenses.SENTENCES[k] for k in ("mit-grant", "mit-notice", "mit-warranty")) + "."
    for width in (80, 40, 30, 25, 18):
        assert [m[0] for m in scan("Intro.\n" + "\n".join(__import__("textwrap").wrap(mit, width)))[0]] == ["MIT"], width
    for text, licence in (("Released under MIT.", "MIT"), ("Distributed under GPL version 3.", "GPL-3.0-only"), ("Available under CC BY 4.0.", "CC-BY-4.0"), ("This is free and unencumbered software released into the public\ndomain.", "Unlicense")):
        assert [m[0] for m in scan(text)[0]] == [licence]


def test_scans_against_brute_force():
    """Every window of fragments against every sentence, and every rule over the sequence that this gives."""
    rng = random.Random(14)
    known = licenses.known_sentences()
    scan = licenses.Scanner(known)
    said = list(licenses.SENTENCES.values()) + rng.sample(list(known), 60)
    rules = sorted(licenses.RULES, key=lambda r: -len(r[1]))
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 12)):
            x = rng.choice([rng.choice(said), rng.choice(said), "some other words", "the license", " ".join(rng.choice(said).split()[:4])])
            parts.append(x.replace(" ", "\n", rng.randint(0, 3)) if rng.random() < 0.5 else x.upper())
        if rng.random() < 0.5:
            at = rng.randrange(len(rules))
            parts[1:1] = [licenses.SENTENCES.get(k, "licensed under the mit license") for k in rules[at][1]]
        text = ".\n".join(parts)
        fragments = [n for x in licenses._PART.split(text) if (n := licenses.normal(x))]
        found, i = [], 0
        while i < len(fragments):
            ends = [j for j in range(i, len(fragments)) if " ".join(fragments[i : j + 1]) in known]
            if ends:
                found.append((i, ends[-1], known[" ".join(fragments[i : ends[-1] + 1])]))
                i = ends[-1]
            i += 1
        assert scan.sentences(text) == found
        used, want = set(), []
        for licence, wanted, gap in rules:
            for at in range(len(found)):
                places = []
                for k in range(at, len(found)):
                    if places and found[k][0] - found[places[-1]][1] - 1 > gap or len(places) == len(wanted):
                        break
                    if k not in used and found[k][2] == wanted[len(places)]:
                        places.append(k)
                    elif not places:
                        break
                if len(places) == len(wanted):
                    used |= set(places)
                    want.append((licence, found[at][0], found[places[-1]][1], len(wanted)))
        assert scan(text) == (sorted(want, key=lambda m: (m[1], m[2], m[0])), len(found))


def test_licences(spark):
    mit = (
        "// Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal\n// in the Software without restriction, including without limitation the rights\n// to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n// copies of the Software, and to permit persons to whom the Software is\n// furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    )
    cases = [(mit, ["MIT"]), ("Fine. Licensed under the Apache License, Version 2.0. More", ["Apache-2.0"]), ("a\nReleased under the MIT License.\nThis work is licensed under the GNU General Public License, version 3.", ["MIT", "GPL-3.0-only"]), ("the license of poets", []), ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]), (None, []), ("", []), ("SPDX-License-Identifier: MIT", ["MIT"]), (". ".join(reversed([licenses.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary")])) + ".", [])]
    cases += [(". ".join(licenses.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")) + ".", ["BSD-3-Clause"]), (". ".join(licenses.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary")) + ".", ["BSD-2-Clause"])]
    df = spark.createDataFrame([(i, t, "clash") for i, (t, _) in enumerate(cases)], "doc_id long, text string, matches string")
    got = {r["doc_id"]: [m["licence"] for m in r["matches"]] for r in licenses.scanned(df).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}
    assert licenses.scanned(df.limit(0)).count() == 0


def test_every_known_sentence_is_found_alone():
    known = licenses.known_sentences()
    scan = licenses.Scanner(known)
    for said, name in known.items():
        for text in (said, said.capitalize() + ".", "Some words.\n" + said.replace(" ", "\n", 2)):
            assert [x[2] for x in scan.sentences(text)] == [name], text
            assert scan(text)[1] == 1, text
    for text, licence in (("Released under CC BY 4.0.", "CC-BY-4.0"), ("Published under CC0-1.0.", "CC0-1.0"), ("Available\nunder GPL version 3.", "GPL-3.0-only")):
        assert [m[0] for m in scan(text)[0]] == [licence]
