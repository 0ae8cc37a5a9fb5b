import hashlib
import random
import re
import time

import pytest

from tidemark.llm import pii

BASE = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(d):
    return sum(
        (int(c) * 2 - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(reversed(d))
    ) % 10 == 0


def fits(kind, m):
    d = re.sub("[^0-9]", "", m)
    return [
        True, kind == 1 and all(int(p) <= 255 for p in m.split(".")),
        16 <= len(d) <= 19 and luhn(d), 8 <= len(d) <= 15,
    ][kind]


def brute(text):
    return [
        (name, m.start(), m.end()) for k, name in enumerate(pii.KINDS)
        for m in re.finditer(BASE[k], text or "") if fits(k, m[0])
    ]


def check(rows, out):
    got = sorted(
        [(r["doc_id"], r["base_sha256"], *(r[f"n_{k}"] for k in pii.KINDS)) for r in out], key=str
    )
    want = []
    for i, t in rows:
        spans = brute(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        n = [sum(s[0] == k for s in spans) for k in pii.KINDS]
        want.append((i, hashlib.sha256(text.encode()).hexdigest(), *n))
    assert got == sorted(want, key=str)


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = pii.report(docs).collect()
    check(rows, out)
    assert sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in out) > 50


def test_random_strings_equal_brute_force(spark, documents):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        alphabet = rng.choice(["ab1@.-_ ", "0123456789. -", "+12 ().-9", "é漢1.2@x😀 +", "41 -"])
        rows.append((i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120)))))
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111x", "5500005555555559", "30569309025904"]
    rows += [(500 + i, f"😀 {c} end 1.2.3.4.5.6.7.8 a@b.com_x@y.z") for i, c in enumerate(cards)]
    check(rows, pii.report(documents(rows)).collect())


def test_edges(spark, documents):
    rows = [
        (1, None), (2, ""), (None, "a@b.c"), (3, "x" * 3000), (4, "1" * 3000), (5, "1 " * 2000),
        (6, "1.2.3.4 " * 1000), (7, "a@b.c"), (7, "a@b.c"), (8, "000000300.1.1.1 0000001.2.3.255"),
        (9, "a." * 1000 + "@b.c"),
    ]
    check(rows, pii.report(documents(rows)).collect())
    assert pii.report(documents([])).count() == 0


def test_identifiers_and_words_of_any_length_are_found(spark, documents):
    rows = [(i, f"contact: user{i}@example{i}.com and more") for i in range(150)]
    long_local, cue = "z" * 70 + "@localhost", "c" * 90 + ":"
    rows += [(200, f"contact: {long_local} now"), (201, "contact: bob@" + "h" * 100 + " now")]
    rows += [(500, f"{cue} " + "1-" * 40 + "1 now")]
    rows += [(600 + i, f"{cue} +1 (017) 555-{i:04d} x") for i in range(150)]
    spans = {r["doc_id"]: r["spans"] for r in pii.report(documents(rows)).collect()}
    assert spans[200] == f"email:9:{9 + len(long_local)}" and spans[201] == "email:9:113"
    assert spans[500] == f"phone:{len(cue) + 1}:{len(cue) + 82}"


def test_equal_scores_take_the_first_kind(spark):
    # Every pattern holds as many emails as phones: no kind is confident; then two patterns tie.
    rows = [("p", f"a{i}@b.co") for i in range(10)] + [("q", f"+1 555 000 {i:04d}") for i in range(10)]
    rows += [("r", f"c{i}@b.co") for i in range(10)] + [("s", f"+1 555 001 {i:04d}") for i in range(10)]
    rows += [(p, "x@y") for p in "pqrs"]
    occurrences = spark.createDataFrame(rows, "pattern string, word string")
    for _ in range(3):
        found = pii.discover(occurrences.repartition(5), confident=0.8, accepted=0.5).collect()
        assert [(r["word"], r["kind"]) for r in found] == [("x@y", 0)]


def test_many_matches_in_one_text_take_little_time(spark, documents):
    text = " ".join(f"user{i}@example.com é" for i in range(30_000))
    started = time.perf_counter()
    row = pii.report(documents([(1, text)])).first()
    masked = pii.redact(documents([(1, text)])).first()["text"]
    assert row["n_email"] == 30_000 and masked == " ".join(["[EMAIL] é"] * 30_000)
    assert time.perf_counter() - started < 60


def test_very_long_texts_do_not_backtrack(documents):
    n = 200_000
    rows = [(1, "x" * n), (2, "1" * n), (3, "1 " * n), (4, "a." * n + "@b.c"), (5, "+1 " * n)]
    out = {r["doc_id"]: r for r in pii.report(documents(rows)).collect()}
    assert [out[i]["spans"] for i in range(1, 6)] == ["", "", "", f"email:0:{2 * n + 4}", ""]


def test_contexts_reveal_unseen_identifiers(documents):
    rows = [(i, f"some words ssn: user{i}@mail.com and uid= 10.0.{i}.7 too 123456") for i in range(20)]
    rows += [(i + 100, f"here email: a{i}@b.org or mail: c{i}@d.org") for i in range(20)]
    rows += [(200, "email: bob98765(at)host here"), (201, "so mail: bob98765(at)host again"),
             (202, "the code 98765432 is unknown"), (203, "ssn: once-12345 only")]
    out = {r["doc_id"]: r for r in pii.report(documents(rows)).collect()}
    assert out[200]["spans"] == "email:7:23" and out[200]["n_email"] == 0
    assert out[201]["spans"] == "email:9:25"
    assert out[202]["spans"] == "" and out[203]["spans"] == ""
    assert out[5]["spans"] == "email:16:30,ip:40:48"
    check(rows, out.values())


def test_redaction(spark, documents):
    docs = documents([
        (1, "é a@b.com, +49 (30) 123-4567 x 10.1.1.1"), (2, None), (3, "clean 12"), (4, ""),
        (5, "+4111111111111111"),
    ]).selectExpr("*", "1 as _spans", "2 as _id")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts == {
        1: "é [EMAIL], [PHONE] x [IP]", 2: None, 3: "clean 12", 4: "", 5: "+[CARD]",
    }


def test_no_python_in_the_plan(documents):
    plan = pii.report(documents([(1, "a@b.c")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_spaced_identifiers_are_seeds_and_one_strong_pattern_is_enough(documents):
    rows = [(i, f"call tel: +1 (017) 555-{7000 + i} now, card nr: 4111 1111 1111 1111") for i in range(120)]
    rows += [(200, "call tel: 55577123 now"), (201, "see nr: 98765432 here")]
    out = {r["doc_id"]: r["spans"] for r in pii.report(documents(rows)).collect()}
    assert out[200] == "phone:10:18"
    assert out[201] == ""  # one card, however often it is written


def test_chains_are_followed_to_their_end(spark):
    words = [f"a{i}@b.org" for i in range(9)] + [f"word{i}" for i in range(16)]
    # Each pair of cues holds nine words of the pairs before and one of its own.
    edges = [(c + str(s), w) for s in range(16) for c in "pq" for w in words[s:s + 10]]
    found = pii.discover(spark.createDataFrame(edges, "pattern string, word string"))
    assert {r["word"] for r in found.collect()} == set(words[9:])
