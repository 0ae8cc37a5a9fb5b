import hashlib
import random
import re
import time

import pytest

from tidemark.llm import ledger
from tidemark.sources.shared import fresh_path

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


def check(spark, docs):
    got = ledger.report(docs, fresh_path(spark, "ledger")).collect()
    want = []
    for r in docs.select("doc_id", "text").collect():
        spans = base(r["text"] or "")
        counts = [sum(s[1] == k for s in spans) for k in range(3)]
        want.append((r["doc_id"], *counts, hashlib.sha256(joined(spans).encode()).hexdigest()))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    names = {"assign", "access", "hex"}
    for r in got:
        own = [s.split(":") for s in r["spans"].split(",") if s]
        assert [int(a) for _, a, _ in own] == sorted(int(a) for _, a, _ in own)
        kept = ",".join(":".join(s) for s in own if s[0] in names)
        assert hashlib.sha256(kept.encode()).hexdigest() == r["base_sha256"]
    return got


def test_table(spark):
    got = check(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert any(r["n_assign"] for r in got)


def test_edges(spark, documents):
    texts = [
        None, "", "token=abcdef", "token=abcde", "TOKEN : 'abcdefg' secret=token:longvalue1",
        "api_key=\"abc.def\" apikey=abc_def API_KEY == 123456", "\u017fecret=abcdefg to\u212aen=abcdefg",
        "é😀 passwd:aaaaaa" * 3, "AKIA" + "A" * 15, "AKIA" + "A" * 16, "AKIAAKIA" + "0" * 20 + "akia",
        "0123456789abcdef01234567", "g0123456789abcdef0123456", "F0123456789abcdef01234567x",
        "token" + " " * 5000 + "=" + " " * 5000 + "abcdefgh", "password=" + "f" * 30,
        "-----BEGIN RSA PRIVATE KEY----- https://user:pw@host/ eyJhbGciOiJI.eyJzdWIiOiIx.abcdefgh12",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, texts[2]), (None, texts[3]), (None, texts[2])]
    got = check(spark, documents(rows))
    last = next(r for r in got if r["doc_id"] == 16)
    assert [s.split(":")[0] for s in last["spans"].split(",")] == ["pem", "login", "jwt"]
    assert check(spark, documents([])) == []


def test_random_texts(spark, documents):
    rng = random.Random(4)
    parts = ["token", "secret", "api_", "key", "API", "=", ":", " ", "'", '"', "AKIA", "ABCDEFGH", "0a1b2c3d",
             "deadbeef", "x", ".", "passwd", "é", "\n"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(60)))) for i in range(2000)]
    check(spark, documents(rows))


def test_long_texts_take_linear_time():
    for piece in ("token ", "eyJ", "a.", "0123456789abcdef0123456 ", "-----BEGIN A", "a://b:", "AKIA ", "token="):
        started = time.perf_counter()
        ledger.scan(piece * (2_000_000 // len(piece)), ledger.RULES)
        assert time.perf_counter() - started < 20, piece


def spans_of(book):
    return sorted((r["path"], r["v"], [(f["rule"], f["start"]) for f in r["found"] or []])
                  for r in book.findings().collect())


@pytest.mark.parametrize("few", [ledger.FEW, 0])
def test_only_unseen_pairs_are_scanned_and_all_paths_get_findings(spark, monkeypatch, few):
    monkeypatch.setattr(ledger, "FEW", few)
    folder = fresh_path(spark, "ledger")

    def wave(rows, rules):
        book = ledger.Ledger(spark, folder, rules)
        entry = book.record(spark.createDataFrame(rows, "path string, v int, text string"), ["path", "v"])
        scans = spark.read.parquet(f"{entry['folder']}/scans").collect()
        assert len({bytes(s["digest"]) for s in scans}) == len(scans)
        return book, sorted(sorted(s["rules"]) for s in scans)

    a, b, c = "token=abcdef", "AKIA" + "Z" * 16, "nothing"
    two = ledger.BASE[:2]
    _, scanned = wave([("x", 1, a), ("y", 1, a), ("z", 1, c)], two)
    assert scanned == [["access@1", "assign@1"]] * 2
    book, scanned = wave([("x", 2, b), ("y", 2, a), ("z", 2, c)], two)
    assert scanned == [["access@1", "assign@1"]]  # b alone is new
    assert spans_of(book) == [
        ("x", 1, [("assign", 0)]), ("x", 2, [("access", 0)]), ("y", 1, [("assign", 0)]),
        ("y", 2, [("assign", 0)]), ("z", 1, []), ("z", 2, []),
    ]
    # A new version of one rule: every blob once more, with that rule alone.
    newer = (ledger.Rule("assign", 2, r"(token)=([a-z]+)", 7, 2), two[1])
    book, scanned = wave([("x", 3, a), ("x", 4, b), ("w", 1, "token=abcdefgh")], newer)
    assert scanned == [["access@1", "assign@2"], ["assign@2"], ["assign@2"]]
    assert ("x", 3, []) in spans_of(book) and ("w", 1, [("assign", 0)]) in spans_of(book)
    assert ("x", 3, [("assign", 0)]) in spans_of(ledger.Ledger(spark, folder, two))
    _, scanned = wave([("x", 5, a)], newer)
    assert scanned == []


def test_a_wave_without_its_entry_does_not_exist(spark, monkeypatch):
    folder = fresh_path(spark, "ledger")
    book = ledger.Ledger(spark, folder)
    rows = spark.createDataFrame([("x", "token=abcdef")], "path string, text string")

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(ledger.commits, "append", dies)
        with pytest.raises(OSError):
            book.record(rows, ["path"])
    assert book.findings() is None
    book.record(rows, ["path"])
    assert [len(r["found"]) for r in book.findings().collect()] == [1]
