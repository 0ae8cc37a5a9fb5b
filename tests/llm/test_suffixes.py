import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import suffixes


def brute(rows, length=suffixes.LENGTH):
    raws = [(i, (t or "").encode()) for i, t in rows]
    count = {}
    for _, b in raws:
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            count[w] = count.get(w, 0) + 1
    out = []
    for i, b in raws:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if count[b[p:p + length]] > 1:
                gone[p:p + length] = True
        edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8)]) == 1)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), len(edges), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(docs):
    return sorted([tuple(r) for r in suffixes.report(docs).collect()], key=str)


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    want = brute(rows)
    assert got(docs) == want
    assert sum(r[2] for r in want) > 0


@pytest.mark.parametrize("size", [suffixes.BLOCK_BYTES, 3000])
def test_shared_stretches_of_all_lengths(spark, documents, monkeypatch, size):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", size)
    rng = random.Random(5)

    def noise(n):
        return "".join(rng.choice("abcdeé ") for _ in range(n))

    shared = [noise(n) for n in (150, 190, 199, 200, 201, 260, 400, 700)]
    rows = []
    for i in range(60):
        parts = [noise(rng.randint(0, 90))]
        for s in rng.sample(shared, rng.randint(0, 3)):
            a = rng.randint(0, 30)
            parts += [s[a:len(s) - rng.randint(0, 30)], noise(rng.randint(1, 90))]
        rows.append((i, "".join(parts)))
    want = brute(rows)
    assert got(documents(rows).repartition(5)) == want
    assert any(r[3] > 1 for r in want)


def test_edges(spark, documents):
    same = "word number " * 30
    rows = [
        (1, None), (2, ""), (3, "x" * 199), (4, "y" * 200), (5, "z" * 201), (6, "漢" * 70),
        (7, same), (7, same), (None, same + "!"), (8, "short"), (9, "short"), (10, "ab" * 3000),
        (11, "é" * 99 + "a"), (12, "q" + "é" * 99 + "a"), (13, "漢" * 66 + "x"), (14, "漢" * 66 + "y"),
    ]
    assert got(documents(rows)) == brute(rows)
    assert suffixes.report(documents([])).count() == 0


def test_spans_and_kept_bytes(documents):
    text = "unique start " + "s" * 250 + " unique end"
    rows = {r["id"]: r for r in suffixes.remove_repeats(documents([(1, text), (2, "other")])).collect()}
    assert rows[1]["spans"] == [13, 263] and bytes(rows[1]["kept"]) == b"unique start  unique end"
    assert rows[2]["spans"] == [] and bytes(rows[2]["kept"]) == b"other"


def test_cover_meets_every_pair_of_places():
    cover = suffixes.difference_cover()
    assert cover.sum() == 9
    for i in range(73):
        for j in range(73):
            assert any(cover[(i + d) % 73] and cover[(j + d) % 73] for d in range(73))
