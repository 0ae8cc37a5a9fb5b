import random
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.graph import components


def plain(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(fps):
    """Smallest id reachable per (id, fp) row."""
    ids = [i for i, _ in fps]
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    values = np.array([f for _, f in fps], np.uint64)
    for i in range(len(fps)):
        near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2)
        for j in near:
            parent[find(int(j))] = find(i)
    low = {}
    for i, x in enumerate(ids):
        if x is not None:
            r = find(i)
            low[r] = min(low.get(r, x), x)
    return [low.get(find(i)) for i in range(len(fps))]


def check(spark, docs):
    rows = simhash.report(docs).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    fps = [(i, plain(t)) for i, t in texts]
    want = sorted(
        [(str(i), f"{f:016x}", c) for (i, f), c in zip(fps, brute(fps))], key=str
    )
    got = sorted([(str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in rows], key=str)
    assert got == want


def test_table_equals_brute_force(spark):
    check(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_edges(spark, documents):
    check(spark, documents([
        (5, None), (3, ""), (4, " \t\n"), (7, "One"), (8, "one two"), (8, "one two"),
        (9, "É É é x y"), (10, "a b c d"), (None, "one"), (11, "w " * 50000), (12, None),
    ]))
    assert simhash.report(documents([])).count() == 0


@pytest.mark.parametrize("crowd", [simhash.CROWDED, 3])
def test_links_of_crowded_halves(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWDED", crowd)
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = set(base)
    for b in base[:5]:
        for _ in range(200):  # many within a few bits, most of them sharing one half
            x = b
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randint(0, 39)
            fps.add(x)
    rows = list(enumerate(sorted(fps, key=lambda x: x * 7919 % 10007)))
    signed = [(i, f - (1 << 64) * (f >> 63)) for i, f in rows]
    prints = spark.createDataFrame(signed, "doc_id long, fingerprint long")
    got = {r["fp"]: r["component"] for r in simhash.classes(prints, "doc_id").collect()}
    assert [got[f] for _, f in signed] == brute(rows)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, j) for j in range(2, 50)] + [(7, 7)]
    edges += [(60, None)]
    rows = components(spark.createDataFrame(edges, "x long, y long")).collect()
    roots = {r["node"]: r["root"] for r in rows}
    assert len(rows) == len(roots) == 61 + 49
    assert {roots[i] for i in range(100, 161)} == {100} and {roots[i] for i in range(1, 50)} == {1}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0
