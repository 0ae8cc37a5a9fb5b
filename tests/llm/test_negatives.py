import math
import random

import numpy as np
import pytest

from tidemark.llm import grid, negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, anchor string"


def whole(v):
    return bool(v) and all(c is not None and math.isfinite(256 * c) for c in v)


def brute(rows, divisor, k=5, most=3):
    fine = []
    for i, v, label in rows:
        if i is not None and label is not None and whole(v):
            label = math.fmod(label + 1, 10) if i % 7 == 0 else label
            fine.append((i, tuple(math.floor(256 * c) for c in v), int(label)))
    anchors = {}
    for i, v, label in fine:
        if i % divisor == 0:
            anchors[i] = min(anchors.get(i, (v, label)), (v, label))
    out = []
    for i, (q, label) in anchors.items():
        scored = sorted(
            (-max(-negatives.EDGE, min(negatives.EDGE, sum(a * b for a, b in zip(q, v)))), j, other)
            for j, v, other in fine if j != i and len(v) == len(q)
        )
        for ps, j, _ in [s for s in scored if s[2] == label][:k]:
            good = [
                s for s in scored if s[2] != label and -50 * ps <= -100 * s[0] <= -95 * ps
            ][:most]
            out += [(i, j, r, m, -ps, -s) for r, (s, m, _) in enumerate(good, 1)]
    return sorted(out)


def check(spark, rows, divisor=5):
    df = spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows], SCHEMA)
    got = negatives.mine(df, divisor, label=negatives.relabelled())
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, divisor)


def some(count, dim, seed, scale=1.0, labels=3):
    rng = random.Random(seed)
    return [
        (i, [rng.gauss(0.3, 1) * scale for _ in range(dim)], rng.randrange(labels))
        for i in range(count)
    ]


def test_random_vectors_and_many_ties(spark, monkeypatch):
    rows = some(300, 8, 1) + [(i, [0.5] * 8, 1 + (i % 3 == 0)) for i in range(300, 420)]
    check(spark, rows)
    monkeypatch.setattr(grid, "QUERIES_PER_BLOCK", 16)
    monkeypatch.setattr(grid, "VECTORS_PER_BLOCK", 32)
    monkeypatch.setattr(negatives, "TILE", 7)
    check(spark, rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = some(40, 2, 4) + [
        (50, None, 1), (51, [1.0, None], 1), (52, [nan, 1.0], 1), (53, [inf, 0.0], 1),
        (54, [1e307, 0.0], 1), (55, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (60, [1.0], 1),
        (65, [1.0], 1), (66, [0.9], 2), (70, [0.0, 0.0], 1), (75, [], 1), (76, [], 1), (77, [], 2),
        (5, [0.3, 0.3], 2), (5, [0.3, 0.3], 2), (3, [1.0, 1.0], 0), (3, [1.0, 1.0], 0),
        (80, [1.0, -1e-20], 1), (-35, [1.0, 2.0], -4),
    ]
    check(spark, rows)
    check(spark, [])
    check(spark, [(5, [1.0], 1)])


@pytest.mark.parametrize("scale", [1e-3, 1e4, 1e7, 1e12, 1e150])
def test_scores_of_any_size_are_exact(spark, scale):
    check(spark, some(60, 5, 2, scale))


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    got = sorted(tuple(r) for r in negatives.report(df).collect())
    assert got == brute(rows, 50) and got


@pytest.mark.parametrize("dim, size", [(3, 10), (1100, 60_000), (2500, 10 ** 9)])
def test_residue_products(dim, size):
    rng = np.random.default_rng(dim)
    a, b = (rng.integers(-size, size, (9, dim)).astype(float) for _ in range(2))
    exact = a.astype(int).astype(object) @ b.astype(int).astype(object).T
    bound = size * size * dim
    products = negatives.Products(negatives.primes_for(bound), bound < negatives.EDGE)
    got = products.scores(products.split(a), products.split(b))
    assert (got == np.clip(exact, -negatives.EDGE, negatives.EDGE)).all()
