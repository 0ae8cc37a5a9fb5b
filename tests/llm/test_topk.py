import math
import random

import pytest

from tidemark.llm import grid, topk

SCHEMA = "vec_id long, embedding array<double>, rank int, id string"


def brute(rows, divisor, k):
    fine = [
        (i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
        if i is not None and v is not None
        and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v)
    ]
    asked = {}
    for i, v in fine:
        if i % divisor == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for i, q in asked.items():
        scored = [
            (-max(-topk.EDGE, min(topk.EDGE, sum(a * b for a, b in zip(q, v)))), j)
            for j, v in fine if j != i and len(v) == len(q)
        ]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def check(spark, rows, divisor=5, k=5):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    got = sorted(tuple(r) for r in topk.search(df, divisor, k).collect())
    assert got == brute(rows, divisor, k)


def test_random_vectors_and_many_ties(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 500)]
    check(spark, rows)
    monkeypatch.setattr(grid, "QUERIES_PER_BLOCK", 16)
    monkeypatch.setattr(grid, "VECTORS_PER_BLOCK", 32)
    check(spark, rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    check(spark, [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]),
        (5, [0.0, 0.0]), (6, [1.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (None, [1.0, 1.0]),
        (10, [3.0, 1.0]), (10, [2.0, 9.0]), (-5, [-1.5, -0.001]), (15, [1.0]), (20, []),
    ])
    check(spark, [])
    check(spark, [(5, [1.0])])


def test_huge_components_stay_exact(spark):
    rng = random.Random(2)
    check(spark, [(i, [rng.uniform(-1, 1) * 1e15 for _ in range(4)]) for i in range(40)])
    check(spark, [(i, [rng.uniform(-1, 1) * 1e7 for _ in range(4)]) for i in range(40)])
    check(spark, [(i, [rng.uniform(-1, 1) * 6e6 for _ in range(4)]) for i in range(40)])
    check(spark, [(i, [rng.uniform(-1, 1) * 1e160]) for i in range(10)])


def test_tiny_negatives_floor_to_minus_one_and_the_whole_long_range_counts(spark):
    check(spark, [(0, [1.0, -1e-20]), (1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, [0.5, -1e-20])])
    big = [(0, [3.2e7, 1.0]), (1, [3.11e6, 1.0]), (2, [3.11e6, 2.0]), (3, [-3.11e6, 0.0])]
    assert 2 ** 62 < brute(big, 5, 1)[0][3] < 2 ** 63
    check(spark, big)


@pytest.mark.parametrize("name", ["sf0.001"])
def test_table(spark, name):
    df = spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = sorted(tuple(r) for r in topk.search(df, 50, 5).collect())
    assert got == brute(rows, 50, 5)
