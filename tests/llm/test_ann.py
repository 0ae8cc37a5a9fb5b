import math

import numpy as np
import pytest

from tidemark.llm import ann

SCHEMA = "vec_id long, embedding array<double>, tag string, bucket int"


def exact(ids, X, q, k):
    s = X @ X[q]
    order = sorted((-s[j], ids[j]) for j in range(len(ids)) if ids[j] != ids[q])
    return [i for _, i in order[:k]]


@pytest.mark.parametrize("name", ["sf0.01", "sf0.1"])
def test_recall_against_brute_force(spark, name):
    df = spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet")
    rows = df.collect()
    ids = [r["vec_id"] for r in rows]
    X = np.array([r["embedding"] for r in rows], np.float64)
    found = {}
    for r in ann.search(df, 20, 20).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    asked = [i for i in range(len(ids)) if ids[i] % 20 == 0]
    assert set(found) == {ids[i] for i in asked}
    hits = 0
    for i in asked:
        got = sorted(found[ids[i]])
        assert [g[0] for g in got] == list(range(1, 21))
        assert [(-g[2], g[1]) for g in got] == sorted((-g[2], g[1]) for g in got)
        assert all(math.isclose(g[2], X[i] @ X[ids.index(g[1])], abs_tol=1e-12) for g in got)
        hits += len({g[1] for g in got} & set(exact(ids, X, i, 20)))
    assert hits / (20 * len(asked)) >= 0.9


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0, 3.0]), (1, None), (2, [1.0, None, 1.0]), (3, [nan, 1.0, 0.0]),
        (4, [inf, 0.0, 0.0]), (5, [0.0, 0.0, 0.0]), (6, [1.0]), (7, [1.0, 2.0, 3.0]),
        (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0, 1.0]), (20, [1e200, 1e200, 0.0]), (40, []),
        (9, [1e-200, 0.0, 0.0]),
    ]
    df = spark.createDataFrame([(i, v, "t", 3) for i, v in rows], SCHEMA)
    got = sorted(tuple(r) for r in ann.search(df, 20, 3, probes=8).collect())
    assert [g[:3] for g in got if g[0] == 0] == [(0, 1, 20), (0, 2, 7), (0, 3, 7)]
    assert [g[:3] for g in got if g[0] == 20] == [(20, 1, 0), (20, 2, 7), (20, 3, 7)]
    assert {g[0] for g in got} == {0, 20}
    none = spark.createDataFrame([], SCHEMA)
    assert ann.search(none, 20, 3).count() == 0


def test_equal_vectors_rank_by_id(spark):
    v = [0.1, -0.7, 0.3, 0.64]
    df = spark.createDataFrame([(i, v, "t", 3) for i in range(4000)], SCHEMA)
    got = [r for r in ann.search(df, 1000, 4).collect() if r["query_id"] == 1000]
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == [0, 1, 2, 3]


def test_hadamard_is_orthonormal():
    h = ann.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16))
