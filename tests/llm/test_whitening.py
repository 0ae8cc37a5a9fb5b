import math
import random

import numpy as np
import pytest

from tidemark.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, n int, component string"


def usable(rows):
    out = []
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) and abs(64 * c) < 2 ** 53 for c in v):
            out.append((i, tuple(math.floor(64 * c) for c in v)))
    sizes = [len(v) for _, v in out]
    common = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    return [(i, v) for i, v in out if len(v) == common]


def check(spark, rows, components=16):
    """Against a dense eigendecomposition; the sign of a component is free, but one for all rows."""
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    got = whitening.report(df, components).collect()
    fine = usable(rows)
    fit = sorted({v for _, v in fine})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    centred = np.array([[float(n * a - s) / n for a, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n) if n else (np.zeros(0), None)
    values = values[::-1][:components]
    real = int((values > 1e-12 * max(values, default=0)).sum()) if n > 1 else 0
    assert len(got) == real * len(fine)
    if not real:
        return
    trace = (centred ** 2).sum() / n
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    for c in range(real):
        axis = vectors[:, ::-1][:, c]
        want, have = [], []
        for i, v in fine:
            off = [n * a - s for a, s in zip(v, sums)]
            same = [r for r in by[i, c + 1] if r["deviation"] == sum(o * o for o in off)]
            assert same and same[0]["n"] == n
            assert abs(same[0]["explained"] - values[c] / trace) <= 1e-9
            assert same[0]["identity_error"] <= 1e-7
            want.append(float(np.array(off, float) / n @ axis / math.sqrt(values[c])))
            have.append(same[0]["whitened"])
        want, have = np.array(want), np.array(have)
        sign = 1 if want @ have >= 0 else -1
        assert np.abs(want - sign * have).max() <= 1e-6 * max(1, np.abs(want).max())


def vectors_of(count, dim, seed=1, scale=1.0):
    rng = random.Random(seed)
    return [[rng.gauss(0, scale * (1 + j)) for j in range(dim)] for _ in range(count)]


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check(spark, [(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_more_and_fewer_dimensions_than_components(spark):
    check(spark, list(enumerate(vectors_of(400, 40))))
    check(spark, list(enumerate(vectors_of(60, 5))), 3)
    check(spark, list(enumerate(vectors_of(50, 1))))
    check(spark, list(enumerate(vectors_of(6, 9, scale=3.0))))  # fewer vectors than dimensions


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = list(enumerate(vectors_of(30, 4)))
    rows += [(30, None), (31, []), (32, [1.0, None, 1.0, 1.0]), (33, [nan, 1.0, 1.0, 1.0]),
             (34, [inf, 0.0, 0.0, 0.0]), (35, [1e300, 0.0, 0.0, 0.0]), (36, [1.0, 2.0])]
    rows += [(None, rows[3][1])] + [rows[5]] * 40 + [(100 + i, rows[7][1]) for i in range(40)]
    check(spark, rows)
    check(spark, [])
    check(spark, [(1, [0.5, 0.25])] * 3)
    check(spark, [(1, None)])


def test_far_from_zero_nothing_cancels(spark):
    far = [(i, [1e9 + c for c in v]) for i, v in enumerate(vectors_of(200, 6))]
    check(spark, far)


def test_a_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [1e13 * (i % 2) + i, float(i)], 1, "x") for i in range(10)]
    out = whitening.report(spark.createDataFrame(rows, SCHEMA))
    assert {r["deviation"] for r in out.collect()} == {None}


@pytest.mark.parametrize("dim, count", [(64, 16), (200, 16), (10, 16), (64, 3)])
def test_solver_reaches_double_precision(dim, count):
    rng = np.random.default_rng(dim)
    turned = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    levels = np.sort(rng.uniform(1, 2, dim))[::-1]
    levels[5:8] = levels[5]  # equal eigenvalues
    dense = turned * levels @ turned.T
    values, vectors = whitening.jacobi_davidson(lambda w: dense @ w, dim, count, levels.sum())
    assert np.abs(values - levels[:count]).max() < 1e-12
    assert np.linalg.norm(dense @ vectors - vectors * values, axis=0).max() < 1e-12
