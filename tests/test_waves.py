"""Peaks on hand-worked signals and against a direct definition; wave labels against a loop."""

import datetime as dt
import time

import numpy as np
import pytest

from tidemark.functions.peaks import find_peaks, local_maxima
from tidemark.operators.waves import detect_peaks, label_waves

START = dt.date(2021, 1, 1)


@pytest.mark.parametrize("signal,distance,least,expected", [
    ([], 1, 0, []), ([1, 2], 1, 0, []),
    ([0, 0, 0, 0], 1, 0, []), ([1, 2, 3, 4], 1, 0, []), ([4, 3, 2], 1, 0, []),
    ([0, 2, 0], 1, 0, [1]),
    ([0, 2, 2, 2, 0], 1, 0, [2]), ([0, 2, 2, 0], 1, 0, [1]),
    ([0, 1, 2, 2], 1, 0, []),
    ([0, 5, 0, 4, 0], 3, 0, [1]), ([0, 5, 0, 4, 0], 2, 0, [1, 3]),
    ([0, 5, 0, 5, 0], 3, 0, [3]),
    ([0, 5, 4, 5.5, 0], 1, 1.5, [3]), ([0, 5, 4, 5.5, 0], 1, 1, [1, 3]),
    ([3, 5, 3, 9, 0], 1, 2, [1, 3]),
])
def test_hand_worked_signals(signal, distance, least, expected):
    assert find_peaks(np.array(signal, dtype=float), distance, least).tolist() == expected


def slow_peaks(x, distance, least):
    n, tops, i = len(x), [], 1
    while i < n - 1:
        j = i
        while j + 1 < n and x[j + 1] == x[i]:
            j += 1
        if j < n - 1 and x[i - 1] < x[i] > x[j + 1]:
            tops.append((i + j) // 2)
        i = j + 1
    kept = []
    for p in sorted(tops, key=lambda p: (-x[p], -p)):
        if all(abs(p - k) >= distance for k in kept):
            kept.append(p)
    out = []
    for p in sorted(kept):
        lows = []
        for step in (-1, 1):
            k, low = p, x[p]
            while 0 <= k < n and x[k] <= x[p]:
                low = min(low, x[k])
                k += step
            lows.append(low)
        if x[p] - max(lows) >= least:
            out.append(p)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_random_signals_against_the_definition(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 2 + seed % 9, size=5 + 7 * seed).astype(float)
    for distance, least in ((1, 0), (3, 1), (10, 2)):
        assert find_peaks(x, distance, least).tolist() == slow_peaks(x, distance, least)
    assert local_maxima(x).tolist() == slow_peaks(x, 1, 0)


def earlier_rule(x, distance, least):
    """The quadratic form of the same rules."""
    peaks = local_maxima(x)
    keep = np.ones(len(peaks), dtype=bool)
    for j in np.argsort(x[peaks], kind="stable")[::-1]:
        if keep[j]:
            near = np.abs(peaks - peaks[j]) < distance
            near[j] = False
            keep &= ~near
    out = []
    for p in peaks[keep]:
        higher = np.flatnonzero(x > x[p])
        cut = np.searchsorted(higher, p)
        start = higher[cut - 1] + 1 if cut else 0
        stop = higher[cut] if cut < len(higher) else len(x)
        if x[p] - max(x[start:p + 1].min(), x[p:stop].min()) >= least:
            out.append(p)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_long_signals_with_plateaus_against_the_quadratic_form(seed):
    rng = np.random.default_rng(100 + seed)
    x = np.repeat(rng.integers(0, 40, 1500), rng.integers(1, 4, 1500)).astype(float)
    x = np.round(x + np.cumsum(rng.normal(size=len(x))) * (seed % 3), seed % 2)
    for distance, least in ((1, 0), (7, 3), (60, 10), (10**6, 0)):
        assert find_peaks(x, distance, least).tolist() == earlier_rule(x, distance, least)


@pytest.mark.parametrize("make", [
    lambda rng, n: rng.normal(size=n), lambda rng, n: np.cumsum(rng.normal(size=n)),
    lambda rng, n: np.arange(n) + 2.0 * (np.arange(n) % 2),  # every peak higher than the last
    lambda rng, n: np.zeros(n),
])
def test_a_million_points_take_seconds(make):
    x = make(np.random.default_rng(0), 1_000_000)
    started = time.perf_counter()
    for distance in (1, 30, 400_000):
        find_peaks(x, distance, 0.8)
    assert time.perf_counter() - started < 30


def test_detection_and_labels_for_every_entity(spark, panel_of):
    rng = np.random.default_rng(1)
    signals = {
        "none": [0, 1, 2, 3], "one": [0, 3, 0, 1],
        "many": rng.integers(0, 9, size=120).tolist(), "gap": [None, 4, None, 5, None],
    }
    panel = panel_of([
        {"iso_code": e, "date": START + dt.timedelta(days=i), "new_cases_smoothed": v}
        for e, s in signals.items() for i, v in enumerate(s)
    ], "new_cases_smoothed")
    peaks = detect_peaks(panel, distance=2, least=2)
    found = {(r.iso_code, (r.date - START).days) for r in peaks.collect()}
    labels = {
        (r.iso_code, (r.date - START).days): r.wave_number for r in label_waves(panel, peaks).collect()
    }
    for e, s in signals.items():
        x = [v or 0.0 for v in s]
        cuts = slow_peaks(x, 2, 2)
        assert sorted(i for n, i in found if n == e) == cuts
        waves = [1] * len(x)
        edges = [0, *cuts, len(x)]
        if cuts:
            for w in range(len(edges) - 1):
                waves[edges[w]:edges[w + 1]] = [w + 1] * (edges[w + 1] - edges[w])
            waves[cuts[-1]:] = [len(cuts)] * (len(x) - cuts[-1])
        assert [labels[e, i] for i in range(len(x))] == waves
    assert max(v for (e, _), v in labels.items() if e == "none") == 1
