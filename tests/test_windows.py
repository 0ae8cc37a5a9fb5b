"""Aggregates over date windows against a loop."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators.datasets import peak_in_window
from tidemark.operators.windows import over_windows

DAY = dt.date(1969, 11, 20)


def table(spark, rng, windows, days):
    rows = [
        (rng.choice("ab"), DAY + dt.timedelta(days=rng.randrange(days)), rng.randrange(50))
        for _ in range(2500)
    ] + [("a", None, 1), (None, DAY, 5)]
    asked = []
    for i in range(windows):
        first = rng.randrange(-50, days + 50)
        length = rng.choice([0, 1, 6, 30, 400, 20_000, -1, -30])
        asked.append((f"w{i}", rng.choice("abc"), DAY + dt.timedelta(days=first),
                      DAY + dt.timedelta(days=first + length)))
    return (rows, asked, spark.createDataFrame(rows, "e string, date date, x int"),
            spark.createDataFrame(asked, "window_name string, e string, start_date date, end_date date"))


def test_sums_and_peaks_equal_a_loop(spark):
    rows, asked, series, windows = table(spark, random.Random(1), 300, 700)
    found = over_windows(
        series, windows.unionByName(windows), {"s": F.sum("x"), "n": F.count("*")},
        {"s": F.sum, "n": F.sum}, by=("e",),
    )
    want = {}
    for name, e, a, b in asked:
        hit = [x for k, d, x in rows if k == e and d and a <= d <= b]
        if hit:
            want[name] = (sum(hit), len(hit))
    assert {r.window_name: (r.s, r.n) for r in found.collect()} == want
    peaks = peak_in_window(series, "x", windows.drop("e"))
    want = {}
    for name, _, a, b in asked:
        hit = [(-x, d) for _, d, x in rows if d and a <= d <= b]
        if hit:
            want[name] = (min(hit)[1], -min(hit)[0])
    assert {r.window_name: (r.peak_date, r.peak_value) for r in peaks.collect()} == want


def test_ten_thousand_windows_meet_blocks_and_not_rows(spark):
    rng = random.Random(2)
    rows, asked, series, windows = table(spark, rng, 10_000, 3000)
    peaks = peak_in_window(series, "x", windows.drop("e"))
    plan = peaks._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {r.window_name: (r.peak_date, r.peak_value) for r in peaks.collect()}
    for name, _, a, b in asked[:400]:
        hit = [(-x, d) for _, d, x in rows if d and a <= d <= b]
        assert got.get(name) == ((min(hit)[1], -min(hit)[0]) if hit else None)


def test_no_rows_and_no_windows(spark):
    _, _, series, windows = table(spark, random.Random(3), 5, 10)
    for s, w in ((series.limit(0), windows), (series, windows.limit(0))):
        assert over_windows(s, w, {"s": F.sum("x")}, {"s": F.sum}, by=("e",)).count() == 0
