"""Latest rows and values, nearest dates, ranks, quantiles: edge cases and brute force."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from tidemark.operators import ranks as R, stats as S
from tidemark.operators.datasets import calendar_avg, window_avg
from tidemark.operators.panel import latest_row, latest_values, nearest_date, one_row_per_key
from tidemark.sources.shared import materialise
from tidemark.spec import PanelSpec

BY_CODE = PanelSpec(label="iso_code")


def test_latest_row_and_latest_values_differ_on_null_tails(panel_of):
    panel = panel_of([
        {"iso_code": "A", "date": "2021-01-01", "total_cases": 5, "location": "a", "continent": "X"},
        {"iso_code": "A", "date": "2021-01-02", "total_cases": None, "location": "b"},
    ], "total_cases", "location", "continent")
    row = latest_row(panel).first()
    assert (row.total_cases, row.location, row.continent, row.date) == (
        None, "b", None, dt.date(2021, 1, 2))
    row = latest_values(panel, BY_CODE).first()
    assert (row.total_cases, row.location, row.continent) == (5, "b", "X")


def test_cleaning_moves_wide_rows_once(spark):
    """Without repeated keys one exchange; with some, only their rows move twice."""
    from tidemark.operators import clean as C
    from tidemark.sources.shared import fresh_path

    rows = [(f"E{e}", f"Land {e}", f"2021-01-{d:02d}", str(e * d)) for e in range(6) for d in range(1, 20)]
    extra = [rows[3], rows[3], (rows[5][0], rows[5][1], rows[5][2], "77")]
    others = ("total_cases", "total_deaths", "population", "people_fully_vaccinated", "total_tests")

    def table(data):
        df = spark.createDataFrame(data, "iso_code string, location string, date string, new_cases string")
        return df.withColumns({c: F.col("new_cases") for c in others})

    def exchanges(data):
        path = fresh_path(spark, "t")
        table(data).write.parquet(path)
        out = C.clean(spark.read.parquet(path))
        plan = out._jdf.queryExecution().executedPlan().toString()
        return out, plan.count("Exchange hashpartitioning")

    once, n = exchanges(rows)
    assert n == 1 and once.count() == len(rows)
    settled, n = exchanges(rows + extra)
    assert n == 2 and settled.count() == len(rows)
    kept = table(rows + extra)
    for few in (C.FEW, 0):
        old, C.FEW = C.FEW, few
        try:
            again = C.clean(kept)
            assert sorted(map(str, again.collect())) == sorted(map(str, settled.collect()))
        finally:
            C.FEW = old


def test_one_row_per_key_is_stable_and_prunes_before_the_shuffle(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 7).alias("v"),
    )
    first = sorted(map(tuple, one_row_per_key(df, ["k"]).collect()))
    again = sorted(map(tuple, one_row_per_key(df.repartition(5, "v"), ["k"]).collect()))
    assert first == again
    assert len(first) == df.select("k").distinct().count()
    plan = one_row_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_nearest_date_against_brute_force(spark, panel_of):
    rng = random.Random(3)
    start = dt.date(2021, 1, 1)
    rows = [
        {"iso_code": e, "date": start + dt.timedelta(days=d), "new_cases": d}
        for e in "ABC" for d in sorted(rng.sample(range(200), 25))
    ]
    asks = [(e, start + dt.timedelta(days=rng.randrange(-20, 220))) for e in "ABCD" for _ in range(15)]
    asks = sorted(set(asks))
    got = nearest_date(
        panel_of(rows, "new_cases"), spark.createDataFrame(asks, "iso_code string, wanted_date date")
    ).collect()
    want = {
        (e, w): min(
            (abs((r["date"] - w).days), r["date"], r["new_cases"]) for r in rows if r["iso_code"] == e
        )[1:]
        for e, w in asks if e != "D"
    }
    assert {(r.iso_code, r.wanted_date): (r.date, r.new_cases) for r in got} == want


@pytest.fixture(scope="module")
def skewed(spark):
    """Two fifths of the rows share one value, some are NULL, one group holds most rows."""
    rng = random.Random(11)
    rows = [
        (i, "hot" if i % 5 else f"g{i % 4}",
         None if i % 17 == 0 else 3.5 if i % 5 < 2 else float(rng.randrange(300)))
        for i in range(4000)
    ]
    return materialise(spark.createDataFrame(rows, "id int, g string, v double"))


@pytest.mark.parametrize("kind", ["rank", "dense_rank", "average"])
@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("way", ["asc", "desc"])
def test_range_ranks_equal_window_ranks(skewed, kind, by, way):
    order = F.col("v").asc_nulls_last() if way == "asc" else F.col("v").desc_nulls_last()
    w, same = Window.partitionBy(*by).orderBy(order), Window.partitionBy(*by, "v")
    plain = {
        "rank": F.rank().over(w), "dense_rank": F.dense_rank().over(w),
        "average": F.rank().over(w) + (F.count(F.lit(1)).over(same) - 1) / 2,
    }[kind]
    want = skewed.withColumn("r", plain)
    got = R.with_rank(skewed, "r", [("v", way)], kind, by)
    assert {x.id: float(x.r) for x in got.collect()} == {x.id: float(x.r) for x in want.collect()}


def test_range_ranks_need_no_single_partition(skewed):
    ranked = R.with_ranks(skewed, {
        "a": ([("v", "asc")], "rank"), "b": ([("id", "desc")], "dense_rank"),
    }, ["g"])
    text = ranked._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text
    assert ranked.columns == [*skewed.columns, "a", "b"] and ranked.count() == 4000


def test_range_rank_of_a_total_order_is_a_row_number(skewed):
    got = R.with_rank(skewed, "r", [("v", "desc"), ("id", "asc")]).collect()
    assert sorted(x.r for x in got) == list(range(1, 4001))


@pytest.mark.parametrize("by", [[], ["g"]])
def test_top_ranked_keeps_every_tie(skewed, by):
    got = R.top_ranked(skewed, "r", "v", 5, by).toPandas()
    known = skewed.toPandas().dropna(subset=["v"])
    ranks = known.groupby(by).v.rank(method="min", ascending=False) if by else known.v.rank(
        method="min", ascending=False)
    want = known.assign(r=ranks)[ranks <= 5]
    assert sorted(zip(got.id, got.r)) == sorted(zip(want.id, want.r))


@pytest.mark.parametrize("q", [0, 0.25, 0.5, 0.98, 1])
def test_quantile_is_exact(spark, skewed, q):
    got = spark.range(1).select(R.quantile(skewed, "v", q).alias("q")).first().q
    assert got == pytest.approx(skewed.toPandas().v.quantile(q))


def test_calendar_and_row_frames_differ_over_gaps(panel_of):
    days = ["2021-01-01", "2021-01-02", "2021-01-20", "2021-01-21"]
    panel = panel_of(
        [{"iso_code": "A", "date": d, "new_cases": i} for i, d in enumerate(days)], "new_cases"
    )
    assert [r.calendar_avg for r in calendar_avg(panel).orderBy("date").collect()] == [0, 0.5, 2, 2.5]
    assert [r.window_avg for r in window_avg(panel).orderBy("date").collect()] == [0, 0.5, 1, 1.5]


def _numbers(spark, n=300, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n)
    pdf = pd.DataFrame({
        "location": [f"L{i}" for i in range(n)], "vaccination_rate": np.round(x, 1),
        "case_fatality_rate": np.round(-0.4 * x + rng.normal(size=n), 1),
        "gdp_per_capita": np.where(rng.random(n) < 0.2, np.nan, rng.normal(size=n)),
    })
    frame = spark.createDataFrame(pdf)
    gdp = F.when(~F.isnan("gdp_per_capita"), F.col("gdp_per_capita"))
    return pdf, frame.withColumn("gdp_per_capita", gdp)


def test_correlations_match_pandas(spark):
    pdf, frame = _numbers(spark)
    got = S.correlation_matrix(frame).toPandas().set_index(
        ["correlation_type", "metric"])
    names = ["vaccination_rate", "case_fatality_rate", "gdp_per_capita"]
    for kind in ("pearson", "spearman"):
        if kind == "pearson":
            want = pdf[names].corr()
        else:  # pairwise ranks, without SciPy
            want = pd.DataFrame(1.0, names, names)
            for a in names:
                for b in names:
                    both = pdf[[a, b]].dropna().rank() if a != b else None
                    if both is not None:
                        want.loc[a, b] = both[a].corr(both[b])
        assert np.allclose(got.loc[kind].loc[names, names].astype(float), want.loc[names, names])


def test_correlations_of_many_ties_and_gaps_match_pandas(spark):
    rng = np.random.default_rng(5)
    names = list(S.CORRELATION_METRICS)
    pdf = pd.DataFrame({c: rng.integers(0, 3 + 4 * i, 400).astype(float) for i, c in enumerate(names)})
    pdf[names[1]] += pdf[names[0]]
    pdf = pdf.mask(rng.random(pdf.shape) < 0.2)
    pdf[names[-1]] = 1.0  # does not vary
    frame = spark.createDataFrame(
        [tuple(None if pd.isna(v) else float(v) for v in r) for r in pdf.itertuples(index=False)],
        ", ".join(f"{c} double" for c in names),
    ).repartition(5)
    got = S.correlation_matrix(frame).toPandas().set_index(["correlation_type", "metric"])
    for kind in ("pearson", "spearman"):
        for a in names:
            for b in names:
                both = pdf[[a, b]].dropna().to_numpy()
                if kind == "spearman":
                    both = pd.DataFrame(both).rank().to_numpy()
                want = np.corrcoef(both.T)[0, 1] if names[-1] not in (a, b) else None
                value = got.loc[(kind, a), b]
                assert pd.isna(value) if want is None else abs(value - want) < 1e-9, (kind, a, b)


@pytest.mark.parametrize("r,n,p", [
    (0.0, 12, 1.0), (1.0, 12, 0.0), (-1.0, 12, 0.0), (0.5, 4, 0.5),  # df 2: p = 1 - |r|
    (0.6, 3, 1 - 2 / np.pi * np.arctan(0.75)),                       # df 1: Cauchy tail
    (-0.3, 4, 0.7),
])
def test_p_values_with_closed_forms(spark, r, n, p):
    from tidemark.functions.tdist import correlation_p_value
    df = spark.createDataFrame([(r, n)], "r double, n long")
    assert df.select(correlation_p_value("r", "n").alias("p")).first().p == pytest.approx(p, abs=1e-12)


def test_p_values_keep_their_digits_at_every_n(spark):
    """Against the normal tail for huge n and against sums of powers for even degrees of freedom."""
    import math

    from tidemark.functions.tdist import correlation_p_value

    cases = []
    for n in (10**9, 10**10, 10**12, 10**13, 10**15):
        for t in (0.01, 1.0, 2.0, 5.0, 9.0):
            v = n - 2
            z = t * (1 - (t * t + 1) / (4 * v))  # normal value of the same tail, to order 1/v
            cases.append((t / math.sqrt(v + t * t), n, math.erfc(z / math.sqrt(2))))
    for v in (2, 4, 10, 40, 300):
        for r in (1e-9, 0.1, 0.5, 0.9, 0.999):
            # 1 - p = r * sum over j < v/2 of (1/2)_j / j! * (1 - r^2)^j
            term, total = 1.0, 0.0
            for j in range(v // 2):
                total += term
                term *= (j + 0.5) / (j + 1) * (1 - r * r)
            rest = term  # the rest of the series, whose whole sum is 1 / r, gives p without cancelling
            tail, j = 0.0, v // 2
            while rest > 1e-18 * max(tail, 1e-300) and j < 3_000_000:
                tail += rest
                rest *= (j + 0.5) / (j + 1) * (1 - r * r)
                j += 1
            if r >= 0.1:
                cases.append((r, v + 2, r * tail))
            else:
                cases.append((r, v + 2, 1 - r * total))
    df = spark.createDataFrame(cases, "r double, n long, want double")
    rows = df.select("*", correlation_p_value("r", "n").alias("p")).collect()
    for row in rows:
        assert row.p == pytest.approx(row.want, rel=2e-8), row
    plan = df.select(correlation_p_value("r", "n"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    none = spark.createDataFrame([(None, 9), (float("nan"), 9), (0.5, 2)], "r double, n long")
    assert {r.p for r in none.select(correlation_p_value("r", "n").alias("p")).collect()} == {None}


def test_correlation_test_guards(spark):
    _, frame = _numbers(spark, 9)
    assert S.correlation_test(frame, "vaccination_rate", "case_fatality_rate").count() == 0
    flat = spark.range(20).select(F.lit(1.0).alias("a"), F.col("id").cast("double").alias("b"))
    row = S.correlation_test(flat, "a", "b").first()
    assert (row.pairs, row.r, row.p_value, row.direction) == (20, None, None, None)


def test_min_max_of_a_constant_column(spark):
    flat = spark.createDataFrame([(2.0,), (2.0,), (None,)], "a double")
    assert [r.s for r in S.min_max(flat, {"a": "s"}).collect()] == [0.0, 0.0, None]
    assert [r.s for r in S.min_max(flat, {"a": "s"}, epsilon=1e-9).collect()] == [0.0, 0.0, None]


def test_trend_line_needs_a_varying_x(spark):
    line = spark.range(4).select(F.col("id").cast("double").alias("x"), (2 * F.col("id") + 1).alias("y"))
    got = S.ols_trend(line, "x", "y", 4).orderBy("point").collect()
    assert [(r.x, r.fitted) for r in got] == [(0.0, 1.0), (1.0, 3.0), (2.0, 5.0), (3.0, 7.0)]
    flat = S.ols_trend(line.withColumn("x", F.lit(1.0)), "x", "y", 3).collect()
    assert {r.slope for r in flat} == {None}
