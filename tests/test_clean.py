"""Hand-made edge cases of the cleaning steps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import exprs as E
from tidemark.operators import clean as C
from tidemark.operators.panel import fill_forward, rolling_mean
from tidemark.spec import COUNT_COLUMNS, PANEL_COLUMNS, RAW_COLUMNS


def raw_rows(spark, rows):
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], schema)


def base(**over):
    return {
        "iso_code": "AAA", "continent": "X", "location": "Aland", "date": "2021-01-01",
        "population": "1000", **over,
    }


def test_prefix_filter_keeps_missing_code(spark):
    df = raw_rows(spark, [base(), base(iso_code=None), base(iso_code="OWID_WRL")])
    assert sorted(r.iso_code or "" for r in C.drop_aggregate_rows(df).collect()) == ["", "AAA"]


def test_bad_dates_are_dropped(spark):
    df = raw_rows(spark, [base(), base(date="2020-13-01"), base(date=None), base(date="")])
    assert [r.date for r in C.parse_dates(df).collect()] == [dt.date(2021, 1, 1)]


@pytest.mark.parametrize("text,expected", [
    ("", None), ("1,234", None), ("NaN", None), ("5.0", 5), ("x", None), ("1417173120.0", 1417173120),
])
def test_numbers_from_text(spark, text, expected):
    df = raw_rows(spark, [base(total_cases=text, positive_rate=text)])
    row = C.cast_numeric(df, ("total_cases", "positive_rate"), COUNT_COLUMNS).first()
    assert row.total_cases == expected
    assert row.positive_rate == expected


def test_fill_keeps_leading_gaps_and_fills_the_tail(panel_of):
    values = [None, None, 5, None, 7, None]
    panel = panel_of(
        [{"iso_code": "A", "date": f"2021-01-0{i + 1}", "total_cases": v} for i, v in enumerate(values)],
        "total_cases",
    )
    filled = fill_forward(panel, ["total_cases"], "iso_code").orderBy("date").collect()
    assert [r.total_cases for r in filled] == [None, None, 5, 5, 7, 7]


@pytest.mark.parametrize("n", [1, 6, 7, 9])
def test_rolling_mean_over_what_exists(panel_of, n):
    values = [(i * 7) % 5 for i in range(n)]
    panel = panel_of(
        [{"iso_code": "A", "date": f"2021-01-{i + 1:02d}", "new_cases": v} for i, v in enumerate(values)],
        "new_cases",
    )
    got = rolling_mean(panel, {"new_cases": "m"}, 7, "iso_code").orderBy("date").collect()
    want = [sum(values[max(0, i - 6):i + 1]) / len(values[max(0, i - 6):i + 1]) for i in range(n)]
    assert [r.m for r in got] == pytest.approx(want)


def test_rates_without_denominator_are_null(spark):
    rows = [
        base(total_cases="0", total_deaths="0"),
        base(date="2021-01-02", total_cases="4", total_deaths="1", population="0"),
        base(date="2021-01-03", total_cases="4", total_deaths="1", population=None),
    ]
    got = C.clean(raw_rows(spark, rows)).orderBy("date").collect()
    assert [r.case_fatality_rate for r in got] == [None, 0.25, 0.25]
    assert [r.mortality_rate_per_million for r in got] == [0.0, None, None]
    assert [r.tests_per_case for r in got] == [None, None, None]


def test_clean_panel_shape_and_iso_week(spark):
    rows = [base(date=d, new_cases="-3") for d in ("2020-12-28", "2021-01-03")]
    got = C.clean(raw_rows(spark, rows))
    assert tuple(got.columns) == PANEL_COLUMNS
    parts = got.orderBy("date").select("year", "month", "week", "day_of_week", "new_cases").collect()
    assert [tuple(p) for p in parts] == [(2020, 12, 53, 0, -3), (2021, 1, 53, 6, -3)]


def test_clean_keeps_one_row_per_series_and_day_and_all_unlabelled_rows(spark):
    copies = [base(new_cases="1")] * 500 + [base(new_cases="2")]
    loose = [base(location=None, iso_code=None, new_cases=str(i)) for i in range(5)]
    got = C.clean(raw_rows(spark, copies + loose)).collect()
    assert sorted(r.location or "" for r in got) == [""] * 5 + ["Aland"]
    assert all(r.rolling_7day_cases is None for r in got if r.location is None)


def test_clean_is_the_same_for_any_width_and_declared_uniqueness(spark):
    rows = [
        base(location=f"L{i % 3}", date=f"2021-01-{i // 3 + 1:02d}", new_cases=str(i),
             total_cases=None if i % 4 else str(i)) for i in range(60)
    ]
    df = raw_rows(spark, rows)
    want = sorted(map(str, C.clean(df).collect()))
    assert sorted(map(str, C.clean(df, unique=True, partitions=3).collect())) == want


def test_smoothing_and_per_million_fallbacks(spark, panel_of):
    panel = panel_of([{"iso_code": "A", "date": "2021-01-01", "new_cases": 4}], "new_cases")
    panel = panel.withColumn("location", F.lit("A"))
    assert C.ensure_smoothed(panel, "new_cases", "s").first().s == 4.0
    assert C.ensure_smoothed(panel, "absent", "s").first().s == 0.0
    assert C.ensure_smoothed(panel, "absent", "new_cases") is panel
    summary = spark.sql("select 5L total_cases, 1L total_deaths, 10L population")
    row = C.ensure_per_million(summary).first()
    assert (row.total_cases_per_million, row.mortality_rate_per_million) == (500000.0, 100000.0)


def test_expressions(spark):
    row = spark.sql("select 0 z, 10 c, 1 d, cast(null as double) n, 0.5D f, 40D g").select(
        E.recovery_rate(F.col("d"), F.col("c")).alias("r"),
        E.recovery_rate(F.col("d"), F.col("z")).alias("r_null"),
        E.recovery_rate(F.col("d"), F.col("z"), alternate=0).alias("r_100"),
        E.percent_if_fraction(F.col("f")).alias("p"), E.percent_if_fraction(F.col("g")).alias("q"),
        E.clip_floor(F.lit(-2)).alias("clip"), E.clip_floor(F.col("n")).alias("clip_null"),
        E.log_weight(F.lit(10)).alias("w0"), E.log_weight(F.lit(2e9)).alias("w1"),
        E.rnd(F.lit(2.675), 2).alias("round"),
    ).first()
    assert tuple(row) == (90.0, None, 100.0, 50.0, 40.0, 0, None, 0.0, 1.0, 2.68)
