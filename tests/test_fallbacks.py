"""Columns that a panel may lack, and paths that queries leave behind."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import datasets as G, stats as S
from tidemark.sources import shared


def test_kpi_cards_from_daily_values(panel_of):
    rows = [
        {"iso_code": e, "date": f"2021-01-0{d}", "new_cases": d * 10, "new_deaths": d,
         "population": 100, "vaccination_rate": 50.0}
        for e in ("A", "B") for d in (1, 2, 3)
    ]
    panel = panel_of(rows, "new_cases", "new_deaths", "population", "vaccination_rate")
    got = G.kpi_cards(panel).first()
    assert (got.total_cases, got.total_deaths) == (120, 12)
    assert got.vaccination_pct == 50 and got.cfr_pct == pytest.approx(10)
    bare = G.kpi_cards(panel.drop("vaccination_rate", "population")).first()
    assert bare.total_cases == 120 and bare.vaccination_pct is None


def test_weighted_risk_without_an_input(spark):
    rows = [("x", 0.1, 10.0, 20.0), ("y", 0.2, 30.0, 80.0)]
    full = spark.createDataFrame(
        rows, "location string, case_fatality_rate double, total_deaths_per_million double, "
        "vaccination_rate double"
    )
    cut = full.drop("case_fatality_rate")
    got = {r.location: r.composite_risk_score for r in S.risk_weighted(cut).collect()}
    assert S.risk_weighted(cut).columns == [*cut.columns, "composite_risk_score"]
    assert got["x"] == pytest.approx(0.2) and got["y"] == pytest.approx(0.4)


def test_fatality_from_totals(spark):
    rows = spark.createDataFrame([(100, 5), (0, 0)], "total_cases long, total_deaths long")
    got = [r.case_fatality_rate for r in G.with_fatality(rows).collect()]
    assert got == [0.05, None]
    known = rows.withColumn("case_fatality_rate", F.lit(0.5))
    assert G.with_fatality(known) is known


def test_trend_needs_more_than_five_points(spark):
    rows = [(float(i), 0.01 * i) for i in range(1, 6)]
    frame = spark.createDataFrame(rows, "vaccination_rate double, case_fatality_rate double")
    assert G.coverage_trend(frame).count() == 0
    more = frame.union(spark.createDataFrame([(9.0, 0.2)], frame.schema))
    assert G.coverage_trend(more).count() == 100


def test_own_paths_are_removed(spark):
    path = shared.fresh_path(spark, "t")
    spark.range(3).write.parquet(path)
    shared.discard([path])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
