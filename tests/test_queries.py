"""Registered queries beside their SQL on the smallest tables, and the shape of key plans."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from check import cells
from tidemark.operators import reports, views
from tidemark.operators.panel import latest_row
from tidemark.plans import catalog, oracle
from tidemark.plans.warehouse import open_warehouse

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")

SAMPLE = (
    "clean_panel", "fact_daily", "check_keys", "v_continental_summary", "v_high_risk",
    "v_wave_summary", "entity_ranks", "milestones", "top3_per_group", "detect_peaks",
    "label_waves", "correlation_matrix", "pearson_test", "risk_scores", "kpi_cards",
    "nearest_date", "growth_heatmap", "calendar_7d_avg_by_entity", "global_wave_bands",
    "scatter_trend", "scatter_trend_trimmed", "wave_extent_unlabelled", "bi_calendar", "read_typed",
    "load_staging",
)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_a_twin():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(oracle.oracle_sql()) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_returns_the_groups(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, db, name):
    mine = contract.queries()[name](spark, FOLDER).toPandas()
    theirs = db.execute(contract.oracle_sql()[name]).fetch_df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert cells(mine) == cells(theirs)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entity_work_over_the_fact_needs_no_shuffle(spark):
    w = open_warehouse(spark, FOLDER)
    current = plan(latest_row(w.fact, columns=["total_cases", "vaccination_rate"]))
    assert "Exchange" not in current and "Sort" not in current
    assert "HashAggregate" in current
    growth = reports.day_growth(w.fact, ("S0",), "1998-01-01").drop("growth_pct")
    assert "hashpartitioning" not in plan(growth)


def test_filters_and_columns_reach_the_scan(spark):
    w = open_warehouse(spark, FOLDER)
    text = plan(reports.entity_monthly(w.fact, "S0"))
    assert "EqualTo(iso_code,S0)" in text
    assert "stringency_index" not in text


def test_no_plan_pairs_rows(spark):
    w = open_warehouse(spark, FOLDER)
    for df in (
        views.continental_summary(w.fact, w.entities), views.high_risk(w.fact, w.entities, 0),
        reports.above_below(w.fact, w.entities, 0), reports.timeline(w.fact, w.entities),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text
