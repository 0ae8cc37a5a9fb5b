"""What the whole job reads, moves and computes beside its results."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from check import cells
from tidemark.operators import clean as C
from tidemark.operators.waves import detect_peaks, join_for, label_waves
from tidemark.plans import catalog, warehouse
from tidemark.plans.stages import Settings, run_stages
from tidemark.sources import io
from tidemark.sources.shared import fresh_path
from tidemark.spec import COUNT_COLUMNS, RAW_COLUMNS

START = dt.date(2021, 1, 1)


def raw_rows(spark, rows):
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], schema)


def land(code, label, days=60):
    return [
        {"iso_code": code, "location": label, "continent": "X", "date": str(START + dt.timedelta(days=d)),
         "new_cases": str((d * 7) % 11), "new_cases_smoothed": str(float((d * 7) % 11)),
         "new_deaths": "1", "total_cases": str(d), "total_deaths": "1", "population": "3000000"}
        for d in range(days)
    ]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_repeated_keys_are_found_by_label_and_date_alone(spark):
    path = io.write(raw_rows(spark, land("A", "a")), fresh_path(spark, "t"), "csv")
    seen = []
    keep = C.materialise
    try:
        C.materialise = lambda df: seen.append(plan_of(df)) or keep(df)
        assert C.clean(io.read_raw(spark, path).frame).count() == 60
    finally:
        C.materialise = keep
    scans = [s for s in seen if "FileScan csv" in s]
    assert scans and all("population" not in s and "new_cases" not in s for s in scans)


def test_rows_without_label_are_told_apart_by_all_their_columns(spark):
    bare = {"iso_code": "B", "date": "2021-01-01", "new_cases": "1"}
    rows = [bare, bare, bare | {"new_cases": "2"}, *land("A", "a", 3), *land("A", "a", 3)]
    got = C.clean(raw_rows(spark, rows)).groupBy("iso_code").count().collect()
    assert {r.iso_code: r["count"] for r in got} == {"A": 3, "B": 2}


def test_whole_numbers_are_not_rounded_through_text(spark):
    texts = ["0.5", "-0.5", "1.5", "2.5", "-2.5", "0.49999999999999994", "4503599627370497.5", "1e18", "1e300",
             "Infinity", "-0.0", "NaN", "x", None, "9007199254740993", "7", "1417173120.0"]
    df = spark.createDataFrame([(t,) for t in texts], "total_cases string")
    got = C.cast_numeric(df, ("total_cases",), COUNT_COLUMNS)
    number = F.nanvl(F.col("total_cases").try_cast("double"), F.lit(None).cast("double"))
    want = df.select(F.round(number).try_cast("bigint").alias("total_cases"))
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert "rint" in plan_of(got)


@pytest.mark.parametrize("join", ["broadcast", "shuffle_hash"])
def test_waves_are_the_same_however_peaks_reach_their_rows(spark, join):
    panel = C.clean(raw_rows(spark, land("A", "a") + land("B", "b") + land(None, "c", 9)))
    peaks = detect_peaks(panel, distance=5, least=2).localCheckpoint()
    one, other = label_waves(panel, peaks, unique=True, join=join), label_waves(panel, peaks)
    assert cells(one.toPandas()) == cells(other.select(one.columns).toPandas())
    assert one.agg(F.max("wave_number")).first()[0] > 1 and join_for(peaks) == "broadcast"


@pytest.mark.parametrize("others", [[], land("A", "other", 30), land("", "d") + land("", "e")])
def test_waves_of_the_job_are_those_of_windows(spark, others):
    """Also where a code, or a blank one, goes by two labels."""
    source = io.write(raw_rows(spark, land("A", "a") + land("B", "b") + others), fresh_path(spark, "t"), "csv")
    out = fresh_path(spark, "t")
    done = run_stages(spark, source, out, Settings(distance=5, least=2, stages=("clean", "analyse")))
    assert done.exit_code == 0, done.status
    panel = spark.read.parquet(f"{out}/panel")
    want = label_waves(panel, detect_peaks(panel, distance=5, least=2))
    made = spark.read.parquet(f"{out}/waves")
    assert cells(made.toPandas()) == cells(want.select(made.columns).toPandas())


def test_wave_view_of_the_job_needs_no_other_tables(spark):
    source = io.write(raw_rows(spark, land("A", "a") + land("B", "b")), fresh_path(spark, "t"), "csv")
    out = fresh_path(spark, "t")
    done = run_stages(spark, source, out, Settings(distance=5, least=2, min_pop=catalog.MIN_POP))
    assert done.exit_code == 0, done.status
    # Neither a fact nor entities: asking for them fails.
    w = SimpleNamespace(tables=SimpleNamespace(spark=spark, folder="job"))
    catalog._runs[spark.sparkContext.applicationId, "job"] = (out, sorted(done.tables))
    assert catalog._queries["full_run_waves"](w).count() > 2


def test_spread_rows_come_in_a_task_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(warehouse, "_built", {})
    monkeypatch.setattr(warehouse, "Warehouse", lambda *given: given)
    warehouse.open_warehouse(spark, "nowhere")
    saved = warehouse.save_bucketed(
        spark.createDataFrame([(f"S{i}", START) for i in range(64)], "iso_code string, date date"), "t", 8
    )
    assert "Bucketed: true" in plan_of(saved)
    assert int(spark.conf.get(warehouse.LEAST_TASKS)) > spark.sparkContext.defaultParallelism


def test_packed_text_is_packed_quickly(spark):
    rows = spark.range(200_000).select(F.concat(F.col("id"), F.lit("-"), F.col("id") % 7).alias("a")).coalesce(1)
    size = {}
    for level in ("BEST_SPEED", None):
        path = io.write(rows, fresh_path(spark, "t"), "csv", compression="gzip", level=level)
        size[level] = sum(n for _, n in io.commits.children(spark, path))
        assert spark.read.option("header", True).csv(path).count() == 200_000
    assert size["BEST_SPEED"] > size[None] and catalog.PACKED["level"] == "BEST_SPEED"
