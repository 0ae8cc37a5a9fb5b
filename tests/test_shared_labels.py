"""Suppliers of a key of their own that share a label; peaks and wide rows at size."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from check import cells
from tidemark.operators import reports
from tidemark.plans import catalog, derived, warehouse
from tidemark.plans.warehouse import Warehouse

FIRST, DAYS = dt.datetime(2020, 1, 1), 60


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(5)
    lines = [
        (rng.randrange(60), s, float(rng.randrange(1, 51)), rng.choice("RAN"), rng.choice("OF"),
         None if rng.random() < 0.05 else FIRST + dt.timedelta(days=rng.randrange(DAYS)))
        for s, n in ((1, 60), (2, 25), (3, 9)) for _ in range(n)
    ]
    frames = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "JAPAN", 0)]),
        "supplier": (
            "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
            [(1, "one", 0, 5.0), (2, "one", 0, -1.0), (3, "three", 0, 2.0)],
        ),
        "orders": ("o_orderkey bigint, o_custkey bigint", [(k, k % 9) for k in range(60)]),
        "lineitem": (
            "l_orderkey bigint, l_suppkey bigint, l_quantity double, l_returnflag string, "
            "l_linestatus string, l_shipdate timestamp", lines,
        ),
    }
    for name, (schema, rows) in frames.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{out}/{name}.parquet")
    return out


@pytest.fixture(scope="module")
def shared(spark, folder):
    return Warehouse(spark, folder, 30, 0.8, stored_rows=0)


def _windows(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Window" in line for line in plan.splitlines())


def test_shared_labels_need_no_windows_by_entity(spark, folder, shared):
    """F7-F37: days of suppliers that share nothing but a label are not sorted by entity."""
    assert shared.unique and not shared.single
    assert not _windows(shared.raw) and not _windows(shared.days.select("date", "new_cases_smoothed"))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(warehouse, "one_row_each", lambda tables: False)
        windowed = Warehouse(spark, folder, 30, 0.8, stored_rows=0)
    assert _windows(windowed.raw)
    assert cells(shared.raw.toPandas()) == cells(windowed.raw.toPandas())
    assert shared.panel.columns == windowed.panel.columns
    by_entity = ["iso_code", "date", "new_cases_smoothed", "reproduction_rate", "new_cases"]
    one, other = shared.days.select(*by_entity), windowed.days.select(*by_entity)
    assert cells(one.toPandas()) == cells(other.toPandas())


def test_peak_of_an_entity_sorts_no_rows(spark):
    """the highest day, the earliest of equal ones, a missing height below all others."""
    day = [dt.date(2020, 1, n) for n in range(1, 6)]
    rows = spark.createDataFrame([
        ("a", day[3], 4, 2.0), ("a", day[1], 7, 2.0), ("a", day[2], 1, None), ("a", day[0], 9, 1.0),
        ("b", day[2], 3, None), ("b", day[1], None, None), ("c", day[0], 0, 0.0), ("c", day[4], 1, -1.0),
    ], "iso_code string, date date, new_cases bigint, new_cases_smoothed double")
    found = reports._peak(rows, reports.EPIDEMIC)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    assert sorted(map(tuple, found.collect())) == [
        ("a", day[1], 7, 2.0), ("b", day[1], None, None), ("c", day[0], 0, 0.0),
    ]


def test_quarter_peaks_are_kept_without_sorting(spark, folder, shared):
    """F16: the peak of a window and its earliest day."""
    found = catalog._queries["quarter_windows"](shared)
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    rows = {(r["iso_code"], r["start_date"]): r for r in found.collect()}
    cases = {(r["iso_code"], r["date"]): r["new_cases"] for r in shared.days.collect()}
    assert len(rows) == 6
    for (code, start), r in rows.items():
        span = {d: n for (c, d), n in cases.items() if c == code and start <= d <= r["end_date"]}
        top = max(span.values())
        assert (r["cases"], r["peak_value"]) == (sum(span.values()), top)
        assert r["peak_date"] == min(d for d, n in span.items() if n == top)


def test_fact_of_own_keys_is_not_settled_again(spark, folder, shared, monkeypatch):
    """rows of one entity and day each are not ranked by their hash."""
    found = catalog._queries["fact_daily"](shared)
    assert "xxhash64" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 3 * DAYS


def test_methods_stay_short_enough_to_be_compiled(spark, folder, monkeypatch):
    """F7-F25: a generated method too long for the JVM's compiler is not used."""
    monkeypatch.setattr(warehouse, "_built", {})
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        warehouse.open_warehouse(spark, folder)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)


def test_landed_rows_are_shuffled_to_their_label_once(spark, folder):
    """F9-F35: rows go to their partition before they are widened, not after as well."""
    tables = derived.Tables(spark, folder)
    first, last = derived.span(tables)
    plan = derived.activity(tables, first, last, 3, "series")._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Window")]
    assert "Exchange" not in above and "Join" not in above
    assert plan.count("REPARTITION_BY_NUM") == 1


def test_landed_rows_follow_every_copy_of_a_key(spark, folder, tmp_path):
    """F9-F35: a key of several rows, under one label or several, has its days under each."""
    source = derived.Tables(spark, folder)
    for name in ("region", "nation", "orders", "lineitem"):
        source.read(name).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.createDataFrame(
        [(1, "one", 0, 5.0), (1, "one", 0, 5.0), (1, "else", 0, 5.0), (2, "two", 0, None)],
        "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    ).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    tables = derived.Tables(spark, str(tmp_path))
    first, last = derived.span(tables)
    landed = derived.activity(tables, first, last, 3, "series")
    copies = landed.where("iso_code = 'S1'").groupBy("location", "copy").agg(
        F.count("*").alias("rows"), F.max("run_cases").alias("cases")
    ).collect()
    lines = source.read("lineitem").where("l_suppkey = 1").count()
    assert sorted(r["location"] for r in copies) == ["else", "one", "one"]
    assert {r["cases"] for r in copies} == {lines}
    assert len({r["rows"] for r in copies}) == 1
