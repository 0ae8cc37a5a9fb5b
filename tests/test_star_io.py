"""Star schema, quality reports, sources and sinks, and the staged run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as Q, star
from tidemark.operators.clean import clean
from tidemark.plans.handover import Handover, StaleTable
from tidemark.plans.stages import STAGES, Settings, run_stages
from tidemark.sources import commits, io
from tidemark.sources.shared import fresh_path
from tidemark.spec import FACT_COLUMNS, RAW_COLUMNS


@pytest.fixture(scope="module")
def raw(spark):
    """Fourteen entities over ninety days, with gaps, and one aggregate."""
    start = dt.date(2021, 1, 1)
    rows = []
    for e in range(14):
        total = dead = 0
        for d in range(90):
            new = (d * (e + 3)) % 11
            total, dead = total + new, dead + new // 5
            seen = (d + e) % 4
            rows.append({
                "iso_code": f"E{e:02d}", "continent": f"C{e % 3}", "location": f"Land {e}",
                "date": str(start + dt.timedelta(days=d)), "population": str(2_000_000 + e),
                "new_cases": str(new) if seen else None, "new_deaths": str(new // 5),
                "total_cases": str(total) if seen else None, "total_deaths": str(dead),
                "people_fully_vaccinated": str(9000 * d + 500 * e * (d % 2)),
                "new_cases_smoothed": str(float(new)), "total_tests": str(total * 9 + 1),
                "positive_rate": "0.04", "total_cases_per_million": str(total / 2.0),
                "gdp_per_capita": str(1000.5 * e),
            })
    rows.append({"iso_code": "OWID_WRL", "location": "World", "date": "2021-01-01"})
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], schema)


def test_fact_from_text_rounds_counts_and_drops_blank_keys(spark):
    text = spark.createDataFrame([
        ("A", "2021-01-01", "2.6", "5.0", ""), ("A", "2021-01-01", "2.6", "5.0", ""),
        ("", "2021-01-01", "1", "1", "1"), (None, "2021-01-01", "1", "1", "1"),
        ("A", "", "1", "1", "1"), ("A", "2021-01-02", " ", "bad", "0.5"),
    ], "iso_code string, date string, new_cases string, total_cases string, positive_rate string")
    fact = star.fact_daily(text)
    assert tuple(fact.columns) == FACT_COLUMNS
    got = fact.orderBy("date").select("date", "new_cases", "total_cases", "positive_rate").collect()
    assert [tuple(r)[1:] for r in got] == [(3, 5, None), (None, None, 0.5)]


def test_dimension_takes_the_latest_row_or_the_last_known_value(panel_of):
    panel = panel_of([
        {"iso_code": "A", "date": "2021-01-01", "location": "a", "population": 5},
        {"iso_code": "A", "date": "2021-01-02", "location": "a", "population": None},
    ], "location", "population", "continent")
    assert star.dim_entity(panel).first().population is None
    assert star.dim_entity(panel, last_known=True).first().population == 5


def test_calendar_has_every_day_and_trimmed_names(panel_of):
    panel = panel_of([{"iso_code": "A", "date": d} for d in ("2020-12-28", "2021-01-03")])
    days = star.dim_date(panel).orderBy("date_key").collect()
    assert len(days) == 7
    assert (days[0].day_of_week, days[0].day_name, days[0].month_name, days[0].week_of_year) == (
        1, "Monday", "December", 53)
    assert (days[-1].day_of_week, days[-1].quarter, days[-1].week_of_year) == (7, 1, 53)


def test_quality_reports(spark, panel_of):
    rows = [
        {"iso_code": "A", "date": "2021-01-01", "new_cases": -1, "case_fatality_rate": 1.5},
        {"iso_code": "A", "date": "2021-02-01", "vaccination_rate": 151},
        {"iso_code": "B", "date": "2021-02-01", "new_cases": 4},
    ]
    panel = panel_of(rows, "new_cases", "case_fatality_rate", "vaccination_rate")
    assert {r.rule: r.bad for r in Q.sanity_counts(panel).collect()} == {
        "case_fatality_rate_above_1": 1, "vaccination_rate_above_150": 1, "new_cases_negative": 1}
    profile = {r.column_name: r.missing_pct for r in Q.missing_profile(panel).collect()}
    assert profile == pytest.approx(
        {"new_cases": 100 / 3, "case_fatality_rate": 200 / 3, "vaccination_rate": 200 / 3})
    months = {(r.column_name, r.month): r.missing_pct for r in Q.missing_by_month(panel).collect()}
    assert months["new_cases", "2021-01"] == 0 and months["new_cases", "2021-02"] == 50
    same = Q.reconcile(spark.range(1000), spark.range(990)).first()
    assert (same.difference, same.within_tolerance) == (10, True)
    assert not Q.reconcile(spark.range(1000), spark.range(989)).first().within_tolerance
    assert Q.reconcile(spark.range(5), spark.range(4)).first().within_tolerance


def test_key_report_counts_violations(spark, panel_of):
    fact = panel_of([{"iso_code": "A", "date": "2021-01-01"}] * 2 + [{"iso_code": "Z", "date": "2021-01-05"}])
    dim = spark.sql("select 'A' iso_code, cast(null as string) location")
    dates = star.dim_date(fact.where("iso_code = 'A'"))
    got = {r.rule: r.violations for r in Q.constraint_report(fact, dim, dates).collect()}
    bad = {k: v for k, v in got.items() if v}
    assert bad == {"fact_key_repeated": 1, "fact_entity_unknown": 1, "fact_date_unknown": 1,
                   "entity_label_missing": 1}


def test_key_report_scans_each_table_once(spark, panel_of):
    fact = panel_of(
        [{"iso_code": "A", "date": "2021-01-01"}] * 3 + [{"iso_code": "A", "date": "2021-01-02"}] * 2
        + [{"iso_code": None, "date": "2021-01-01"}, {"iso_code": None, "date": None}]
        + [{"iso_code": "Z", "date": "2021-01-05"}] * 4, "new_cases",
    )
    dim = spark.sql("select * from values ('A', null), ('B', 'b'), ('B', 'c'), (null, 'n') t(iso_code, location)")
    dates = star.dim_date(fact.where("iso_code = 'A'")).unionByName(spark.sql(
        "select date'2021-01-01', int(null), 9, 13, 'x', 1, 8, 'x', 1")
        .toDF(*star.dim_date(fact).columns))
    stored = [spark.read.parquet(io.write(t, fresh_path(spark, n))) for n, t in
              (("thefact", fact), ("thedim", dim), ("thedates", dates))]
    report = Q.constraint_report(*stored)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert [plan.count(f"/{n}-") for n in ("thefact", "thedim", "thedates")] == [1, 1, 1]
    got = {r.rule: r.violations for r in report.collect()}
    assert got == {
        "fact_key_repeated": 3, "entity_key_repeated": 1, "date_key_repeated": 1,
        "fact_entity_unknown": 6, "fact_date_unknown": 5, "fact_entity_missing": 2,
        "fact_date_missing": 1, "entity_label_missing": 1, "date_quarter_range": 1,
        "date_month_range": 1, "date_day_of_week_range": 1, "date_year_missing": 1,
    }
    empty = Q.constraint_report(*[t.limit(0) for t in stored])
    assert {r.violations for r in empty.collect()} == {0}


def test_raw_read_reports_absent_columns(spark, raw):
    path = io.write(raw.drop("icu_patients"), fresh_path(spark, "t"), "csv")
    got = io.read_raw(spark, path)
    assert got.missing == ("icu_patients",)
    assert got.frame.count() == raw.count()
    assert "icu_patients" not in clean(got.frame).columns


def test_raw_columns_go_by_name_in_every_file(spark):
    """Files with three orders of columns, one of them short, one empty, one packed."""
    folder = fresh_path(spark, "t")
    order = ["iso_code", "date", "location", "new_cases", "new_deaths"]
    rows = [("A", "2021-01-0%d", "Land, \"A\"", str(10 * i), str(i)) for i in range(1, 5)]
    for i, columns in enumerate([order, order[:3] + ["new_deaths", "new_cases"],
                                 ["extra", *reversed(order)], order[:4]], 1):
        frame = spark.createDataFrame([(r[0], r[1] % i, *r[2:]) for r in rows[i - 1:i]], order)
        frame.withColumn("extra", F.lit("x")).select(*columns).write.mode("append").option(
            "header", True).option("compression", "gzip" if i == 3 else "none").csv(folder)
    spark.createDataFrame([], "iso_code string").coalesce(1).write.mode("append").csv(folder)
    got = io.read_raw(spark, folder)
    assert sorted(map(tuple, got.frame.select(*order).collect())) == [
        ("A", f"2021-01-0{i}", "Land, \"A\"", str(10 * i), None if i == 4 else str(i)) for i in range(1, 5)]
    assert len(got.groups) == 4 and "new_deaths" not in got.missing and "icu_patients" in got.missing
    assert [g.missing for g in got.groups if len(g.header) == 4][0][:1] != () and any(
        "new_deaths" in g.missing for g in got.groups)


def test_insert_new_skips_known_keys_and_repeats(spark):
    target = fresh_path(spark, "t")
    first = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    io.insert_new(first, target, ["k"])
    assert io.read_inserted(spark, target).count() == 2
    io.insert_new(spark.createDataFrame([(2, "x"), (3, "d")], "k int, v string"), target, ["k"])
    got = {r.k: r.v for r in io.read_inserted(spark, target).collect()}
    assert set(got) == {1, 2, 3} and got[2] == "c"


def test_load_staging_replaces_and_counts(spark):
    path = fresh_path(spark, "t")
    assert io.load_staging(spark.range(7), path) == 7
    assert io.load_staging(spark.range(3), path) == 3
    assert spark.read.parquet(path).schema["id"].dataType.simpleString() == "string"
    assert spark.read.parquet(path).count() == 3


def test_table_wins_over_files(spark):
    spark.range(2).createOrReplaceTempView("some_panel")
    path = io.write(spark.range(5), fresh_path(spark, "t"))
    assert io.load_panel(spark, "some_panel", path).count() == 2
    assert io.load_panel(spark, "absent_panel", path, schema=spark.range(1).schema).count() == 5


def test_a_failing_view_does_not_stop_the_export(spark):
    def broken():
        raise ValueError("no")

    out = fresh_path(spark, "t")
    status = io.export_views({"bad": broken, "good": lambda: spark.range(3)}, out)
    assert status["good"] == "ok" and status["bad"].startswith("failed")
    assert spark.read.option("header", True).csv(f"{out}/good").count() == 3


def test_views_of_the_shared_tables_equal_their_own(spark, raw):
    """Exports read one snapshot and one rollup; five scans of the fact and no more."""
    from tidemark.operators import views
    from tidemark.plans.stages import view_builders

    source, out = io.write(raw, fresh_path(spark, "t"), "csv"), fresh_path(spark, "t")
    assert run_stages(spark, source, out, Settings(focus="E03", distance=5, least=2)).exit_code == 0
    fact, dim, dates = (spark.read.parquet(f"{out}/{n}") for n in ("fact", "dim_entity", "dim_date"))
    built = {n: b() for n, b in view_builders(fact, dim, dates, "E03", 1000).items()}
    scans = {n: b._jdf.queryExecution().executedPlan().toString().count(f"{out}/fact]") for n, b in built.items()}
    assert scans == dict.fromkeys(built, 0) | {
        "v_global_daily_trend": 1, "v_entity_timeline": 1, "v_coverage_progress": 1}, scans
    own = {
        "v_continental_summary": views.continental_summary(fact, dim),
        "v_country_latest": views.country_latest(fact, dim),
        "v_monthly_by_group": views.monthly_by_group(fact, dim),
        "v_coverage_progress": views.coverage_progress(fact, dim),
        "v_high_risk": views.high_risk(fact, dim, 1000),
        "v_wave_summary": views.wave_summary(fact, dim, 1000),
    }
    for name, alone in own.items():
        assert list(map(str, built[name].collect())) == list(map(str, alone.collect())), name


def test_whole_run(spark, raw):
    source = io.write(raw, fresh_path(spark, "t"), "csv")
    out = fresh_path(spark, "t")
    done = run_stages(spark, source, out, Settings(focus="E03", distance=5, least=2))
    assert done.exit_code == 0, done.status
    fact = spark.read.parquet(f"{out}/fact")
    assert fact.count() == 14 * 90
    assert fact.agg(F.max("wave_number")).first()[0] > 1
    assert spark.read.parquet(f"{out}/constraints").agg(F.sum("violations")).first()[0] == 0
    assert spark.read.parquet(f"{out}/reconciliation").first().within_tolerance
    assert spark.read.parquet(f"{out}/risk").count() == 14
    assert spark.read.parquet(f"{out}/focus").count() == 90


def test_reruns_of_single_stages_keep_the_waves(spark, raw):
    source, out = io.write(raw, fresh_path(spark, "t"), "csv"), fresh_path(spark, "t")

    def run(*stages):
        return run_stages(
            spark, source, out, Settings(focus="E03", distance=5, least=2, stages=stages)
        )

    def state():
        views = spark.read.option("header", True).csv(f"{out}/views/v_wave_summary").collect()
        rows = spark.read.parquet(f"{out}/fact").collect()
        return sorted(map(str, rows)), sorted(map(str, views))

    assert run("clean", "analyse", "star", "validate", "export").exit_code == 0
    whole = state()
    assert any("wave_number=" in r and "wave_number=None" not in r for r in whole[0]) and whole[1]
    for stages in (("star", "export"), ("analyse",), ("validate",), ("export",), ("star",)):
        assert run(*stages).exit_code == 0
        assert state() == whole
    renewed = run("clean", "star")
    assert renewed.exit_code == 0 and state() == whole  # cleaned to the same rows as before
    nothing = run_stages(spark, source, fresh_path(spark, "t"), Settings(stages=("star",)))
    assert nothing.exit_code == 1


def test_stages_refuse_tables_of_another_run(spark, raw):
    """A full run on one file, cleaning of another, then the later stages alone."""
    first = io.write(raw.where("location <> 'Land 3'"), fresh_path(spark, "t"), "csv")
    second, out = io.write(raw, fresh_path(spark, "t"), "csv"), fresh_path(spark, "t")

    def run(source, *stages):
        return run_stages(spark, source, out, Settings(focus="E04", distance=5, least=2, stages=stages))

    def rows(name):
        return spark.read.parquet(f"{out}/{name}").count()

    assert run(first, *STAGES).exit_code == 0 and rows("fact") == 13 * 90
    assert run(second, "clean").exit_code == 0
    late = run(second, "star", "validate", "export")
    assert late.exit_code == 1
    assert "another panel" in late.status["star"] and "analyse" in late.status["star"]
    assert "another panel" in late.status["validate"] and "another panel" in late.status["export"]
    assert rows("fact") == 13 * 90  # untouched
    again = run(second, "analyse", "star", "validate", "export")
    assert again.exit_code == 0, again.status
    assert rows("fact") == 14 * 90
    # The same rows again: nothing that follows becomes stale.
    assert run(second, "clean").exit_code == 0 and run(second, "validate", "export").exit_code == 0


def test_a_stage_killed_while_writing_leaves_no_table_to_read(spark, raw, monkeypatch):
    source, out = io.write(raw, fresh_path(spark, "t"), "csv"), fresh_path(spark, "t")
    settings = dict(focus="E03", distance=5, least=2)
    assert run_stages(spark, source, out, Settings(**settings)).exit_code == 0
    real = commits.put_json

    def dies(session, path, *rest, **more):
        if path.endswith("waves.json"):
            raise OSError("killed")
        return real(session, path, *rest, **more)

    with monkeypatch.context() as m:
        m.setattr(commits, "put_json", dies)
        broken = run_stages(spark, source, out, Settings(**settings, stages=("analyse", "star")))
    assert "killed" in broken.status["analyse"] and "no finished waves" in broken.status["star"]
    assert run_stages(spark, source, out, Settings(**settings, stages=("star",))).exit_code == 1
    done = run_stages(spark, source, out, Settings(**settings, stages=STAGES[1:]))
    assert done.exit_code == 0, done.status
    # Something else overwrites a table: refused as well.
    spark.range(3).write.mode("overwrite").parquet(f"{out}/fact")
    foreign = run_stages(spark, source, out, Settings(**settings, stages=("validate",)))
    assert "not what its stage wrote" in foreign.status["validate"]


def test_an_input_that_changes_meanwhile_is_noticed(spark):
    hand = Handover(spark, fresh_path(spark, "t"))
    hand.save("a", spark.range(5))
    moved = spark.range(7)

    class Changing:
        """Replaces ``a`` when the derived rows are asked for."""
        columns, schema = moved.columns, moved.schema

        def observe(self, *args):
            hand.save("a", spark.range(6))
            return moved.observe(*args)

    with pytest.raises(StaleTable, match="changed while"):
        hand.save("b", Changing(), ("a",))
    assert hand.manifest("b") is None
    hand.save("b", moved, ("a",))
    assert hand.read("b").count() == 7 and hand.manifest("b")["rows"] == 7


def test_two_labels_of_one_entity_still_give_one_row_a_day(spark, raw):
    twice = raw.where("location = 'Land 3'").withColumn("location", F.lit("Other"))
    source, out = io.write(raw.unionByName(twice), fresh_path(spark, "t"), "csv"), fresh_path(spark, "t")
    assert run_stages(spark, source, out, Settings(distance=5, least=2)).exit_code == 0
    assert spark.read.parquet(f"{out}/fact").count() == 14 * 90


def test_bucket_counts_stay_under_the_engine_limit(spark):
    from tidemark.plans.warehouse import MOST_BUCKETS, bucket_count

    counts = [bucket_count(spark, 10**k) for k in range(14)] + [bucket_count(spark, int(2.5e12))]
    assert counts == sorted(counts) or max(counts) == MOST_BUCKETS
    assert max(counts) <= MOST_BUCKETS < 100_000 and bucket_count(spark, 10**9) == 1000


def test_rounding_keeps_what_it_cannot_round(spark):
    from tidemark.plans.catalog import relative, stable

    values = [float("nan"), float("inf"), -float("inf"), 1e13, -1e300, 1.23456789, 1e-9, None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.v for r in stable(rows).orderBy("i").collect()]
    assert str(got[0]) == "nan" and got[1:3] == values[1:3] and got[5:] == [1.234568, 0.0, None]
    assert got[3] == 1e13 and got[4] == pytest.approx(-1e300)
    tiny = spark.range(1).select(relative(F.lit(1.23456789e-12)).alias("p")).first().p
    assert tiny == 1.234568e-12


def test_failed_cleaning_stops_and_stages_can_be_skipped(spark):
    gone = run_stages(spark, "/no/such/file.csv", fresh_path(spark, "t"))
    assert gone.exit_code == 1 and list(gone.status) == ["clean"]
    none = run_stages(spark, "", fresh_path(spark, "t"), Settings(stages=()))
    assert none.exit_code == 0 and set(none.status.values()) == {"skipped"}
