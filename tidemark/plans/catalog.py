"""Registered queries: every operator applied to the derived panel's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import exprs as E
from tidemark.operators import clean as C, datasets as G, quality as Q, reports as R
from tidemark.operators import star, stats as S, views as V, waves
from tidemark.operators.panel import (
    day_number, fill_forward, latest_row, latest_values, nearest_date, rolling_mean,
)
from tidemark.operators.windows import over_windows
from tidemark.plans.derived import as_text
from tidemark.plans.stages import Settings, run_stages, view_builders
from tidemark.plans.warehouse import Warehouse, open_warehouse
from tidemark.sources import io
from tidemark.sources.shared import fresh_path, materialise
from tidemark.spec import CORRELATION_METRICS, CUMULATIVE, DAILY, KEY_COLUMNS, NUMERIC, panel_schema

# Parameters suited to the derived panel; the operators' defaults suit the epidemic data.
FOCUS, FOCUS_LABEL = "S0", "Supplier#000000000"
COMPARED = ("S0", "S1", "S2", "S3", "S4")
LABELS = tuple(f"Supplier#{i:09d}" for i in range(4))
SINCE = "1998-01-01"
MIN_POP = 470
MIN_CASES = 590
LEVELS = (25, 50, 60)
TIERS = ((60, "High"), (57, "Medium"), (54, "Low"))
TIER_REST = "Very Low"
TESTED = ((0.02, "Adequate"), (0.05, "Moderate"))
TESTED_REST = "Under-tested"
DISTANCE, PROMINENCE = 30, 0.8
WINDOW = (25, 75)
WANTED_DATES = ("1996-02-29", "1997-07-15", "1999-12-31")
PEAK_WINDOWS = (("First", "1996-01-01", "1997-12-31"), ("Second", "1999-01-01", "2000-06-30"))
WAVE_BANDS = ((1, "1996-01-01", "1997-06-30"), (2, "1997-07-01", "1999-12-31"))
GROUP = "ASIA"
PAIR = ("vaccination_rate", "case_fatality_rate")
POINTS = ("iso_code", "continent", "population", *PAIR)
PEAK_STEP = 10**10  # more than there are days
# CSV with a line for every entity and day; a higher level takes longer than writing the lines does.
PACKED = {"compression": "gzip", "level": "BEST_SPEED"}

Query = Callable[[Warehouse], DataFrame]
_queries: dict[str, Query] = {}


# Queries that only pass values through: nothing is rounded.
EXACT = frozenset({
    "read_raw_panel", "read_typed", "entity_slice", "write_panel", "reload", "cast_numeric",
    "table_or_file", "load_staging", "insert_new_rows",
})


def query(key: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        _queries[key] = build
        return build
    return register


def relative(value: Column, digits: int = 7) -> Column:
    """A double at so many significant digits, however small it is."""
    return F.format_string(f"%.{digits - 1}e", value).cast("double")


def stable(df: DataFrame, keep: tuple[str, ...] = ("p_value",)) -> DataFrame:
    """Computed doubles to six decimals, so that the order of summation does not show.

    Values too large for decimals, NaN and infinities stay as they are, and so do the columns in
    ``keep``, which their queries settle by significant digits.
    """
    def settled(name: str) -> Column:
        scaled = F.col(name) * 1e6 + 0.5
        whole = F.floor(scaled).cast("double") / 1e6
        return F.when(F.abs(scaled) < 2.0**52, whole).otherwise(F.col(name)).alias(name)

    return df.select(*[
        settled(f.name) if f.dataType.typeName() == "double" and f.name not in keep
        else F.col(f.name) for f in df.schema.fields
    ])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(key: str, build: Query) -> Callable[[SparkSession, str], DataFrame]:
        shown = (lambda df: df) if key in EXACT else stable
        return lambda spark, folder: shown(build(open_warehouse(spark, folder)))

    return {key: bound(key, build) for key, build in _queries.items()}


# --- sources and sinks -------------------------------------------------------------------------

def _csv(w: Warehouse) -> str:
    # The writer makes the text of ``as_text`` itself.
    return io.write(w.raw, fresh_path(w.tables.spark, "raw"), "csv", **PACKED)


@query("read_raw_panel")
def _(w):
    return C.cast_numeric(io.read_raw(w.tables.spark, _csv(w)).frame, NUMERIC)


@query("read_typed")
def _(w):
    path = io.write(w.panel, fresh_path(w.tables.spark, "typed"))
    return io.read_panel(w.tables.spark, path, schema=panel_schema())


@query("entity_slice")
def _(w):
    return io.slice_entity(w.panel, FOCUS_LABEL)


@query("table_or_file")
def _(w):
    """Rows of either branch: a catalog table that exists, and files where none does."""
    spark = w.tables.spark
    path = io.write(w.fact, fresh_path(spark, "fact_files"))
    w.fact.createOrReplaceTempView("fact_by_name")
    both = None
    for branch, table in (("table", "fact_by_name"), ("file", "no_such_table")):
        loaded = io.load_panel(spark, table, path, schema=w.fact.schema).select(
            F.lit(branch).alias("branch"), "iso_code", "date", "new_cases", "vaccination_rate"
        )
        both = loaded if both is None else both.unionByName(loaded)
    return both


@query("write_panel")
def _(w):
    spark = w.tables.spark
    path = io.write(w.panel, fresh_path(spark, "panel_csv"), "csv", **PACKED)
    return io.read_panel(spark, path, "csv")


@query("load_staging")
def _(w):
    """What the staging table holds, all of it text, with the counted rows."""
    path = fresh_path(w.tables.spark, "staging")
    count = io.load_staging(w.fact, path)
    staged = w.tables.spark.read.parquet(path)
    return staged.select(
        "iso_code", "date", "total_cases", "new_deaths", F.lit(count).cast("bigint").alias("rows")
    )


@query("insert_new_rows")
def _(w):
    spark = w.tables.spark
    target = fresh_path(spark, "inserted")
    columns = ["iso_code", "date", "new_cases"]
    early = w.days.where(F.col("date") < SINCE).select(*columns)
    io.insert_new(early, target, ["iso_code", "date"])
    io.insert_new(w.days.select(*columns), target, ["iso_code", "date"])
    return io.read_inserted(spark, target)


@query("reload")
def _(w):
    target = fresh_path(w.tables.spark, "reloaded")
    io.reload(w.entities.select("iso_code"), target)
    io.reload(w.entities, target)
    return w.tables.spark.read.parquet(target)


def _counts(spark: SparkSession, folder: str, names: list[str], fmt: str) -> DataFrame:
    """Rows of each written table, as one frame."""
    out = None
    for name in names:
        reader = spark.read.option("header", True).format(fmt)
        one = reader.load(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("rows"))
        one = one.select(F.lit(name).alias("name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("export_views")
def _(w):
    spark = w.tables.spark
    out = fresh_path(spark, "exports")
    builders = view_builders(w.fact, w.entities, w.dates, FOCUS, MIN_POP)
    status = io.export_views(builders, out)
    return _counts(spark, out, [n for n, s in status.items() if s == "ok"], "csv")


#: The exported views: the columns that name a row, and those whose figures are compared.
EXPORT_CELLS = {
    "v_global_daily_trend": (("date",), (
        "global_new_cases", "global_new_deaths", "avg_smoothed_cases", "avg_smoothed_deaths",
        "avg_reproduction_rate", "avg_stringency_index")),
    "v_continental_summary": (("continent",), (
        "country_count", "total_cases", "total_deaths", "total_population", "cases_per_million",
        "deaths_per_million", "cfr_pct", "avg_vaccination_rate_pct")),
    "v_country_latest": (("iso_code", "latest_date"), (
        "population", "gdp_per_capita", "total_cases", "total_deaths", "total_vaccinations",
        "people_fully_vaccinated", "total_cases_per_million", "cfr_pct", "vaccination_rate_pct",
        "mortality_rate_per_million", "rolling_7day_cases", "rolling_7day_deaths")),
    "v_entity_timeline": (("date", "month_name"), (
        "new_cases", "new_deaths", "new_cases_smoothed", "total_cases", "vaccination_rate_pct",
        "cfr_pct", "rolling_7day_cases", "rolling_14day_cases", "wave_number", "reproduction_rate",
        "quarter")),
    "v_monthly_by_group": (("year", "month", "continent", "month_label"), (
        "monthly_new_cases", "monthly_new_deaths", "avg_7day_cases")),
    "v_coverage_progress": (("iso_code", "location", "date"), (
        "vaccination_rate_pct", "people_fully_vaccinated")),
    "v_high_risk": (("location", "continent"), (
        "risk_rank", "population", "cases_per_million", "deaths_per_million",
        "vaccination_rate_pct", "cfr_pct", "composite_risk_score")),
    "v_wave_summary": (("location", "continent", "wave_number", "wave_start", "wave_end"), (
        "wave_duration_days", "peak_smoothed_daily_cases", "total_new_cases_in_wave",
        "total_new_deaths_in_wave", "wave_cfr_pct")),
}


@query("export_contents")
def _(w):
    """The figures of the exported files, read back from their text: view, row, cell and value."""
    spark = w.tables.spark
    out = fresh_path(spark, "exports")
    status = io.export_views(view_builders(w.fact, w.entities, w.dates, FOCUS, MIN_POP), out)
    cells = None
    for name, (keys, numbers) in EXPORT_CELLS.items():
        if status[name] != "ok":
            raise RuntimeError(status[name])
        text = spark.read.option("header", True).csv(f"{out}/{name}")
        part = text.select(
            F.lit(name).alias("view"), F.concat_ws("|", *keys).alias("row"),
            *[F.col(c).cast("double").alias(c) for c in numbers],
        ).unpivot(["view", "row"], list(numbers), "cell", "value").where("value is not null")
        cells = part if cells is None else cells.unionByName(part)
    return cells


_runs: dict[tuple[str, str], tuple[str, list[str]]] = {}


def _run(w: Warehouse) -> tuple[str, list[str]]:
    """Folder and tables of the whole job over a warehouse's raw panel, run once per application."""
    spark = w.tables.spark
    key = (spark.sparkContext.applicationId, w.tables.folder)
    if key not in _runs:
        out = fresh_path(spark, "run")
        settings = Settings(focus=FOCUS, distance=DISTANCE, least=PROMINENCE, min_pop=MIN_POP)
        outcome = run_stages(spark, _csv(w), out, settings)
        if outcome.exit_code:
            raise RuntimeError(str(outcome.status))
        _runs[key] = (out, sorted(outcome.tables))
    return _runs[key]


@query("full_run")
def _(w):
    out, names = _run(w)
    return _counts(w.tables.spark, out, names, "parquet")


@query("full_run_risk")
def _(w):
    return w.tables.spark.read.parquet(f"{_run(w)[0]}/risk")


@query("full_run_waves")
def _(w):
    """The exported wave view of the job, read back with the view's own types."""
    read, out = w.tables.spark.read, _run(w)[0]
    fact, entities = read.parquet(f"{out}/fact"), read.parquet(f"{out}/dim_entity")
    kinds = V.wave_summary(fact, entities, MIN_POP).schema
    text = w.tables.spark.read.option("header", True).csv(f"{out}/views/v_wave_summary")
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds])


# --- cleaning ----------------------------------------------------------------------------------

@query("drop_aggregate_rows")
def _(w):
    return C.drop_aggregate_rows(w.raw).select(*KEY_COLUMNS)


@query("parse_dates")
def _(w):
    return C.parse_dates(as_text(w.raw).select(*KEY_COLUMNS, "new_cases"))


@query("sort_panel")
def _(w):
    return C.sort_panel(w.panel.select("location", "date", "new_cases"))


@query("cast_numeric")
def _(w):
    return C.cast_numeric(as_text(w.raw), NUMERIC)


@query("ffill_cumulative")
def _(w):
    raw = C.drop_aggregate_rows(w.raw).select("location", "date", *CUMULATIVE)
    return fill_forward(raw, list(CUMULATIVE), "location")


@query("zero_fill_daily")
def _(w):
    return C.zero_fill(w.raw.select("iso_code", "date", *DAILY), DAILY)


def _rate(column: Callable[[], Column]) -> Query:
    return lambda w: w.panel.select("iso_code", "date", column().alias("value"))


query("case_fatality_rate")(_rate(E.case_fatality_rate))
query("vaccination_rate")(_rate(E.vaccination_rate))
query("tests_per_case")(_rate(E.tests_per_case))
query("mortality_per_million")(_rate(lambda: E.per_million("total_deaths")))


@query("rolling_7_14")
def _(w):
    panel = w.panel.select("iso_code", "date", "new_cases", "new_deaths")
    for rows in (7, 14):
        panel = rolling_mean(
            panel, {"new_cases": f"cases_{rows}", "new_deaths": f"deaths_{rows}"}, rows, "iso_code"
        )
    return panel


@query("date_parts")
def _(w):
    return C.date_parts(w.panel.select("iso_code", "date"))


@query("derive_smoothed")
def _(w):
    panel = w.panel.select("iso_code", "location", "date", "new_cases")
    return C.ensure_smoothed(panel, "new_cases", "new_cases_smoothed")


@query("per_million_fallback")
def _(w):
    columns = ["location", "total_cases", "total_deaths", "population"]
    return C.ensure_per_million(w.known(*columns[1:]).select(*columns))


@query("clip_floor")
def _(w):
    change = F.col("new_cases") - F.col("rolling_7day_cases")
    return w.panel.select("iso_code", "date", E.clip_floor(change).alias("above_average"))


@query("clean_panel")
def _(w):
    return C.clean(as_text(w.raw))


@query("recovery_rate")
def _(w):
    rate = E.recovery_rate(F.col("total_deaths"), F.col("total_cases"))
    dax = E.recovery_rate(F.col("total_deaths"), F.col("total_cases"), alternate=0)
    return w.days.select("iso_code", "date", rate.alias("recovery"), dax.alias("recovery_or_100"))


@query("is_focus_flag")
def _(w):
    return w.entities.select("iso_code", E.focus_flag("location", FOCUS_LABEL).alias("flag"))


@query("percent_if_fraction")
def _(w):
    known = w.known("case_fatality_rate", "human_development_index")
    rows = E.percent_if_all_fractions(known, "case_fatality_rate", "by_column")
    guess = E.percent_if_fraction(F.col("human_development_index"))
    return rows.select("location", "by_column", guess.alias("by_value"))


@query("log_weight")
def _(w):
    rows = E.linear_weight(w.entities, "population", "continent", "linear")
    people = F.col("population") * 1000
    return rows.select("iso_code", E.log_weight(people).alias("log"), "linear")


# --- star schema and quality -------------------------------------------------------------------

query("dim_entity")(lambda w: star.dim_entity(w.panel))
query("dim_entity_last_known")(lambda w: star.dim_entity(w.panel, last_known=True))
query("dim_date")(lambda w: star.dim_date(w.panel))
query("fact_daily")(
    lambda w: star.fact_daily(
        waves.label_waves(w.panel, w.peaks, unique=w.unique), unique=w.unique
    )
)
query("latest_row")(lambda w: latest_row(w.fact))
query("latest_values")(lambda w: latest_values(w.panel))
query("check_ranges")(lambda w: Q.sanity_counts(w.panel))
query("check_row_counts")(lambda w: Q.reconcile(w.panel, w.fact))
query("check_keys")(lambda w: Q.constraint_report(w.fact, w.entities, w.dates))
query("dataset_summary")(lambda w: Q.summary(w.panel))
query("missing_profile")(lambda w: Q.missing_profile(w.panel))
query("missing_by_month")(lambda w: Q.missing_by_month(w.panel))


@query("bi_calendar")
def _(w):
    return star.bi_calendar(w.dates)


# --- views -------------------------------------------------------------------------------------

query("v_global_daily_trend")(lambda w: V.global_daily_trend(w.days))
query("v_continental_summary")(lambda w: V.continental_summary(w.days, w.entities))
query("v_country_latest")(lambda w: V.country_latest(w.days, w.entities))
query("v_entity_timeline")(lambda w: V.entity_timeline(w.fact, w.dates, FOCUS))
query("v_monthly_by_group")(lambda w: V.monthly_by_group(w.days, w.entities))
query("v_coverage_progress")(lambda w: V.coverage_progress(w.days, w.entities))
query("v_coverage_progress_literal")(
    lambda w: V.coverage_progress(w.days, w.entities, literal=True)
)
query("v_high_risk")(lambda w: V.high_risk(w.days, w.entities, MIN_POP))
query("v_wave_summary")(lambda w: V.wave_summary(w.fact, w.entities, MIN_POP))

# --- reports -----------------------------------------------------------------------------------

query("snapshot_max")(lambda w: R.snapshot(w.days, "max"))
query("snapshot_sum")(lambda w: R.snapshot(w.days, "sum"))
query("group_breakdown")(lambda w: R.group_breakdown(w.days, w.entities))
query("global_monthly")(lambda w: R.global_monthly(w.days))
query("entity_ranks")(lambda w: R.entity_ranks(w.days, w.entities))
query("day_growth")(lambda w: R.day_growth(w.days, COMPARED, SINCE))
query("rolling_check")(lambda w: R.rolling_check(w.days, FOCUS))
query("peak_day")(lambda w: R.peak_day(w.days, w.entities, MIN_POP))
query("top_cfr")(lambda w: R.top_cfr(w.days, w.entities, MIN_POP, MIN_CASES))
query("milestones")(lambda w: R.milestones(w.days, w.entities, LEVELS))
query("top3_per_group")(lambda w: R.top_per_group(w.days, w.entities, 3, MIN_POP))
query("entity_monthly")(lambda w: R.entity_monthly(w.days, FOCUS))
query("entity_monthly_eom")(lambda w: R.entity_monthly(w.days, FOCUS, eom=True))
query("focus_vs_average")(lambda w: R.focus_vs_average(w.days, FOCUS, FOCUS_LABEL))
query("wave_periods")(lambda w: R.wave_periods(w.fact, FOCUS))
query("coverage_tiers")(
    lambda w: R.coverage_tiers(w.days, w.entities, TIERS, TIER_REST, MIN_POP)
)
query("above_below_average")(lambda w: R.above_below(w.days, w.entities, MIN_POP))
query("pandemic_timeline")(lambda w: R.timeline(w.days, w.entities))
query("testing_adequacy")(
    lambda w: R.testing_adequacy(w.days, w.entities, TESTED, TESTED_REST, MIN_POP)
)

# --- statistics --------------------------------------------------------------------------------

query("detect_peaks")(lambda w: waves.detect_peaks(w.panel, distance=DISTANCE, least=PROMINENCE))


@query("label_waves")
def _(w):
    panel = w.panel.select("iso_code", "date", "new_cases_smoothed")
    peaks = waves.detect_peaks(panel, distance=2 * DISTANCE, least=PROMINENCE)
    return waves.label_waves(panel, peaks, unique=w.unique).drop("new_cases_smoothed")


query("correlation_matrix")(lambda w: S.correlation_matrix(w.known(*CORRELATION_METRICS)))


def _tested(method: str) -> Query:
    return lambda w: S.correlation_test(
        w.known(*PAIR), *PAIR, method
    ).withColumn("p_value", relative(F.col("p_value")))


query("pearson_test")(_tested("pearson"))
query("spearman_test")(_tested("spearman"))


@query("min_max")
def _(w):
    columns = ("vaccination_rate", "case_fatality_rate", "gdp_per_capita")
    rows = materialise(w.known(*columns))
    rows = S.min_max(rows, {c: f"scaled_{c}" for c in columns})
    return rows.select("location", *[f"scaled_{c}" for c in columns])


query("risk_scores")(lambda w: S.risk_scores(w.summary))
query("risk_scores_sql")(lambda w: V.high_risk(w.days, w.entities, MIN_POP))


@query("risk_weighted")
def _(w):
    return S.risk_weighted(w.known(*PAIR, "total_deaths_per_million")).select("location", "composite_risk_score")


query("ols_trend")(
    lambda w: S.ols_trend(w.known(*PAIR), *PAIR, 100)
)


@query("quantile_trim")
def _(w):
    rows = S.quantile_trim(w.known(*PAIR), *PAIR)
    return rows.select("location", "vaccination_rate", "case_fatality_rate")


# --- chart and BI datasets ---------------------------------------------------------------------

query("trend_filtered")(lambda w: G.trend(w.panel, GROUP, WINDOW))
query("trend_all")(lambda w: G.trend(w.panel))
query("percent_window")(lambda w: G.percent_window_dates(w.panel, *WINDOW))
query("metric_series")(lambda w: G.metric_series(w.panel, FOCUS_LABEL, "new_cases"))
query("wave_extent")(lambda w: G.wave_extent(w.fact.where(F.col("iso_code") == FOCUS)))
@query("wave_extent_unlabelled")
def _(w):
    """The fixed windows that a series without labels gets, with the focus's cases in each."""
    series = w.days.where(F.col("iso_code") == FOCUS).select("date", "new_cases")
    bands = G.wave_extent(series, WAVE_BANDS)
    return over_windows(series, bands, {"cases": F.sum("new_cases")}, {"cases": F.sum})


@query("quarter_windows")
def _(w):
    """Cases and peak of every entity in every window of 92 days that starts with a month."""
    windows = w.days.where(F.dayofmonth("date") == 1).select(
        "iso_code", F.col("date").alias("start_date"), F.date_add("date", 91).alias("end_date")
    )
    series = w.days.select("iso_code", "date", "new_cases").where("new_cases is not null")
    # The peak and how early it is as one number: unlike a struct it is kept without sorting rows.
    high = F.col("new_cases").cast("decimal(20,0)") * F.lit(PEAK_STEP).cast("decimal(11,0)")
    peak = F.max((high - day_number("date") - F.lit(PEAK_STEP // 2)).cast("decimal(38,0)"))
    found = over_windows(
        series, windows, {"cases": F.sum("new_cases"), "peak": peak},
        {"cases": F.sum, "peak": F.max}, by=("iso_code",),
    )
    late = F.pmod(-F.col("peak"), F.lit(PEAK_STEP).cast("decimal(38,0)"))
    return found.select(
        "iso_code", "start_date", "end_date", "cases",
        F.call_function("div", F.col("peak") + late, F.lit(PEAK_STEP).cast("decimal(11,0)")).alias("peak_value"),
        F.date_from_unix_date((late - F.lit(PEAK_STEP // 2)).cast("int")).alias("peak_date"),
    )


query("peak_in_window")(
    lambda w: G.peak_in_window(
        w.days.where(F.col("iso_code") == FOCUS), "new_cases", PEAK_WINDOWS
    )
)
query("top_n_metric")(lambda w: G.top_n(w.summary, "total_cases_per_million"))
query("scatter_coverage_cfr")(lambda w: G.coverage_vs_cfr(w.known(*POINTS), FOCUS))
query("scatter_coverage_cfr_group")(lambda w: G.coverage_vs_cfr(w.known(*POINTS), FOCUS, GROUP))
query("scatter_coverage_cfr_trimmed")(
    lambda w: G.coverage_vs_cfr_trimmed(w.known(*POINTS), FOCUS_LABEL)
)
query("scatter_trend")(lambda w: G.coverage_trend(w.known("continent", *PAIR)))
query("scatter_trend_group")(lambda w: G.coverage_trend(w.known("continent", *PAIR), GROUP))
query("scatter_trend_trimmed")(lambda w: G.coverage_trend_trimmed(w.known(*PAIR)))
query("kpi_cards")(lambda w: G.kpi_cards(w.panel, WINDOW))
query("global_daily_rolling")(lambda w: G.global_daily(w.panel))
query("global_totals")(lambda w: G.global_totals(w.panel))
query("wave_boundaries")(lambda w: G.wave_intervals(w.panel, w.peaks))


@query("nearest_date")
def _(w):
    """Asked of every entity: the observed day (with cases) nearest to each wanted date."""
    seen = w.raw.where(F.col("new_cases").isNotNull() & ~F.col("iso_code").startswith("OWID_"))
    wanted = F.explode(F.array(*[F.lit(d) for d in WANTED_DATES])).alias("text")
    dates = w.entities.select("iso_code", wanted).select(
        "iso_code", F.try_to_date("text").alias("wanted_date")
    ).where(F.col("wanted_date").isNotNull())
    return nearest_date(seen.select("iso_code", "date", "new_cases"), dates)


query("benchmark_compare")(lambda w: G.benchmark(w.panel, LABELS))
query("radar_normalised")(lambda w: G.radar(G.benchmark(w.panel, LABELS)))
query("top_risk")(lambda w: G.top_risk(S.risk_scores(w.summary)))
query("focus_vs_benchmarks")(lambda w: G.compare_series(w.panel, LABELS, "new_cases_smoothed"))
query("map_metric")(lambda w: G.map_metric(w.days, w.entities, "vaccination_rate"))
query("group_by_month_stack")(lambda w: G.monthly_stack(w.panel))
query("group_share")(lambda w: G.group_share(w.days, w.entities))
query("top_n_entities")(lambda w: G.top_entities(w.days, w.entities, 10, "deaths"))
query("entity_kpis")(lambda w: G.entity_kpis(w.days, FOCUS))
query("vaccination_progress_focus")(lambda w: G.vaccination_series(w.days, FOCUS))
query("month_heatmap")(lambda w: G.month_heatmap(w.days, FOCUS))
query("weekly_growth")(lambda w: G.weekly_growth(w.days))
query("growth_heatmap")(lambda w: G.growth_heatmap(w.days, "new_cases"))
query("mom_growth")(lambda w: G.mom_growth(w.days))
query("mom_growth_by_entity")(lambda w: G.mom_growth(w.panel, by="location"))
query("calendar_7d_avg")(lambda w: G.calendar_avg(w.days))


@query("calendar_7d_avg_by_entity")
def _(w):
    """Over reported days only, so the calendar frame and a row frame differ."""
    seen = w.raw.where(F.col("new_cases").isNotNull())
    return G.calendar_avg(seen, by="iso_code")


query("window_avg_7")(lambda w: G.window_avg(w.days, rows=7))
query("window_avg_14")(lambda w: G.window_avg(w.days, rows=14))
query("share_of_world")(lambda w: G.share_of_total(w.days, FOCUS))
query("dense_rank_entities")(lambda w: G.dense_rank_by(w.days, w.entities, "entity"))
query("dense_rank_groups")(lambda w: G.dense_rank_by(w.days, w.entities, "group"))
query("rank_entities")(lambda w: G.rank_entities(w.days, w.entities))
query("global_wave_bands")(lambda w: G.global_waves(w.panel, DISTANCE, PROMINENCE))
query("trends_filtered")(lambda w: G.trends(w.panel, LABELS, "1997-01-01", "1999-12-31"))


def _report(name: str) -> Query:
    extra = {
        "high_cfr": {"min_pop": MIN_POP, "min_cases": MIN_CASES},
        "vacc_leaders": {"min_pop": MIN_POP},
    }
    return lambda w: G.canned_report(name)(w.days, w.entities, **extra.get(name, {}))


for _name in G.CANNED:
    query(f"canned_{_name}")(_report(_name))
