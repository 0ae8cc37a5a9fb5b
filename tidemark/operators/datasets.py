"""Datasets behind charts, cards and BI sheets. Data only; drawing is someone else's job.

Windows without a partition key appear only over frames already reduced to one row per calendar
day or month, whose length the calendar bounds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import exprs as E
from tidemark.functions.scalars import scalars
from tidemark.operators import reports, views
from tidemark.operators.panel import by_date, day_number, lagged, latest_row, latest_values
from tidemark.operators.ranks import top_rows, with_rank, with_ranks
from tidemark.operators.stats import correlation_test, min_max, ols_trend, quantile_trim
from tidemark.operators.waves import detect_peaks, label_waves
from tidemark.operators.windows import over_windows
from tidemark.sources.shared import materialise
from tidemark.spec import BENCHMARK_LABELS, EPIDEMIC, PanelSpec

# Wave shading and peak annotation windows used when rows carry no wave label.
WAVE_REGIONS = (
    (1, "2020-01-30", "2021-02-28"),
    (2, "2021-03-01", "2021-08-31"),
    (3, "2021-12-15", "2022-03-31"),
)
PEAK_WINDOWS = (
    ("Delta Peak", "2021-04-01", "2021-06-30"),
    ("Omicron Peak", "2022-01-01", "2022-03-31"),
)
METRIC_SMOOTHERS = {
    "new_cases": "rolling_7day_cases",
    "new_deaths": "rolling_7day_deaths",
    "vaccination_rate": None,
}
RADAR_METRICS = (
    "total_cases_per_million", "total_deaths_per_million", "vaccination_rate", "cfr_pct",
)
RANK_BY = {
    "cases": "total_cases", "deaths": "total_deaths", "vaccination_rate": "vaccination_rate",
}


def percent_window(
    panel: DataFrame, low: float, high: float, spec: PanelSpec = EPIDEMIC
) -> tuple[Column, Column]:
    """Dates at low % and high % of the panel's span, part days cut off."""
    ends = scalars(panel, a=F.min(spec.date), b=F.max(spec.date))
    days = F.datediff(ends["b"], ends["a"])
    days = F.when(days == 0, F.lit(1)).otherwise(days)

    def at(p: float) -> Column:
        return F.date_add(ends["a"], (F.lit(p / 100) * days).cast("int"))

    return at(low), at(high)


def percent_window_dates(
    panel: DataFrame, low: float, high: float, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    start, end = percent_window(panel, low, high, spec)
    return panel.sparkSession.range(1).select(start.alias("start_date"), end.alias("end_date"))


def in_window(panel: DataFrame, window: tuple[float, float] | None, spec: PanelSpec) -> DataFrame:
    if window is None:
        return panel
    start, end = percent_window(panel, *window, spec)
    return panel.where(F.col(spec.date).between(start, end))


def trend(
    panel: DataFrame, group: str | None = None, window: tuple[float, float] | None = None,
    spec: PanelSpec = EPIDEMIC,
) -> DataFrame:
    """Daily totals and mean rolling values, optionally of one group and part of the span."""
    if group is not None:
        panel = panel.where(F.col(spec.group) == group)
    return in_window(panel, window, spec).groupBy(spec.date).agg(
        F.sum("new_cases").alias("daily_cases"),
        F.sum("new_deaths").alias("daily_deaths"),
        F.avg("rolling_7day_cases").alias("avg_7d_cases"),
        F.avg("rolling_7day_deaths").alias("avg_7d_deaths"),
    ).orderBy(spec.date)


def metric_series(
    panel: DataFrame, focus: str, metric: str = "new_cases", spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    smoother = METRIC_SMOOTHERS.get(metric)
    smooth = F.col(smoother) if smoother else F.lit(None)
    return panel.where(F.col(spec.label) == focus).select(
        spec.date, F.col(metric).alias("value"), smooth.cast("double").alias("smoothed")
    ).orderBy(spec.date)


def _window_table(series: DataFrame, windows, name: str, kind: str) -> DataFrame:
    """Windows given as rows or as a table, with dates as dates."""
    if not isinstance(windows, DataFrame):
        windows = series.sparkSession.createDataFrame(
            list(windows), f"{name} {kind}, start_date string, end_date string"
        )
    return windows.select(
        name, F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
    )


def wave_extent(
    series: DataFrame, fallback=WAVE_REGIONS, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """First and last date of each wave; the fallback windows when rows carry no label."""
    if "wave_number" in series.columns:
        return series.where(F.col("wave_number").isNotNull()).groupBy("wave_number").agg(
            F.min(spec.date).alias("start_date"), F.max(spec.date).alias("end_date")
        ).orderBy("wave_number")
    return _window_table(series, fallback, "wave_number", "int")


def peak_in_window(
    series: DataFrame, metric: str, windows=PEAK_WINDOWS, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Date and value of the maximum within each named date window, earliest of equals.

    ``windows`` are rows (name, first, last date) or a table of any size with the columns
    window_name, start_date and end_date; windows of one name count as one.
    """
    table = _window_table(series, windows, "window_name", "string")
    highest = F.max(F.struct(
        F.col(metric).alias("v"), (-day_number(spec.date)).alias("early"), F.col(spec.date).alias("d")
    ))
    known = series.where(F.col(metric).isNotNull())
    best = over_windows(known, table, {"m": highest}, {"m": F.max}, date=spec.date)
    return best.groupBy("window_name").agg(F.max("m").alias("m")).select(
        "window_name", F.col("m.d").alias("peak_date"), F.col("m.v").alias("peak_value")
    )


def top_n(summary: DataFrame, metric: str, n: int = 15, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    """Largest n known values, smallest of them first as bars are drawn."""
    known = summary.where(F.col(metric).isNotNull())
    best = top_rows(known, [(metric, "desc"), (spec.label, "asc")], n)
    return best.select(spec.label, spec.group, metric, "population").orderBy(metric, spec.label)


def coverage_vs_cfr(
    summary: DataFrame, focus: str, group: str | None = None, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Coverage against fatality with linear marker weights; the focus row always comes along."""
    scaled = E.percent_if_all_fractions(summary, "case_fatality_rate", "cfr_pct")
    rows = scaled.dropna(subset=["vaccination_rate", "cfr_pct"]).where("vaccination_rate > 0")
    if group is not None:
        rows = rows.where(F.col(spec.group) == group)
    rows = E.linear_weight(rows, "population", spec.group, "weight")
    columns = [spec.label, spec.group, "vaccination_rate", "cfr_pct", "weight"]
    star = summary.where(F.col(spec.entity) == focus).select(
        spec.label, spec.group, "vaccination_rate",
        E.percent_if_fraction(F.col("case_fatality_rate")).alias("cfr_pct"),
        F.lit(1.0).alias("weight"), F.lit(True).alias("is_focus"),
    )
    return rows.select(*columns, F.lit(False).alias("is_focus")).unionByName(star)


def with_fatality(summary: DataFrame) -> DataFrame:
    """Adds the fatality rate from the totals where the column is absent."""
    if "case_fatality_rate" in summary.columns:
        return summary
    return summary.withColumn("case_fatality_rate", E.case_fatality_rate())


def coverage_trend(
    summary: DataFrame, group: str | None = None, points: int = 100, least: int = 6,
    spec: PanelSpec = EPIDEMIC,
) -> DataFrame:
    """Least-squares line through the points of ``coverage_vs_cfr``, if there are ``least``."""
    scaled = E.percent_if_all_fractions(summary, "case_fatality_rate", "cfr_pct")
    rows = scaled.dropna(subset=["vaccination_rate", "cfr_pct"]).where("vaccination_rate > 0")
    if group is not None:
        rows = rows.where(F.col(spec.group) == group)
    return ols_trend(rows, "vaccination_rate", "cfr_pct", points, least)


def coverage_trend_trimmed(
    summary: DataFrame, q: float = 0.98, points: int = 200, least: int = 6
) -> DataFrame:
    """Line through the trimmed points, with both correlation tests on the same rows."""
    summary = with_fatality(summary)
    guess = E.percent_if_fraction(F.col("case_fatality_rate"))
    rows = quantile_trim(summary.withColumn("cfr_pct", guess), "vaccination_rate", "cfr_pct", q)
    rows = materialise(rows.select("vaccination_rate", "cfr_pct"))
    line = ols_trend(rows, "vaccination_rate", "cfr_pct", points, least)
    for method in ("pearson", "spearman"):
        test = scalars(
            correlation_test(rows, "vaccination_rate", "cfr_pct", method), r=F.max("r")
        )
        line = line.withColumn(f"{method}_r", test["r"])
    return line


def coverage_vs_cfr_trimmed(
    summary: DataFrame, focus: str, q: float = 0.98, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Variant without the top of the fatality range and with log marker weights."""
    summary = with_fatality(summary)
    guess = E.percent_if_fraction(F.col("case_fatality_rate"))
    valid = quantile_trim(summary.withColumn("cfr_pct", guess), "vaccination_rate", "cfr_pct", q)
    named = F.coalesce(F.contains(F.lower(spec.label), F.lower(F.lit(focus))), F.lit(False))
    return valid.where(~named | (F.col(spec.label) == focus)).select(
        spec.label, spec.group, "vaccination_rate", "cfr_pct",
        E.log_weight(F.col("population")).alias("weight"),
        F.coalesce(F.col(spec.label) == focus, F.lit(False)).alias("is_focus"),
    )


def kpi_cards(
    panel: DataFrame, window: tuple[float, float] | None = None, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Totals of per-entity maxima, population-weighted coverage, fatality percent.

    An entity whose coverage is unknown still counts in the weights' total. A panel without a
    running total has its daily values summed instead; other columns that it lacks are unknown.
    """
    def most(column: str) -> Column:
        known = column in panel.columns
        return F.max(column) if known else F.max(F.lit(None).cast("double"))

    def total(column: str, daily: str) -> Column:
        if column not in panel.columns and daily in panel.columns:
            return F.sum(daily)
        return most(column)

    per = in_window(panel, window, spec).groupBy(spec.entity).agg(
        total("total_cases", "new_cases").alias("c"),
        total("total_deaths", "new_deaths").alias("d"),
        most("vaccination_rate").alias("v"), most("population").alias("p"),
    )
    cases, deaths, people = F.sum("c"), F.sum("d"), F.sum("p")
    weighted = E.ratio(F.sum(F.col("v") * F.col("p")), people)
    return per.agg(
        cases.alias("total_cases"), deaths.alias("total_deaths"),
        F.when(people > 0, weighted).otherwise(F.avg("v")).alias("vaccination_pct"),
        (E.ratio(deaths, F.greatest(cases, F.lit(1))) * 100).alias("cfr_pct"),
    )


def _calendar_rows(rows: int):
    return Window.orderBy("date").rowsBetween(1 - rows, 0)


def global_daily(panel: DataFrame, rows: int = 7) -> DataFrame:
    """World totals by date with rolling means, clamped at 0 after rolling."""
    daily = panel.groupBy("date").agg(
        F.sum("new_cases").alias("new_cases"), F.sum("new_deaths").alias("new_deaths")
    )
    w = _calendar_rows(rows)
    rolled = daily.withColumns({
        "rolling_7d_cases": F.avg("new_cases").over(w),
        "rolling_7d_deaths": F.avg("new_deaths").over(w),
    })
    return rolled.select("date", *[
        E.clip_floor(F.col(c)).alias(c)
        for c in ("new_cases", "new_deaths", "rolling_7d_cases", "rolling_7d_deaths")
    ])


def global_totals(panel: DataFrame, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    """Sums of last known totals and the largest single-day value, in one pass by entity."""
    known = panel.where(F.col(spec.label).isNotNull())

    def last(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(spec.date)))

    per = known.groupBy(spec.label).agg(
        last("total_cases").alias("c"), last("total_deaths").alias("d")
    )
    most = scalars(panel, top=F.max("new_cases"))["top"]
    return per.agg(F.sum("c").alias("total_cases"), F.sum("d").alias("total_deaths")).withColumn(
        "max_single_day_cases", most
    )


def wave_intervals(
    series: DataFrame, peaks: DataFrame, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Each entity's span cut at its peak dates: interval number, start, end."""
    ends = series.groupBy(spec.entity).agg(
        F.min(spec.date).alias("a"), F.max(spec.date).alias("b")
    )
    bounds = ends.select(spec.entity, F.explode(F.array(
        F.struct(F.lit(0).alias("part"), F.col("a").alias("at")),
        F.struct(F.lit(2).alias("part"), F.col("b").alias("at")),
    )).alias("e")).select(spec.entity, "e.*")
    cuts = peaks.select(spec.entity, F.lit(1).alias("part"), F.col(spec.date).alias("at"))
    w = Window.partitionBy(spec.entity).orderBy("part", "at")
    return bounds.unionByName(cuts).select(
        spec.entity, F.row_number().over(w).alias("interval"), F.col("at").alias("start_date"),
        F.lead("at").over(w).alias("end_date"),
    ).where(F.col("end_date").isNotNull())


def benchmark(
    panel: DataFrame, labels: tuple[str, ...] = BENCHMARK_LABELS, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Latest rows of the named entities and the mean of every entity's last known values."""
    columns = [
        "total_cases_per_million", "total_deaths_per_million", "vaccination_rate",
        "case_fatality_rate",
    ]
    w = Window.partitionBy(spec.label).orderBy(F.desc(spec.date))
    mine = panel.where(F.col(spec.label).isin(*labels)).select(spec.label, spec.date, *columns)
    mine = mine.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    every = latest_values(
        panel.select(spec.label, spec.date, *columns), spec, columns=columns
    ).agg(*[F.avg(c).alias(c) for c in columns])
    rows = mine.select(spec.label, *columns).unionByName(
        every.select(F.lit("World Average").alias(spec.label), *columns)
    )
    return rows.withColumn("cfr_pct", E.percent_if_fraction(F.col("case_fatality_rate")))


def radar(
    bench: DataFrame, metrics: tuple[str, ...] = RADAR_METRICS, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Benchmark metrics scaled to 0-100 over the compared rows, in long form."""
    rows = materialise(bench.select(spec.label, *metrics))
    scaled = min_max(rows, {m: m for m in metrics}, epsilon=1e-9)
    return scaled.select(spec.label, *[(F.col(m) * 100).alias(m) for m in metrics]).unpivot(
        [spec.label], list(metrics), "metric", "scaled"
    )


def top_risk(scores: DataFrame, n: int = 15, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    """Highest n scores beside the mean score and mean coverage of all."""
    mean = scalars(
        scores, score=F.avg("composite_risk_score"), cover=F.avg("vaccination_rate")
    )
    best = top_rows(scores, [("composite_risk_score", "desc"), (spec.label, "asc")], n)
    return best.select(
        spec.label, spec.group, "vaccination_rate", "composite_risk_score",
        mean["score"].alias("avg_risk_score"), mean["cover"].alias("avg_vaccination_rate"),
    )


def compare_series(
    panel: DataFrame, labels: tuple[str, ...], metric: str, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """One column per named entity, one row per date."""
    rows = panel.where(F.col(spec.label).isin(*labels))
    return rows.groupBy(spec.date).pivot(spec.label, list(labels)).agg(F.max(metric)).orderBy(
        spec.date
    )


def map_metric(
    panel: DataFrame, dim: DataFrame, metric: str = "total_cases", spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    current = latest_row(panel, spec, [metric])
    return current.join(dim, spec.entity).select(
        spec.entity, spec.label, F.col(metric).alias("value")
    )


def monthly_stack(panel: DataFrame, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    return panel.where(F.col(spec.group).isNotNull()).groupBy(
        F.trunc(spec.date, "month").alias("month"), spec.group
    ).agg(
        F.sum("new_cases").alias("new_cases"), F.sum("new_deaths").alias("new_deaths")
    ).orderBy("month", spec.group)


def group_share(
    panel: DataFrame, dim: DataFrame, metric: str = "total_cases", spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Each group's part of the grand total, in percent, from latest rows."""
    known = dim.where(F.col(spec.group).isNotNull())
    totals = materialise(
        latest_row(panel, spec, [metric]).join(known, spec.entity)
        .groupBy(spec.group).agg(F.sum(metric).alias("value"))
    )
    whole = scalars(totals, t=F.sum("value"))["t"]
    return totals.withColumn("share_pct", E.ratio(F.col("value"), whole) * 100)


def top_entities(
    panel: DataFrame, dim: DataFrame, n: int = 10, by: str = "cases", spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    metric = RANK_BY[by]
    current = latest_row(panel, spec, [metric]).where(F.col(metric).isNotNull())
    best = top_rows(current, [(metric, "desc"), (spec.entity, "asc")], n)
    return best.join(dim, spec.entity).select(
        spec.label, spec.group, F.col(metric).alias("value")
    ).orderBy(F.desc("value"), spec.label)


def entity_kpis(panel: DataFrame, focus: str, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    columns = ["total_cases", "total_deaths", "people_fully_vaccinated"]
    current = latest_row(panel.where(F.col(spec.entity) == focus), spec, columns)
    cases, deaths = F.col("total_cases"), F.col("total_deaths")
    return current.select(
        spec.entity, *columns,
        (E.ratio(deaths, cases) * 100).alias("cfr_pct"),
        E.recovery_rate(deaths, cases, alternate=0).alias("recovery_pct"),
    )


def vaccination_series(panel: DataFrame, focus: str, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    return panel.where(F.col(spec.entity) == focus).select(
        spec.date, "total_vaccinations", "people_fully_vaccinated"
    ).orderBy(spec.date)


def month_heatmap(
    panel: DataFrame, focus: str, metric: str = "new_cases", spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Years down, months 1 to 12 across."""
    one = panel.where(F.col(spec.entity) == focus)
    wide = one.groupBy("year").pivot("month", list(range(1, 13))).agg(F.sum(metric))
    return wide.select("year", *[F.col(str(m)).alias(f"month_{m}") for m in range(1, 13)])


def weekly_growth(
    panel: DataFrame, metric: str = "new_cases", spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Percent change on the row seven earlier, a missing value counting as 0."""
    filled = panel.select(spec.entity, spec.date, F.coalesce(F.col(metric), F.lit(0)).alias("value"))
    before = lagged(filled, "value", 7, spec)
    return filled.withColumn("value_7_back", before).withColumn(
        "growth_pct",
        E.ratio(F.col("value") - F.col("value_7_back"), F.col("value_7_back")) * 100,
    )


def growth_heatmap(
    panel: DataFrame, metric: str = "new_cases", spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Mean weekly growth: one row per entity and year, months 1 to 12 across."""
    rows = weekly_growth(panel, metric, spec).withColumns({
        "year": F.year(spec.date), "month": F.month(spec.date),
    })
    wide = rows.groupBy(spec.entity, "year").pivot("month", list(range(1, 13))).agg(
        F.avg("growth_pct")
    )
    return wide.select(
        spec.entity, "year", *[F.col(str(m)).alias(f"month_{m}") for m in range(1, 13)]
    )


def mom_growth(
    panel: DataFrame, metric: str = "new_cases", by: str | None = None,
    spec: PanelSpec = EPIDEMIC,
) -> DataFrame:
    """Monthly sums against the month before.

    Worldwide: the previous calendar month, and 0 where there is none. By entity: the previous
    month that has rows, and NULL where there is none.
    """
    keys = [by] if by else []
    sums = panel.groupBy(*keys, F.trunc(spec.date, "month").alias("month")).agg(
        F.sum(metric).alias("value")
    )
    w = Window.partitionBy(*keys).orderBy("month")
    before = F.lag("value").over(w)
    if by is None:
        adjacent = F.lag("month").over(w) == F.add_months("month", -1)
        before = F.when(adjacent, before)
    out = sums.withColumn("previous", before)
    growth = E.ratio(F.col("value") - F.col("previous"), F.col("previous")) * 100
    if by is None:
        growth = F.coalesce(growth, F.lit(0.0))
    return out.withColumn("growth_pct", growth)


def calendar_avg(
    panel: DataFrame, metric: str = "new_cases", days: int = 7, by: str | None = None,
    spec: PanelSpec = EPIDEMIC,
) -> DataFrame:
    """Mean of daily sums over the last ``days`` calendar days; days without rows are skipped."""
    keys = [by] if by else []
    daily = panel.groupBy(*keys, spec.date).agg(F.sum(metric).alias("value"))
    w = Window.partitionBy(*keys).orderBy(day_number(spec.date)).rangeBetween(1 - days, 0)
    return daily.withColumn("calendar_avg", F.avg("value").over(w))


def window_avg(panel: DataFrame, metric: str = "new_cases", rows: int = 7) -> DataFrame:
    """Mean of daily sums over the last ``rows`` dates that have rows."""
    daily = panel.groupBy("date").agg(F.sum(metric).alias("value"))
    return daily.withColumn("window_avg", F.avg("value").over(_calendar_rows(rows)))


def share_of_total(
    panel: DataFrame, focus: str, metric: str = "total_cases", spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    mine = F.sum(F.when(F.col(spec.entity) == focus, F.col(metric)))
    every = F.sum(metric)
    share = F.coalesce(E.ratio(mine, every), F.lit(0.0)) * 100
    return latest_row(panel, spec, [metric]).agg(
        mine.alias("focus_total"), every.alias("world_total"), share.alias("share_pct")
    )


def dense_rank_by(
    panel: DataFrame, dim: DataFrame, level: str = "entity", metric: str = "total_cases",
    spec: PanelSpec = EPIDEMIC,
) -> DataFrame:
    """Dense rank by largest total per entity, or by the sum of latest totals per group."""
    if level == "entity":
        tops = panel.groupBy(spec.entity).agg(F.max(metric).alias("value"))
        rows = tops.join(dim, spec.entity).select(F.col(spec.label).alias("member"), "value")
    else:
        rows = latest_row(panel, spec, [metric]).join(dim, spec.entity).groupBy(
            F.col(spec.group).alias("member")
        ).agg(F.sum(metric).alias("value"))
    return with_rank(materialise(rows), "dense_rank", [("value", "desc")], "dense_rank")


def rank_entities(panel: DataFrame, dim: DataFrame, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    """Competition ranks by latest total cases and by mean deaths per million."""
    per = panel.groupBy(spec.entity).agg(
        F.max_by("total_cases", spec.date).alias("total_cases"),
        E.rnd(F.avg("total_deaths_per_million"), 4).alias("avg_deaths_per_million"),
    )
    rows = materialise(per.join(dim, spec.entity).select(
        spec.label, "total_cases", "avg_deaths_per_million"
    ))
    return with_ranks(rows, {
        "rank_total_cases": ([("total_cases", "desc")], "rank"),
        "rank_deaths_per_million": ([("avg_deaths_per_million", "desc")], "rank"),
    })


def global_waves(panel: DataFrame, distance: int, least: float) -> DataFrame:
    """Waves of the worldwide daily series: smoothed totals, peak flag, wave number."""
    world = global_daily(panel).select(
        F.lit("World").alias("iso_code"), "date", "new_cases",
        F.col("rolling_7d_cases").alias("new_cases_smoothed"),
    )
    world = materialise(world)
    peaks = detect_peaks(world, distance=distance, least=least)
    flagged = label_waves(world, peaks).join(
        peaks.select("iso_code", "date", F.lit(True).alias("is_peak")), ["iso_code", "date"], "left"
    )
    return flagged.select(
        "date", "new_cases", "new_cases_smoothed", "wave_number",
        F.coalesce("is_peak", F.lit(False)).alias("is_peak"),
    )


def trends(
    panel: DataFrame, labels: tuple[str, ...], first: str, last: str, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Daily series of several entities within a date range."""
    day = F.col(spec.date)
    return panel.where(
        F.col(spec.label).isin(*labels) & day.between(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    ).select(
        spec.label, spec.date, "new_cases", "new_deaths", "rolling_7day_cases",
        "rolling_7day_deaths", "vaccination_rate", "stringency_index", "reproduction_rate",
    )


CANNED = {
    "top_cases": lambda fact, dim, **kw: top_entities(fact, dim, 10, "cases"),
    "high_cfr": lambda fact, dim, **kw: reports.top_cfr(fact, dim, **kw),
    "vacc_leaders": lambda fact, dim, **kw: reports.top_per_group(fact, dim, **kw),
    "monthly_trend": lambda fact, dim, **kw: reports.global_monthly(fact),
    "continent_summary": lambda fact, dim, **kw: views.continental_summary(fact, dim),
}


def canned_report(name: str) -> Callable[..., DataFrame]:
    """Named report as a function of (fact, dim, **parameters)."""
    return CANNED[name]
