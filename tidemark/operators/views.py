"""The eight reporting views over the star schema.

Dimension joins carry no broadcast hint: Spark broadcasts a dimension whose size it knows to be
small and shuffles otherwise. Reductions run before joins wherever the result allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import exprs as E
from tidemark.functions.scalars import scalars
from tidemark.operators.panel import latest_row
from tidemark.operators.ranks import top_rows, with_rank
from tidemark.sources.shared import materialise
from tidemark.spec import EPIDEMIC, FOCUS_ENTITY, PanelSpec


def percent(col: str, digits: int = 4):
    return E.rnd(F.col(col) * 100, digits)


#: What the latest-row views read: figures of the whole last row, and the last known coverage.
_LATEST = (
    "total_cases", "total_deaths", "total_vaccinations", "people_fully_vaccinated",
    "total_cases_per_million", "total_deaths_per_million", "case_fatality_rate", "vaccination_rate",
    "mortality_rate_per_million", "rolling_7day_cases", "rolling_7day_deaths",
)


def snapshot(fact: DataFrame, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    """One row per entity that feeds every latest-row view: one aggregation over the fact."""
    covered = F.when(F.col("vaccination_rate").isNotNull(), F.col(spec.date))
    return fact.groupBy(spec.entity).agg(
        F.max(spec.date).alias(spec.date), *[F.max_by(c, spec.date).alias(c) for c in _LATEST],
        F.max_by("vaccination_rate", covered).alias("known_vaccination_rate"),
    )


def rollup(fact: DataFrame, spec: PanelSpec = EPIDEMIC, waves: bool = True) -> DataFrame:
    """One row per entity, month and wave that feeds the monthly and the wave view.

    The monthly view alone needs no ``waves``.
    """
    counted = F.col("new_cases").isNotNull()
    return fact.groupBy(spec.entity, "year", "month", *(["wave_number"] if waves else [])).agg(
        F.min("date").alias("first"), F.max("date").alias("last"),
        F.min(F.when(counted, F.col("date"))).alias("first_counted"),
        F.max("new_cases_smoothed").alias("peak"),
        F.sum("new_cases").alias("cases"), F.sum("new_deaths").alias("deaths"),
        F.sum(F.when(counted, F.col("new_deaths"))).alias("counted_deaths"),
        F.sum(F.when(counted, F.col("rolling_7day_cases"))).alias("rolling"),
        F.count(F.when(counted, F.col("rolling_7day_cases"))).alias("rolling_rows"),
    )


def global_daily_trend(fact: DataFrame) -> DataFrame:
    return fact.groupBy("date").agg(
        F.sum("new_cases").alias("global_new_cases"),
        F.sum("new_deaths").alias("global_new_deaths"),
        E.rnd(F.avg("new_cases_smoothed"), 2).alias("avg_smoothed_cases"),
        E.rnd(F.avg("new_deaths_smoothed"), 2).alias("avg_smoothed_deaths"),
        E.rnd(F.avg("reproduction_rate"), 3).alias("avg_reproduction_rate"),
        E.rnd(F.avg("stringency_index"), 2).alias("avg_stringency_index"),
    ).orderBy("date")


def continental_summary(
    fact: DataFrame, dim: DataFrame, spec: PanelSpec = EPIDEMIC, current: DataFrame | None = None
) -> DataFrame:
    """``current`` is a stored ``snapshot``, here and below; without it the fact is reduced anew."""
    columns = ["total_cases", "total_deaths", "people_fully_vaccinated", "vaccination_rate"]
    if current is None:
        current = latest_row(fact, spec, columns)
    current = current.select(spec.entity, *columns)
    known = dim.where(F.col(spec.group).isNotNull())
    cases, deaths, people = F.sum("total_cases"), F.sum("total_deaths"), F.sum("population")
    return current.join(known, spec.entity).groupBy(spec.group).agg(
        F.count(F.lit(1)).alias("country_count"),
        cases.alias("total_cases"),
        deaths.alias("total_deaths"),
        people.alias("total_population"),
        E.rnd(E.ratio(cases, people) * 1e6, 2).alias("cases_per_million"),
        E.rnd(E.ratio(deaths, people) * 1e6, 2).alias("deaths_per_million"),
        E.rnd(E.ratio(deaths, cases) * 100, 4).alias("cfr_pct"),
        E.rnd(F.avg("vaccination_rate"), 2).alias("avg_vaccination_rate_pct"),
    ).orderBy(F.desc_nulls_last("total_cases"))


def country_latest(
    fact: DataFrame, dim: DataFrame, spec: PanelSpec = EPIDEMIC, current: DataFrame | None = None
) -> DataFrame:
    columns = [
        spec.date, "total_cases", "total_deaths", "total_vaccinations", "people_fully_vaccinated",
        "total_cases_per_million", "total_deaths_per_million", "case_fatality_rate",
        "vaccination_rate", "mortality_rate_per_million", "rolling_7day_cases",
        "rolling_7day_deaths",
    ]
    if current is None:
        current = latest_row(fact, spec, columns)
    return current.select(spec.entity, *columns).join(dim, spec.entity).select(
        "iso_code", "location", "continent", "population", "gdp_per_capita", "median_age",
        "human_development_index", F.col(spec.date).alias("latest_date"),
        "total_cases", "total_deaths", "total_vaccinations", "people_fully_vaccinated",
        "total_cases_per_million", "total_deaths_per_million",
        percent("case_fatality_rate").alias("cfr_pct"),
        E.rnd(F.col("vaccination_rate"), 2).alias("vaccination_rate_pct"),
        "mortality_rate_per_million", "rolling_7day_cases", "rolling_7day_deaths",
    ).orderBy("iso_code")


def entity_timeline(
    fact: DataFrame, dates: DataFrame, focus: str = FOCUS_ENTITY, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    one = fact.where(F.col(spec.entity) == focus)
    calendar = dates.select(F.col("date_key").alias("date"), "month_name", "quarter")
    return one.join(calendar, "date").select(
        "date", "new_cases", "new_deaths", "new_cases_smoothed", "new_deaths_smoothed",
        "total_cases", "total_deaths", "total_vaccinations", "people_vaccinated",
        "people_fully_vaccinated", "new_vaccinations",
        E.rnd(F.col("vaccination_rate"), 4).alias("vaccination_rate_pct"),
        percent("case_fatality_rate").alias("cfr_pct"),
        "rolling_7day_cases", "rolling_7day_deaths", "rolling_14day_cases", "wave_number",
        "stringency_index", "reproduction_rate", "month_name", "quarter", "year", "month",
    ).orderBy("date")


def monthly_by_group(
    fact: DataFrame, dim: DataFrame, spec: PanelSpec = EPIDEMIC, months: DataFrame | None = None
) -> DataFrame:
    """``months`` is a stored ``rollup``, here and below; without it the fact is reduced anew.

    Either way rows are reduced per entity before they meet the dimension.
    """
    known = dim.where(F.col(spec.group).isNotNull()).select(spec.entity, spec.group)
    months = (rollup(fact, spec, waves=False) if months is None else months).where("first_counted is not null")
    return months.join(known, spec.entity).groupBy("year", "month", spec.group).agg(
        E.month_label(F.min("first_counted")).alias("month_label"),
        F.sum("cases").alias("monthly_new_cases"),
        F.sum("counted_deaths").alias("monthly_new_deaths"),
        E.rnd(F.try_divide(F.sum("rolling"), F.sum("rolling_rows")), 0).alias("avg_7day_cases"),
    ).orderBy("year", "month", spec.group)


def coverage_progress(
    fact: DataFrame, dim: DataFrame, top_n: int = 20, literal: bool = False,
    spec: PanelSpec = EPIDEMIC, current: DataFrame | None = None,
) -> DataFrame:
    """Series of the top entities: by latest rate, or with ``literal`` by code order."""
    covered = fact.where(F.col("vaccination_rate").isNotNull())
    if current is None:
        current = latest_row(covered, spec, ["vaccination_rate"]).withColumnRenamed(
            "vaccination_rate", "known_vaccination_rate"
        )
    known = current.where("known_vaccination_rate is not null")
    order = [] if literal else [("known_vaccination_rate", "desc")]
    chosen = top_rows(known, [*order, (spec.entity, "asc")], top_n)
    chosen = F.broadcast(chosen.select(spec.entity))  # top_n rows
    return covered.join(chosen, spec.entity, "left_semi").join(
        dim.select(spec.entity, spec.label), spec.entity
    ).select(
        spec.entity, spec.label, "date",
        E.rnd(F.col("vaccination_rate"), 4).alias("vaccination_rate_pct"),
        "people_fully_vaccinated", "total_boosters",
    ).orderBy(spec.entity, "date")


def scaled_between(column: str, low, high):
    return E.ratio(F.col(column) - low, high - low)


def high_risk(
    fact: DataFrame, dim: DataFrame, min_pop: int = 1_000_000, spec: PanelSpec = EPIDEMIC,
    current: DataFrame | None = None,
) -> DataFrame:
    """Min-max over every entity first, population filter next, rank last."""
    parts = ["total_cases_per_million", "mortality_rate_per_million", "vaccination_rate"]
    columns = [*parts, "case_fatality_rate"]
    if current is None:
        current = materialise(latest_row(fact, spec, columns))
    current = current.select(spec.entity, *columns).dropna(subset=parts)
    span = scalars(
        current,
        **{f"lo_{c}": F.min(c) for c in parts}, **{f"hi_{c}": F.max(c) for c in parts},
    )
    cases, deaths, cover = (
        scaled_between(c, span[f"lo_{c}"], span[f"hi_{c}"]) for c in parts
    )
    scored = current.withColumn("score", (cases + deaths + (1 - cover)) / 3)
    big = dim.where(F.col("population") >= min_pop)
    joined = materialise(scored.join(big, spec.entity))
    return with_rank(joined, "risk_rank", [("score", "desc")]).select(
        "risk_rank", "location", "continent", "population",
        E.rnd(F.col("total_cases_per_million"), 0).alias("cases_per_million"),
        E.rnd(F.col("mortality_rate_per_million"), 2).alias("deaths_per_million"),
        E.rnd(F.col("vaccination_rate"), 2).alias("vaccination_rate_pct"),
        percent("case_fatality_rate").alias("cfr_pct"),
        E.rnd(F.col("score"), 4).alias("composite_risk_score"),
    ).orderBy(F.desc_nulls_last("composite_risk_score"))


def wave_summary(
    fact: DataFrame, dim: DataFrame, min_pop: int = 1_000_000, spec: PanelSpec = EPIDEMIC,
    months: DataFrame | None = None,
) -> DataFrame:
    """Extent, peak and totals of each entity's waves.

    Reduced per (entity, wave) before the dimension join, then once more by label.
    """
    months = rollup(fact, spec) if months is None else months
    waves = months.where(F.col("wave_number") > 0).groupBy(spec.entity, "wave_number").agg(
        F.min("first").alias("a"), F.max("last").alias("b"), F.max("peak").alias("peak"),
        F.sum("cases").alias("cases"), F.sum("deaths").alias("deaths"),
    )
    big = dim.where(F.col("population") >= min_pop)
    return waves.join(big, spec.entity).groupBy(spec.label, spec.group, "wave_number").agg(
        F.min("a").alias("wave_start"),
        F.max("b").alias("wave_end"),
        F.datediff(F.max("b"), F.min("a")).alias("wave_duration_days"),
        F.max("peak").alias("peak_smoothed_daily_cases"),
        F.sum("cases").alias("total_new_cases_in_wave"),
        F.sum("deaths").alias("total_new_deaths_in_wave"),
        E.rnd(E.ratio(F.sum("deaths"), F.sum("cases")) * 100, 4).alias("wave_cfr_pct"),
    ).orderBy(spec.label, "wave_number")
