"""Column roles of a daily panel, and the epidemiology preset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Names and constants that results must share with the data they describe.
AGGREGATE_PREFIX = "OWID_"
FOCUS_ENTITY = "IND"
GROWTH_ENTITIES = ("IND", "USA", "BRA", "GBR", "DEU")
BENCHMARK_LABELS = ("India", "United States", "Brazil", "United Kingdom")
PEAK_DISTANCE = 30
PEAK_PROMINENCE = 5000.0

KEY_COLUMNS = ("iso_code", "continent", "location", "date")
CUMULATIVE = (
    "total_cases", "total_deaths", "total_tests", "total_vaccinations",
    "people_vaccinated", "people_fully_vaccinated", "total_boosters",
)
DAILY = ("new_cases", "new_deaths", "new_tests", "new_vaccinations")
STATIC = (
    "population", "population_density", "median_age", "aged_65_older", "gdp_per_capita",
    "cardiovasc_death_rate", "diabetes_prevalence", "life_expectancy",
    "human_development_index",
)
RATES = (
    "new_cases_smoothed", "total_cases_per_million", "new_cases_per_million",
    "new_deaths_smoothed", "total_deaths_per_million", "new_deaths_per_million",
    "positive_rate", "icu_patients", "hosp_patients", "new_vaccinations_smoothed",
    "stringency_index", "reproduction_rate",
)
DERIVED = (
    "case_fatality_rate", "vaccination_rate", "tests_per_case", "mortality_rate_per_million",
)
ROLLING = (
    "rolling_7day_cases", "rolling_7day_deaths", "rolling_14day_cases", "rolling_14day_deaths",
)
DATE_PARTS = ("year", "month", "week", "day_of_week")
NUMERIC = CUMULATIVE + DAILY + STATIC + RATES
RAW_COLUMNS = KEY_COLUMNS + NUMERIC
PANEL_COLUMNS = RAW_COLUMNS + DERIVED + ROLLING + DATE_PARTS
CORRELATION_METRICS = (
    "vaccination_rate", "case_fatality_rate", "mortality_rate_per_million",
    "total_cases_per_million", "gdp_per_capita", "median_age",
    "human_development_index", "life_expectancy",
)
COUNT_COLUMNS = CUMULATIVE + DAILY + ("population",)

FACT_COLUMNS = (
    ("iso_code", "date")
    + CUMULATIVE
    + DAILY
    + tuple(c for c in RATES if c not in ("icu_patients", "hosp_patients"))
    + DERIVED + ROLLING + DATE_PARTS + ("wave_number",)
)
DIM_COLUMNS = ("iso_code", "continent", "location") + STATIC


@dataclass(frozen=True)
class PanelSpec:
    """Which column plays which role. Operators read roles, never column positions."""

    entity: str = "iso_code"
    label: str = "location"
    group: str = "continent"
    date: str = "date"
    cumulative: tuple[str, ...] = CUMULATIVE
    daily: tuple[str, ...] = DAILY
    static: tuple[str, ...] = STATIC
    numeric: tuple[str, ...] = NUMERIC
    rolled: tuple[tuple[str, str], ...] = (("new_cases", "cases"), ("new_deaths", "deaths"))


EPIDEMIC = PanelSpec()


def column_type(name: str) -> T.DataType:
    """Spark type of a preset column once it has been cast."""
    if name in ("iso_code", "continent", "location"):
        return T.StringType()
    if name == "date":
        return T.DateType()
    if name in DATE_PARTS or name == "wave_number":
        return T.IntegerType()
    if name in COUNT_COLUMNS:
        return T.LongType()
    return T.DoubleType()


def panel_schema(columns: tuple[str, ...] = PANEL_COLUMNS) -> T.StructType:
    """Schema for re-reading processed data."""
    return T.StructType([T.StructField(c, column_type(c)) for c in columns])
