"""The seventeen report queries over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import exprs as E
from tidemark.functions.scalars import scalars
from tidemark.operators.panel import by_date, lagged, latest_row
from tidemark.operators.ranks import top_ranked, top_rows, with_ranks
from tidemark.operators.views import percent
from tidemark.sources.shared import materialise
from tidemark.spec import EPIDEMIC, FOCUS_ENTITY, GROWTH_ENTITIES, PanelSpec

# Labels as the reports print them.
COVERAGE_TIERS = ((70, "High (≥70%)"), (40, "Medium (40–70%)"), (10, "Low (10–40%)"))
COVERAGE_REST = "Very Low (<10%)"
TESTING_TIERS = ((0.05, "✔ Adequate (<5%)"), (0.10, "⚠ Moderate (5–10%)"))
TESTING_REST = "✗ Under-tested (>10%)"


def snapshot(fact: DataFrame, how: str = "max", spec: PanelSpec = EPIDEMIC) -> DataFrame:
    """World figures from latest rows: the largest entity (``max``) or the total (``sum``)."""
    columns = [
        "total_cases", "total_deaths", "total_vaccinations", "people_fully_vaccinated",
        "total_tests",
    ]
    fold = {"max": F.max, "sum": F.sum}[how]
    current = latest_row(fact.where(F.col(spec.entity).isNotNull()), spec, columns)
    return current.agg(
        fold("total_cases").alias("global_total_cases"),
        fold("total_deaths").alias("global_total_deaths"),
        fold("total_vaccinations").alias("global_total_vaccinations"),
        fold("people_fully_vaccinated").alias("global_fully_vaccinated"),
        fold("total_tests").alias("global_total_tests"),
        E.rnd(E.ratio(fold("total_deaths"), fold("total_cases")) * 100, 4).alias("global_cfr_pct"),
    )


def group_breakdown(fact: DataFrame, dim: DataFrame, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    current = latest_row(fact, spec, ["total_cases", "total_deaths", "people_fully_vaccinated"])
    known = dim.where(F.col(spec.group).isNotNull())
    people = F.sum("population")
    return current.join(known, spec.entity).groupBy(spec.group).agg(
        F.count(F.lit(1)).alias("country_count"),
        F.sum("total_cases").alias("total_cases"),
        F.sum("total_deaths").alias("total_deaths"),
        people.alias("total_population"),
        E.rnd(E.ratio(F.sum("total_deaths"), F.sum("total_cases")) * 100, 4).alias("cfr_pct"),
        E.rnd(E.ratio(F.sum("people_fully_vaccinated"), people) * 100, 2)
        .alias("avg_vaccination_rate_pct"),
    ).orderBy(F.desc_nulls_last("total_cases"))


def global_monthly(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("new_cases").isNotNull()).groupBy("year", "month").agg(
        E.month_label(F.min("date")).alias("month_label"),
        F.sum("new_cases").alias("monthly_new_cases"),
        F.sum("new_deaths").alias("monthly_new_deaths"),
        E.rnd(F.avg("reproduction_rate"), 3).alias("avg_reproduction_rate"),
    ).orderBy("year", "month")


def entity_ranks(
    fact: DataFrame, dim: DataFrame, limit: int = 30, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    columns = [
        "total_cases_per_million", "total_deaths_per_million", "vaccination_rate",
        "case_fatality_rate",
    ]
    current = latest_row(fact, spec, columns).where(F.col("total_cases_per_million").isNotNull())
    rows = materialise(current.join(dim.select(spec.entity, spec.label, spec.group), spec.entity))
    rows = with_ranks(rows, {
        "rank_cases_per_million": ([("total_cases_per_million", "desc")], "rank"),
        "dense_rank_vaccination": ([("vaccination_rate", "desc")], "dense_rank"),
    })
    first = top_rows(rows, [("rank_cases_per_million", "asc"), (spec.entity, "asc")], limit)
    return first.select(
        "location", "continent", "total_cases_per_million", "total_deaths_per_million",
        "vaccination_rate", percent("case_fatality_rate").alias("cfr_pct"),
        "rank_cases_per_million", "dense_rank_vaccination",
    )


def day_growth(
    fact: DataFrame, entities: tuple[str, ...] = GROWTH_ENTITIES, since: str = "2021-01-01",
    spec: PanelSpec = EPIDEMIC,
) -> DataFrame:
    """Change on the previous row. The date filter comes first, so the first row has none."""
    rows = fact.where(F.col(spec.entity).isin(*entities) & (F.col("date") >= F.lit(since)))
    before = F.col("prev_day_cases")
    return (
        rows.select(spec.entity, "date", "new_cases")
        .withColumn("prev_day_cases", lagged(rows, "new_cases", 1, spec))
        .withColumn("daily_change", F.col("new_cases") - before)
        .withColumn("growth_pct", E.rnd(E.ratio(F.col("daily_change"), before) * 100, 2))
        .orderBy(spec.entity, "date")
    )


def rolling_check(
    fact: DataFrame, focus: str = FOCUS_ENTITY, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Seven-row mean computed here beside the stored one."""
    one = fact.where(F.col(spec.entity) == focus)
    return one.select(
        spec.entity, "date", "new_cases",
        E.rnd(F.avg("new_cases").over(by_date(spec, rows=7)), 2).alias("rolling_7day_avg_cases"),
        F.col("rolling_7day_cases").alias("python_rolling_7day_cases"),
    ).orderBy("date")


def _peak(fact: DataFrame, spec: PanelSpec) -> DataFrame:
    """Each entity's day of the largest smoothed value, the earliest of equal days.

    Days of one height come first, then heights: two hash aggregates, no row is sorted.
    """
    by_height = fact.groupBy(spec.entity, "new_cases_smoothed").agg(
        F.min_by("new_cases", "date").alias("_cases"), F.min("date").alias("_first")
    )
    # A missing height is the lowest.
    height = F.coalesce("new_cases_smoothed", F.lit(float("-inf")))
    return by_height.groupBy(spec.entity).agg(
        F.max_by("_first", height).alias("peak_date"),
        F.max_by("_cases", height).alias("peak_new_cases"),
        F.max("new_cases_smoothed").alias("peak_smoothed_cases"),
    )


def peak_day(
    fact: DataFrame, dim: DataFrame, min_pop: int = 1_000_000, limit: int = 20,
    spec: PanelSpec = EPIDEMIC,
) -> DataFrame:
    big = dim.where(F.col("population") >= min_pop).select(spec.entity, spec.label, spec.group)
    rows = fact.select(spec.entity, "date", "new_cases", "new_cases_smoothed")
    peaks = _peak(rows, spec).join(big, spec.entity)
    order = [("peak_new_cases", "desc"), (spec.entity, "asc")]
    return top_rows(peaks, order, limit).select(
        "location", "continent", "peak_date", "peak_new_cases", "peak_smoothed_cases"
    )


def top_cfr(
    fact: DataFrame, dim: DataFrame, min_pop: int = 1_000_000, min_cases: int = 10_000,
    k: int = 10, spec: PanelSpec = EPIDEMIC,
) -> DataFrame:
    """Ranks on the rounded rate, so equal printed rates share a rank."""
    columns = ["total_cases", "total_deaths", "case_fatality_rate", "vaccination_rate"]
    current = latest_row(fact, spec, columns).where(F.col("total_cases") >= min_cases)
    big = dim.where(F.col("population") >= min_pop)
    rows = current.join(big, spec.entity).select(
        "location", "continent", "population", "total_cases", "total_deaths",
        percent("case_fatality_rate").alias("cfr_pct"),
        E.rnd(F.col("vaccination_rate"), 2).alias("vaccination_rate_pct"),
    )
    return top_ranked(materialise(rows), "cfr_rank", "cfr_pct", k).orderBy("cfr_rank")


def milestones(
    fact: DataFrame, dim: DataFrame, levels: tuple[int, int, int] = (25, 50, 75),
    spec: PanelSpec = EPIDEMIC,
) -> DataFrame:
    """First date at each coverage level and the days between levels."""
    low, mid, high = levels
    rate = F.col("vaccination_rate")

    def first_at(level: int) -> Column:
        return F.min(F.when(rate >= level, F.col("date"))).alias(f"date_{level}pct")

    per = fact.where(rate.isNotNull()).groupBy(spec.entity).agg(
        *[first_at(level) for level in levels], F.max(rate).alias("_max")
    )
    d = {level: F.col(f"date_{level}pct") for level in levels}
    return per.where(d[low].isNotNull()).join(
        dim.select(spec.entity, spec.label), spec.entity
    ).select(
        spec.label,
        E.rnd(F.col("_max"), 2).alias("max_vax_rate_pct"),
        d[low], d[mid], d[high],
        F.datediff(d[mid], d[low]).alias(f"days_{low}_to_{mid}"),
        F.datediff(d[high], d[mid]).alias(f"days_{mid}_to_{high}"),
    ).orderBy(d[mid].asc_nulls_last(), spec.label)


def top_per_group(
    fact: DataFrame, dim: DataFrame, k: int = 3, min_pop: int = 500_000,
    spec: PanelSpec = EPIDEMIC,
) -> DataFrame:
    covered = fact.where(F.col("vaccination_rate").isNotNull())
    known = dim.where(F.col(spec.group).isNotNull() & (F.col("population") >= min_pop))
    rows = latest_row(covered, spec, ["vaccination_rate"]).join(known, spec.entity).select(
        spec.group, spec.label, "vaccination_rate"
    )
    ranked = top_ranked(materialise(rows), "continent_rank", "vaccination_rate", k, [spec.group])
    return ranked.select(
        spec.group, spec.label,
        E.rnd(F.col("vaccination_rate"), 2).alias("vaccination_rate_pct"), "continent_rank",
    ).orderBy(spec.group, "continent_rank")


def entity_monthly(
    fact: DataFrame, focus: str = FOCUS_ENTITY, eom: bool = False, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Monthly figures of one entity; ``eom`` takes the month's last rate, not its highest."""
    rate = F.max_by("case_fatality_rate", "date") if eom else F.max("case_fatality_rate")
    return fact.where(F.col(spec.entity) == focus).groupBy("year", "month").agg(
        E.month_label(F.min("date")).alias("period"),
        F.sum("new_cases").alias("monthly_cases"),
        F.sum("new_deaths").alias("monthly_deaths"),
        F.max("total_vaccinations").alias("cumulative_vaccinations_eom"),
        F.max("people_fully_vaccinated").alias("fully_vaccinated_eom"),
        E.rnd(F.avg("rolling_7day_cases"), 0).alias("avg_daily_cases_7d"),
        E.rnd(rate * 100, 4).alias("cfr_pct_eom"),
    ).orderBy("year", "month")


def focus_vs_average(
    fact: DataFrame, focus: str = FOCUS_ENTITY, name: str = "India", spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """The focus entity's latest row above the mean of all latest rows."""
    columns = [
        "vaccination_rate", "case_fatality_rate", "total_cases_per_million",
        "total_deaths_per_million",
    ]
    mine = latest_row(fact.where(F.col(spec.entity) == focus), spec, columns)
    mean = latest_row(fact, spec, columns).agg(*[F.avg(c).alias(c) for c in columns])

    def shown(df: DataFrame, title: str) -> DataFrame:
        return df.select(
            F.lit(title).alias("entity"),
            E.rnd(F.col("vaccination_rate"), 2).alias("vaccination_rate_pct"),
            percent("case_fatality_rate").alias("cfr_pct"),
            E.rnd(F.col("total_cases_per_million"), 0).alias("cases_per_million"),
            E.rnd(F.col("total_deaths_per_million"), 2).alias("deaths_per_million"),
        )

    return shown(mine, name).unionByName(shown(mean, "World Average"))


def wave_periods(
    fact: DataFrame, focus: str = FOCUS_ENTITY, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Extent, peak and smoothed total per wave of one entity."""
    one = fact.where(
        (F.col(spec.entity) == focus)
        & F.col("new_cases_smoothed").isNotNull() & F.col("wave_number").isNotNull()
    )
    return one.groupBy("wave_number").agg(
        F.min("date").alias("wave_start"),
        F.max("date").alias("wave_end"),
        F.datediff(F.max("date"), F.min("date")).alias("wave_duration_days"),
        F.max("new_cases_smoothed").alias("peak_smoothed_cases"),
        E.rnd(F.sum("new_cases_smoothed"), 0).cast("bigint")
        .alias("total_smoothed_cases_in_wave"),
    ).orderBy("wave_number")


def coverage_tiers(
    fact: DataFrame, dim: DataFrame, cuts=COVERAGE_TIERS, rest: str = COVERAGE_REST,
    min_pop: int = 1_000_000, spec: PanelSpec = EPIDEMIC,
) -> DataFrame:
    columns = ["vaccination_rate", "case_fatality_rate", "total_deaths_per_million"]
    current = latest_row(fact, spec, columns).dropna(subset=columns[:2])
    big = dim.where(F.col("population") >= min_pop)
    return current.join(big, spec.entity).orderBy(F.desc("vaccination_rate")).select(
        "location", "continent",
        E.rnd(F.col("vaccination_rate"), 2).alias("vaccination_rate_pct"),
        percent("case_fatality_rate").alias("cfr_pct"),
        E.rnd(F.col("total_deaths_per_million"), 2).alias("deaths_per_million"),
        "median_age", "gdp_per_capita",
        E.tier(F.col("vaccination_rate"), list(cuts), rest).alias("vaccination_tier"),
    )


def above_below(
    fact: DataFrame, dim: DataFrame, min_pop: int = 1_000_000, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Mortality above and coverage below the mean of entities that have both."""
    columns = ["mortality_rate_per_million", "vaccination_rate", "case_fatality_rate"]
    current = materialise(latest_row(fact, spec, columns))
    mean = scalars(
        current.dropna(subset=columns[:2]),
        mortality=F.avg("mortality_rate_per_million"), cover=F.avg("vaccination_rate"),
    )
    picked = current.where(
        (F.col("mortality_rate_per_million") > mean["mortality"])
        & (F.col("vaccination_rate") < mean["cover"])
    )
    big = dim.where(F.col("population") >= min_pop)
    return picked.join(big, spec.entity).orderBy(F.desc("mortality_rate_per_million")).select(
        "location", "continent",
        E.rnd(F.col("mortality_rate_per_million"), 2).alias("deaths_per_million"),
        E.rnd(F.col("vaccination_rate"), 2).alias("vaccination_rate_pct"),
        percent("case_fatality_rate").alias("cfr_pct"),
        mean["mortality"].alias("avg_mortality"), mean["cover"].alias("avg_vaccination"),
    )


def timeline(
    fact: DataFrame, dim: DataFrame, limit: int = 20, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """First case, peak and current status of the entities with the highest totals.

    First case and current status share one aggregation; the peak needs its tie rule.
    """
    rows = fact.select(
        spec.entity, "date", "new_cases", "new_cases_smoothed", "total_cases", "total_deaths",
        "vaccination_rate",
    )
    status = rows.groupBy(spec.entity).agg(
        F.min(F.when(F.col("new_cases") > 0, F.col("date"))).alias("first_case_date"),
        F.max("date").alias("latest_date"),
        *[F.max_by(c, "date").alias(c) for c in ("total_cases", "total_deaths", "vaccination_rate")],
    ).where(F.col("first_case_date").isNotNull())
    named = dim.select(spec.entity, spec.label, spec.group)
    peaks = _peak(rows.where(F.col("new_cases_smoothed").isNotNull()), spec)
    joined = status.join(peaks, spec.entity).join(named, spec.entity)
    return top_rows(joined, [("total_cases", "desc"), (spec.entity, "asc")], limit).select(
        "location", "continent", "first_case_date", "peak_date",
        E.rnd(F.col("peak_smoothed_cases"), 0).alias("peak_daily_cases_smoothed"),
        "latest_date", "total_cases", "total_deaths",
        E.rnd(F.col("vaccination_rate"), 2).alias("vaccination_rate_pct"),
    )


def testing_adequacy(
    fact: DataFrame, dim: DataFrame, cuts=TESTING_TIERS, rest: str = TESTING_REST,
    min_pop: int = 1_000_000, limit: int = 20, spec: PanelSpec = EPIDEMIC,
) -> DataFrame:
    columns = ["positive_rate", "tests_per_case", "total_tests", "total_cases_per_million"]
    tested = F.col("positive_rate").isNotNull() & F.col("tests_per_case").isNotNull()
    big = dim.where(F.col("population") >= min_pop)
    rows = latest_row(fact, spec, columns, where=tested).join(big, spec.entity)
    verdict = F.lit(rest)
    for bound, name in reversed(cuts):
        verdict = F.when(F.col("positive_rate") < bound, F.lit(name)).otherwise(verdict)
    order = [("positive_rate", "desc"), (spec.entity, "asc")]
    return top_rows(rows, order, limit).select(
        "location", "continent",
        E.rnd(F.col("positive_rate") * 100, 2).alias("positivity_rate_pct"),
        E.rnd(F.col("tests_per_case"), 1).alias("tests_per_confirmed_case"),
        F.col("total_tests").alias("cumulative_tests"),
        E.rnd(F.col("total_cases_per_million"), 0).alias("cases_per_million"),
        verdict.alias("testing_adequacy"),
    )
