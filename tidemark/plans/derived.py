"""A raw daily panel derived from order tables: one entity per supplier, one row per calendar day.

Each shipped line is a case, a returned line a death, its quantity the tests; customers reached by
a supplier are its population, and those with a line of at least ``LARGE`` units are covered. Days
without shipments have no daily values and no running totals, as in reported data. Regions add
aggregate entities that cleaning must drop.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions import exprs as E
from tidemark.spec import AGGREGATE_PREFIX, RAW_COLUMNS

LARGE = 25
LARGER = 45

@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    folder: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def lines(self) -> DataFrame:
        return self.read("lineitem").select(
            "l_orderkey", F.col("l_suppkey").alias("supplier"),
            F.col("l_quantity").cast("bigint").alias("units"),
            F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
            F.to_date("l_shipdate").alias("date"),
        )

    def suppliers(self) -> DataFrame:
        nation, region = self.read("nation"), self.read("region")
        place = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
        return self.read("supplier").join(place, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("supplier"),
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("iso_code"),
            F.col("r_name").alias("continent"), F.col("s_name").alias("location"),
            F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("gdp_per_capita"),
        )


DAILY_SUMS = (
    "new_cases", "new_deaths", "new_tests", "new_vaccinations", "boosters", "open_lines",
    "open_returns", "accepted", "reached", "covered",
)


def _zeros(**given: Column) -> list[Column]:
    return [given.get(c, F.lit(0)).cast("bigint").alias(c) for c in DAILY_SUMS]


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def shipments(tables: Tables) -> DataFrame:
    """One row of daily values per shipped line."""
    returned, still_open = F.col("flag") == "R", F.col("status") == "O"
    return tables.lines().select("supplier", "date", *_zeros(
        new_cases=F.lit(1), new_deaths=_flag(returned), new_tests=F.col("units"),
        new_vaccinations=_flag(F.col("units") >= LARGE), boosters=_flag(F.col("units") >= LARGER),
        open_lines=_flag(still_open), open_returns=_flag(still_open & returned),
        accepted=_flag(F.col("flag") == "A"),
    ))


def span(tables: Tables) -> tuple[dt.date, dt.date]:
    """First and last shipping date: two values, used as constants of the calendar."""
    row = tables.lines().agg(F.min("date").alias("a"), F.max("date").alias("b")).first()
    return row["a"], row["b"]


def _reach(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """One row on the day a customer is first reached by a supplier, one when first covered."""
    owners = orders.select("o_orderkey", "o_custkey")
    large = F.when(F.col("units") >= LARGE, F.col("date"))
    pairs = lines.select("l_orderkey", "supplier", "date", large.alias("large_day")).join(
        owners, F.col("l_orderkey") == F.col("o_orderkey")
    ).groupBy("supplier", "o_custkey").agg(
        F.min("date").alias("any_day"), F.min("large_day").alias("large_day")
    )
    days = F.inline(F.array(
        F.struct(F.col("any_day").alias("date"), F.lit(1).alias("r"), F.lit(0).alias("c")),
        F.struct(F.col("large_day").alias("date"), F.lit(0).alias("r"), F.lit(1).alias("c")),
    ))
    return pairs.select("supplier", days).where(F.col("date").isNotNull()).select(
        "supplier", "date", *_zeros(reached=F.col("r"), covered=F.col("c"))
    )


#: What tells one supplier row from another; its days are one series of windows.
ENTITY = ("iso_code", "copy", "location", "series")
#: Daily values whose sums over the last days land, and over how many days.
RECENT = {"new_cases": 14, "new_deaths": 14, "new_vaccinations": 7}
#: The running total behind each cumulative column.
RUNNING = {
    "total_cases": "run_cases", "total_deaths": "run_deaths", "total_tests": "run_tests",
    "total_vaccinations": "run_doses", "people_vaccinated": "run_reached",
    "people_fully_vaccinated": "run_covered", "total_boosters": "run_boosters",
}
ROLLED = tuple((f"rolling_{n}day_{name}", f"new_{name}", n) for n in (7, 14) for name in ("cases", "deaths"))


def entity_rows(tables: Tables) -> DataFrame:
    """Supplier rows: ``copy`` tells those of one key apart, ``series`` is the label, or a key of
    its own where there is none."""
    rows = tables.suppliers()
    copy = F.row_number().over(Window.partitionBy("supplier").orderBy(*rows.columns))
    own = F.concat(F.lit("\u0000"), "iso_code")
    return rows.withColumn("copy", copy).withColumn("series", F.coalesce("location", own))


def one_row_each(tables: Tables) -> bool:
    """Whether every supplier row has a key of its own; labels may be shared."""
    rows = tables.suppliers().where("supplier is not null")
    counts = rows.agg(F.count("supplier").alias("n"), F.countDistinct("supplier").alias("a")).first()
    return counts["n"] == counts["a"]


def one_entity_each(tables: Tables) -> bool:
    """Whether every supplier row has a key and a series of its own."""
    rows = tables.suppliers().where("supplier is not null").select(
        "supplier", F.coalesce("location", F.concat(F.lit("\u0000"), "iso_code")).alias("series")
    )
    counts = rows.agg(*[F.count("supplier").alias("n"), F.countDistinct("supplier").alias("a"),
                        F.countDistinct("series").alias("b")]).first()
    return counts["n"] == counts["a"] == counts["b"]


def activity(
    tables: Tables, first: dt.date, last: dt.date, partitions: int, by: str = "series",
    entities: DataFrame | None = None,
) -> DataFrame:
    """One row per entity and day on which something happened, and one on the calendar's first day.

    It holds the day's sums, the sums of its last days (``recent_*``, by how many days back), all
    running totals and the entity's attributes, and the days until ``until`` differ from it by empty
    daily values alone. Its size follows the shipped lines; land it, since every table derives from
    it. It comes in so many partitions of ``by``, ``series`` or ``iso_code``. ``entities`` is a stored
    ``entity_rows``, whose size Spark knows.
    """
    entities = (entity_rows(tables) if entities is None else entities).drop("supplier")
    blank = tables.read("supplier").select(
        F.col("s_suppkey").alias("supplier"), F.lit(first).alias("date"), *_zeros()
    )
    stacked = shipments(tables).unionByName(blank).unionByName(
        _reach(tables.lines(), tables.read("orders"))
    )
    # A calendar day counts at least nothing, also where all its values are missing.
    floor = F.when(F.col("date").isNotNull(), F.lit(0))
    daily = stacked.groupBy("supplier", "date").agg(*[F.sum(c).alias(c) for c in DAILY_SUMS])
    key = F.concat(F.lit("S"), F.col("supplier").cast("string")).alias("iso_code")
    daily = daily.where("supplier is not null").select(
        key, "date", F.unix_date("date").cast("bigint").alias("day"),
        *[F.coalesce(c, floor).alias(c) for c in DAILY_SUMS],
    )
    # Rows go to their partition while they are narrow: windows, which need rows of one entity
    # together, and buckets share that shuffle. Every frame has the same order: one sort, one pass.
    own = ["iso_code"] if by == "iso_code" else ["series", "iso_code", "copy"]
    daily = daily.join(entities, "iso_code")
    by_day = Window.partitionBy(*own).orderBy("day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def running(c: str):
        return F.sum(c).over(so_far)

    def total(value):
        return F.sum(value).over(whole)

    def before(c: str, days: int):
        return F.sum(c).over(by_day.rangeBetween(Window.unboundedPreceding, -days))

    undated = F.col("date").isNull()
    before_next = F.date_sub(F.lead("date").over(by_day), 1)
    totals = {f"all_{c}": total(c) for c in (
        "new_cases", "new_deaths", "new_tests", "boosters", "open_lines", "accepted"
    )}
    rows = daily.repartition(partitions, by).select(
        *entities.columns, "date",
        F.when(~undated, F.coalesce(before_next, F.lit(last))).alias("until"),
        "new_cases", "new_deaths", "new_tests", "new_vaccinations", "open_lines", "open_returns",
        total("reached").alias("population"),
        running("new_cases").alias("run_cases"), running("new_deaths").alias("run_deaths"),
        running("new_tests").alias("run_tests"), running("new_vaccinations").alias("run_doses"),
        running("boosters").alias("run_boosters"), running("reached").alias("run_reached"),
        running("covered").alias("run_covered"),
        total((F.col("new_cases") > 0).cast("int")).alias("active_days"),
        total(undated.cast("int")).alias("undated"),
        *[total(F.when(undated, F.col(c))).alias(f"undated_{c}") for c in RECENT],
        *[v.alias(c) for c, v in totals.items()],
        *[before(c, k).alias(f"before_{k}_{c}") for c, n in RECENT.items() for k in range(1, n + 1)],
    )
    run = {"new_cases": "run_cases", "new_deaths": "run_deaths", "new_vaccinations": "run_doses"}
    recent = [
        F.array(*[
            F.col(run[c]) - F.coalesce(F.col(f"before_{k}_{c}"), F.lit(0)) for k in range(1, n + 1)
        ]).alias(f"recent_{c}")
        for c, n in RECENT.items()
    ]

    def per_line(c: str, scale: float = 100.0):
        return E.ratio(F.col(f"all_{c}"), F.col("all_new_cases")) * scale

    return rows.select(
        *[c for c in rows.columns if not c.startswith(("before_", "all_", "undated_"))], *recent,
        *[F.coalesce(f"undated_{c}", F.lit(0)).alias(f"undated_{c}") for c in RECENT],
        F.col("all_new_cases").alias("lines"),
        per_line("new_tests", 1.0).alias("median_age"),
        per_line("boosters").alias("aged_65_older"),
        per_line("open_lines").alias("cardiovasc_death_rate"),
        per_line("accepted").alias("diabetes_prevalence"),
        (1 - per_line("new_deaths", 1.0)).alias("human_development_index"),
    )


def _by_windows(dense: DataFrame) -> DataFrame:
    """Means and earlier values by windows over all days of an entity."""
    by_day = Window.partitionBy(*ENTITY).orderBy("date")
    week = by_day.rowsBetween(-6, 0)
    return dense.select(
        "*",
        F.avg("new_cases").over(week).alias("new_cases_smoothed"),
        F.avg("new_deaths").over(week).alias("new_deaths_smoothed"),
        F.avg("new_vaccinations").over(week).alias("new_vaccinations_smoothed"),
        F.lag("new_cases", 7).over(by_day).alias("week_ago"),
    )


def _by_recent_sums(dense: DataFrame, first: dt.date) -> DataFrame:
    """The columns of ``_by_windows`` and, under a leading underscore, those of the cleaning's fill and
    rolling means, from the sums that landed: for entities of a key of their own; what has an underscore
    only for those of a series of their own as well.

    A day's sum over n days is that of its activity row, ``_gone`` days before, over as many fewer.
    The row without a date counts as the day before the first; cleaning drops it.
    """
    gone, age = F.col("_gone"), F.datediff("date", F.lit(first))

    def last_days(c: str, n: int) -> Column:
        return F.when(gone < n, F.get(f"recent_{c}", F.lit(n - 1) - gone)).otherwise(F.lit(0))

    def smoothed(c: str) -> Column:
        early = F.when(age < 6, F.col(f"undated_{c}")).otherwise(F.lit(0))
        mean = (last_days(c, 7) + early) / F.least(F.lit(7), age + 1 + F.col("undated"))
        return F.when(F.col("date").isNull(), F.col(c).cast("double")).otherwise(mean)

    recent = F.col("recent_new_cases")
    dated = F.col("run_cases") - F.col("undated_new_cases") > 0
    back = F.get(recent, F.lit(7)) - F.get(recent, F.lit(6))
    return dense.select(
        "*",
        *[smoothed(c).alias(f"{c}_smoothed") for c in RECENT],
        # Asked of days with cases only, which are rows of the activity.
        F.when(age >= 7, back).when((age == 6) & (F.col("undated") > 0), F.col("undated_new_cases"))
        .alias("week_ago"),
        *[F.when(dated, F.col(run)).alias(f"_{c}") for c, run in RUNNING.items()],
        *[
            (last_days(c, n) / F.least(F.lit(n), age + 1)).alias(f"_{name}")
            for name, c, n in ROLLED
        ],
    )


def filled_and_rolled(panel: DataFrame) -> DataFrame:
    """The ordered steps of cleaning where the rows bring along what they need (``entity_panel``)."""
    labelled = F.col("location").isNotNull()
    made = {c: F.when(labelled, F.col(f"_{c}")).otherwise(F.col(c)) for c in RUNNING}
    made |= {name: F.when(labelled, F.col(f"_{name}")) for name, _, _ in ROLLED}
    return panel.withColumns(made).drop(*[f"_{c}" for c in made])


def entity_panel(
    active: DataFrame, first: dt.date | None = None, alone: bool = True
) -> DataFrame:
    """The raw panel of the entities, and ``series``: every calendar day, spread out in place.

    Over ``activity`` bucketed by series nothing is shuffled, and columns that nobody asks for are
    not computed. With the calendar's ``first`` day nothing is sorted either; then no two entities may
    share a key. If every series is ``alone`` as well, the columns that ``filled_and_rolled`` needs
    are there.
    """
    daily = [c for c in active.columns if c in DAILY_SUMS]
    days = F.when(F.col("date").isNull(), F.array("date")).otherwise(F.sequence("date", "until"))
    spread = active.withColumn("day", F.explode(days))
    own = F.col("day").eqNullSafe(F.col("date"))
    dense = spread.select(
        F.col("day").alias("date"), *[c for c in active.columns if c not in ("date", "until", *daily)],
        *[F.when(own, F.col(c)).otherwise(F.lit(0)).alias(c) for c in daily],
        F.datediff("day", "date").alias("_gone"),
    )
    wide = _by_windows(dense) if first is None else _by_recent_sums(dense, first)
    brought = [] if first is None or not alone else [f"_{c}" for c in (*RUNNING, *[r[0] for r in ROLLED])]
    reported = F.col("new_cases") > 0

    def shown(c: str):
        return F.when(reported, F.col(c))

    def per_million(value):
        return E.ratio(value, F.col("population")) * 1_000_000

    return wide.select(
        "iso_code", "continent", "location", "date",
        shown("run_cases").alias("total_cases"),
        shown("new_cases").alias("new_cases"),
        "new_cases_smoothed",
        per_million(F.col("run_cases")).alias("total_cases_per_million"),
        per_million(shown("new_cases")).alias("new_cases_per_million"),
        shown("run_deaths").alias("total_deaths"),
        shown("new_deaths").alias("new_deaths"),
        "new_deaths_smoothed",
        per_million(F.col("run_deaths")).alias("total_deaths_per_million"),
        per_million(shown("new_deaths")).alias("new_deaths_per_million"),
        shown("run_tests").alias("total_tests"),
        shown("new_tests").alias("new_tests"),
        E.ratio(F.col("new_cases"), F.col("new_tests")).alias("positive_rate"),
        shown("open_returns").cast("double").alias("icu_patients"),
        shown("open_lines").cast("double").alias("hosp_patients"),
        shown("run_doses").alias("total_vaccinations"),
        shown("run_reached").alias("people_vaccinated"),
        shown("run_covered").alias("people_fully_vaccinated"),
        shown("run_boosters").alias("total_boosters"),
        shown("new_vaccinations").alias("new_vaccinations"),
        "new_vaccinations_smoothed", "population",
        E.ratio(F.col("lines"), F.col("active_days")).alias("population_density"),
        "median_age", "aged_65_older", "gdp_per_capita", "cardiovasc_death_rate",
        "diabetes_prevalence", F.col("active_days").cast("double").alias("life_expectancy"),
        "human_development_index",
        (E.ratio(F.col("open_lines"), F.col("new_cases")) * 100).alias("stringency_index"),
        E.ratio(shown("new_cases"), F.col("week_ago")).alias("reproduction_rate"), "series",
        *brought,
    )


def regions(active: DataFrame) -> DataFrame:
    """Aggregate entities: shipments and returns per region and day."""
    shipped = active.where("new_cases > 0")
    return shipped.groupBy("continent", "date").agg(
        F.sum("new_cases").alias("new_cases"), F.sum("new_deaths").alias("new_deaths")
    ).select(
        F.concat(F.lit(AGGREGATE_PREFIX), "continent").alias("iso_code"),
        F.col("continent").alias("location"), "date", "new_cases", "new_deaths",
    )


def raw_panel(active: DataFrame, first: dt.date | None = None) -> DataFrame:
    """The raw panel in its source columns: entities, and the regions that cleaning must drop."""
    entities = entity_panel(active, first).select(*RAW_COLUMNS)
    return entities.unionByName(regions(active), allowMissingColumns=True).select(*RAW_COLUMNS)


def as_text(raw: DataFrame) -> DataFrame:
    """The raw panel the way a CSV holds it: every value text, missing ones NULL."""
    return raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
