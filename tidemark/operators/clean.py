"""Cleaning steps, each DataFrame -> DataFrame, and their composition."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import exprs as E
from tidemark.operators.panel import carried, one_row_per_key, rolling_mean, row_mean
from tidemark.sources.shared import materialise
from tidemark.spec import AGGREGATE_PREFIX, COUNT_COLUMNS, EPIDEMIC, PanelSpec

FEW = 2_000_000  # repeated keys whose hashes are broadcast: 16 MB


def drop_aggregate_rows(
    panel: DataFrame, prefix: str = AGGREGATE_PREFIX, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Remove rows standing for groups of entities; a missing code is no such row."""
    is_aggregate = F.coalesce(F.col(spec.entity).startswith(prefix), F.lit(False))
    return panel.where(~is_aggregate)


def parse_dates(panel: DataFrame, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    """Typed date; rows whose date cannot be read are dropped."""
    day = F.col(spec.date)
    if panel.schema[spec.date].dataType.simpleString() == "string":
        day = F.coalesce(F.try_to_date(day, "yyyy-MM-dd"), day.try_cast("date"))
    return panel.withColumn(spec.date, day.cast("date")).where(F.col(spec.date).isNotNull())


def sort_panel(panel: DataFrame, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    """Presentation order. No operator relies on it: windows carry their own ordering."""
    return panel.orderBy(spec.label, spec.date)


def cast_numeric(
    panel: DataFrame, columns: tuple[str, ...], whole: tuple[str, ...] = ()
) -> DataFrame:
    """Text to double; unreadable text and NaN become NULL. ``whole`` columns round to bigint."""
    casts = {}
    for c in columns:
        if c not in panel.columns:
            continue
        number = F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double"))
        if c in whole:
            # Rounding goes through decimal text, which whole numbers need not.
            number = F.when(F.rint(number) == number, number).otherwise(F.round(number))
        casts[c] = number.try_cast("bigint") if c in whole else number
    return panel.withColumns(casts)


def zero_fill(panel: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return panel.fillna(0, [c for c in columns if c in panel.columns])


def derived_rates(panel: DataFrame) -> DataFrame:
    return panel.withColumns({
        "case_fatality_rate": E.case_fatality_rate(),
        "vaccination_rate": E.vaccination_rate(),
        "tests_per_case": E.tests_per_case(),
        "mortality_rate_per_million": E.per_million("total_deaths"),
    })


def date_parts(panel: DataFrame, date: str = "date") -> DataFrame:
    """Year, month, ISO week, and day of week with Monday as 0."""
    return panel.withColumns({
        "year": F.year(date),
        "month": F.month(date),
        "week": F.weekofyear(date),
        "day_of_week": F.weekday(date),
    })


def ensure_smoothed(
    panel: DataFrame, source: str, smoothed: str, spec: PanelSpec = EPIDEMIC
) -> DataFrame:
    """Add the 7-row mean when the smoothed column is absent, or 0 when its source is too."""
    if smoothed in panel.columns:
        return panel
    if source not in panel.columns:
        return panel.withColumn(smoothed, F.lit(0.0))
    return rolling_mean(panel, {source: smoothed}, 7, spec.label, spec.date)


def ensure_per_million(summary: DataFrame) -> DataFrame:
    """Rebuild the per-million columns that are absent."""
    out = summary
    for column, source in (
        ("total_cases_per_million", "total_cases"),
        ("mortality_rate_per_million", "total_deaths"),
    ):
        if column not in out.columns and source in out.columns:
            scaled = E.ratio(F.col(source), F.col("population")) * 1_000_000
            out = out.withColumn(column, scaled)
    return out


def _group_key(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Partition key of the ordered steps: the label, or the row's own hash when it has none.

    Unlabelled rows belong to no series. Giving each its own key also spreads them over the
    cluster instead of sending them all to the NULL partition.
    """
    own = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in panel.columns]).cast("string"))
    return panel.withColumn("_series", F.coalesce(F.col(spec.label), own))


def _repeated(panel: DataFrame, keys: list[str], label: str | None) -> DataFrame:
    """Hashes of the keys that come more than once.

    With a ``label`` only that and the other keys are read, as it is the first key of all rows that
    have one; rows without are looked at again, with the key they have, if there are any.
    """
    def hashed(first: Column) -> Column:
        return F.xxhash64(first, *[F.col(k) for k in keys[1:]]).alias("_again")

    def counted(rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.select(*by).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))

    if label is None:
        return counted(panel, keys).where("_n > 1").select(hashed(F.col(keys[0])))
    named = F.col(label).isNotNull()
    seen = materialise(counted(panel, [label, *keys[1:]]).where((F.col("_n") > 1) | ~named))
    again = seen.where(named).select(hashed(F.col(label).cast(panel.schema[keys[0]].dataType)))
    if seen.where(~named).isEmpty():
        return again
    return again.unionByName(_repeated(panel.where(~named), keys, None))


def settle_duplicates(panel: DataFrame, keys: list[str], label: str | None = None) -> DataFrame:
    """One row per key, as ``one_row_per_key``, without moving rows whose key is alone.

    Repeated keys are found first, by a pass that keeps keys only. If they are few (at most ``FEW``
    hashes of 8 bytes) these go to the rows, and only the rows they meet are looked at again; the
    hash may let another key in, which does no harm there. Otherwise all rows are settled as one.
    ``label`` names a column that the first key equals wherever it is not NULL.
    """
    hashed = F.xxhash64(*[F.col(k) for k in keys])
    again = materialise(_repeated(panel, keys, label).distinct())
    found = again.count()
    if not found:
        return panel
    if found > FEW:
        return one_row_per_key(panel, keys)
    marked = panel.withColumn("_again", hashed)
    alone = marked.join(F.broadcast(again), "_again", "left_anti").drop("_again")
    twice = marked.join(F.broadcast(again), "_again", "left_semi").drop("_again")
    return alone.unionByName(one_row_per_key(twice, keys))


def carry_and_roll(panel: DataFrame, key: str, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    """Cumulative columns filled forward and both rolling means: one window pass over ``key``."""
    labelled = F.col(spec.label).isNotNull()
    return panel.withColumns({
        **{
            c: F.when(labelled, carried(c, key, spec.date)).otherwise(F.col(c))
            for c in spec.cumulative if c in panel.columns
        },
        **{
            f"rolling_{rows}day_{name}":
                F.when(labelled, row_mean(F.col(src), rows, key, spec.date))
            for rows in (7, 14) for src, name in spec.rolled if src in panel.columns
        },
    })


def clean(
    raw: DataFrame, spec: PanelSpec = EPIDEMIC, unique: bool = False,
    whole: tuple[str, ...] = COUNT_COLUMNS, partitions: int | None = None,
    series: str | None = None, ordered: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """All cleaning steps in order.

    The result has one row per (label, date), as the tables it feeds require; ``unique=True``
    declares that the input already does and saves that step's search for repeated keys. The fill and both rolling
    means are one window pass over one shuffle. ``partitions`` fixes that shuffle's width; without
    it the width is chosen at run time from the data's size. ``series`` names a column that equals
    the label where there is one: rows partitioned by it stay where they are, and the result lacks it.
    ``ordered`` takes the window pass's place for rows that bring its results along; it drops what
    it used.
    """
    panel = drop_aggregate_rows(raw, spec=spec)
    panel = parse_dates(panel, spec)
    panel = cast_numeric(panel, spec.numeric, whole)
    key = series or "_series"
    if series is None:
        panel = _group_key(panel, spec)
    if not unique:
        panel = settle_duplicates(panel, [key, spec.date], None if series else spec.label)
    if partitions:
        panel = panel.repartition(partitions, key)
    panel = zero_fill(panel, spec.daily)
    panel = ordered(panel) if ordered else carry_and_roll(panel, key, spec)
    rolled = [c for c in panel.columns if c.startswith("rolling_")]
    rates = derived_rates(panel)
    given = [c for c in raw.columns if c != series and c in panel.columns]
    added = [c for c in rates.columns if c not in panel.columns]
    return date_parts(rates.select(*given, *added, *rolled), spec.date)
