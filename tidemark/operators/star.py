"""Star schema: entity and calendar dimensions, daily fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.panel import latest_row, latest_values, one_row_per_key
from tidemark.spec import DIM_COLUMNS, EPIDEMIC, FACT_COLUMNS, PanelSpec, column_type


def _has_key(spec: PanelSpec) -> Column:
    return F.col(spec.entity).isNotNull() & (F.col(spec.entity) != "")


def _typed(df: DataFrame, columns: tuple[str, ...]) -> list[Column]:
    """Blank text to NULL, text to its type; whole numbers round instead of truncating."""
    out = []
    for name in columns:
        kind = column_type(name).simpleString()
        if name not in df.columns:
            out.append(F.lit(None).cast(kind).alias(name))
            continue
        col = F.col(name)
        is_text = df.schema[name].dataType.simpleString() == "string"
        if is_text and kind != "string":
            col = F.nullif(F.trim(col), F.lit(""))
        if kind in ("bigint", "int"):
            col = F.round(col.try_cast("double")).try_cast(kind) if is_text else col.cast(kind)
        elif kind != "string":
            col = col.try_cast(kind)
        out.append(col.alias(name))
    return out


def dim_entity(
    panel: DataFrame, spec: PanelSpec = EPIDEMIC, columns: tuple[str, ...] = DIM_COLUMNS,
    last_known: bool = False,
) -> DataFrame:
    """Static attributes per entity: its latest row, or each attribute's last known value."""
    rest = [c for c in columns if c != spec.entity]
    typed = panel.where(_has_key(spec)).select(
        *_typed(panel, columns), F.col(spec.date).try_cast("date").alias(spec.date)
    )
    if last_known:
        return latest_values(typed, spec, spec.entity, rest)
    return latest_row(typed, spec, rest)


def calendar(first: Column, last: Column, one: DataFrame) -> DataFrame:
    """Calendar rows between two scalar dates; ``one`` supplies the single row to expand."""
    day = F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date_key")
    return one.select(day).select(
        "date_key",
        F.year("date_key").alias("year"),
        F.quarter("date_key").alias("quarter"),
        F.month("date_key").alias("month"),
        F.date_format("date_key", "MMMM").alias("month_name"),
        F.dayofmonth("date_key").alias("day_of_month"),
        (F.weekday("date_key") + 1).alias("day_of_week"),
        F.date_format("date_key", "EEEE").alias("day_name"),
        F.weekofyear("date_key").alias("week_of_year"),
    )


def dim_date(panel: DataFrame, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    """Every day from the panel's first to its last date."""
    day = F.col(spec.date).try_cast("date")
    bounds = panel.agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    return calendar(F.col("_first"), F.col("_last"), bounds.where(F.col("_first").isNotNull()))


def bi_calendar(days: DataFrame, day: str = "date_key") -> DataFrame:
    """BI calendar of all whole years that ``days`` touches: Sunday-start weeks, Sunday as day 1."""
    bounds = days.agg(F.min(day).alias("_a"), F.max(day).alias("_b")).where("_a is not null")
    last = F.date_sub(F.add_months(F.trunc("_b", "year"), 12), 1)
    base = calendar(F.trunc("_a", "year"), last, bounds)
    new_year = F.trunc("date_key", "year")
    return base.select(
        "date_key", "year", "quarter", "month",
        F.date_format("date_key", "MMM").alias("month_name"),
        F.floor((F.dayofyear("date_key") + F.dayofweek(new_year) - 2) / 7 + 1).cast("int")
        .alias("week_num"),
        F.dayofweek("date_key").alias("day_of_week"),
        F.date_format("date_key", "yyyy-MM").alias("year_month"),
    )


def labels_name_entities(panel: DataFrame, spec: PanelSpec = EPIDEMIC) -> bool:
    """Whether no entity code goes by two labels, or by none: one row per (label, date) is then one
    per (entity, date). Reads two columns and keeps one row per entity."""
    labels = panel.where(_has_key(spec)).groupBy(spec.entity).agg(
        F.min(spec.label).alias("a"), F.max(spec.label).alias("b"),
        F.count_if(F.col(spec.label).isNull()).alias("bare"),
    )
    return labels.where("bare > 0 or a <> b").isEmpty()


def fact_daily(
    panel: DataFrame, spec: PanelSpec = EPIDEMIC, columns: tuple[str, ...] = FACT_COLUMNS,
    unique: bool = False,
) -> DataFrame:
    """Typed daily fact, one row per (entity, date); rows without either are left out.

    ``unique=True`` declares that the panel already has one row per key.
    """
    typed = panel.where(_has_key(spec)).select(*_typed(panel, columns)).where(
        F.col(spec.date).isNotNull()
    )
    return typed if unique else one_row_per_key(typed, [spec.entity, spec.date])
