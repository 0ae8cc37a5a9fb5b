"""Order-dependent building blocks for daily panels.

A panel has one row per (entity, date) once ``one_row_per_key`` has run, so a window over one
entity never holds more rows than the calendar has days, whatever share of the input that entity
had before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F
from pyspark.sql import types as T

from tidemark.spec import EPIDEMIC, PanelSpec

_FIXED_WIDTH = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
    T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def by_date(
    spec: PanelSpec = EPIDEMIC, key: str | None = None, rows: int | None = None
) -> WindowSpec:
    """Rows of one entity in date order, optionally the last ``rows`` of them."""
    w = Window.partitionBy(key or spec.entity).orderBy(spec.date)
    return w if rows is None else w.rowsBetween(1 - rows, 0)


def one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; among different copies the choice depends only on their content.

    ``row_number() = 1`` lets Spark keep a single candidate per key in each map task before the
    shuffle, so a key with very many copies does not reach one reducer in bulk.
    """
    order = F.xxhash64(*[F.col(c) for c in df.columns])
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _is_fixed_width(panel: DataFrame, column: str) -> bool:
    return isinstance(panel.schema[column].dataType, _FIXED_WIDTH)


def _with_text(
    out: DataFrame, panel: DataFrame, texts: list[str], key: str, date: str, known: bool
) -> DataFrame:
    """Add each text column's value at its last date.

    Text cannot live in a hash aggregate's buffer but can be its key: rows are first reduced to
    (key, all texts) with the last date, and only that short list is searched for each latest text.
    """
    if not texts:
        return out
    seen = panel.groupBy(key, *texts).agg(F.max(date).alias("_last"))
    at = F.col("_last")
    picks = [
        F.max_by(c, F.when(F.col(c).isNotNull(), at) if known else at).alias(c) for c in texts
    ]
    return out.join(seen.groupBy(key).agg(*picks), key, "left")


def latest_row(
    panel: DataFrame, spec: PanelSpec = EPIDEMIC, columns: list[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """The whole row of each entity's last date, NULLs included.

    ``max_by`` on fixed-width columns is a hash aggregate: combined in the map tasks, never sorted.
    """
    if where is not None:
        panel = panel.where(where)
    columns = columns or [c for c in panel.columns if c != spec.entity]
    fixed = [c for c in columns if _is_fixed_width(panel, c)]
    texts = [c for c in columns if c not in fixed]
    picks = [(F.max(c) if c == spec.date else F.max_by(c, spec.date)).alias(c) for c in fixed]
    out = panel.groupBy(spec.entity).agg(*(picks or [F.max(spec.date).alias("_last")]))
    out = _with_text(out, panel, texts, spec.entity, spec.date, known=False)
    return out.select(spec.entity, *columns)


def latest_values(
    panel: DataFrame, spec: PanelSpec = EPIDEMIC, key: str | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Each column's last non-NULL value per entity, possibly from different dates."""
    key = key or spec.label
    columns = columns or [c for c in panel.columns if c != key]
    panel = panel.where(F.col(key).isNotNull())
    fixed = [c for c in columns if _is_fixed_width(panel, c)]
    texts = [c for c in columns if c not in fixed]
    picks = [
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(spec.date))).alias(c) for c in fixed
    ]
    out = panel.groupBy(key).agg(*(picks or [F.max(spec.date).alias("_last")]))
    out = _with_text(out, panel, texts, key, spec.date, known=True)
    return out.select(key, *columns)


def carried(column: str, key: str, date: str = "date") -> Column:
    """The column's last known value so far."""
    w = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(column, ignorenulls=True).over(w)


def row_mean(value: Column, rows: int, key: str, date: str = "date") -> Column:
    """Mean over the last ``rows`` rows, or as many as exist; gaps in the calendar are ignored."""
    return F.avg(value).over(Window.partitionBy(key).orderBy(date).rowsBetween(1 - rows, 0))


def fill_forward(panel: DataFrame, columns: list[str], key: str, date: str = "date") -> DataFrame:
    return panel.withColumns({c: carried(c, key, date) for c in columns})


def rolling_mean(
    panel: DataFrame, columns: dict[str, str], rows: int, key: str, date: str = "date"
) -> DataFrame:
    means = {out: row_mean(F.col(src), rows, key, date) for src, out in columns.items()}
    return panel.withColumns(means)


def lagged(panel: DataFrame, column: str, rows: int, spec: PanelSpec = EPIDEMIC) -> Column:
    return F.lag(column, rows).over(by_date(spec))


def day_number(date: str | Column) -> Column:
    return F.datediff(F.col(date) if isinstance(date, str) else date, F.lit("1970-01-01"))


def nearest_date(panel: DataFrame, dates: DataFrame, spec: PanelSpec = EPIDEMIC) -> DataFrame:
    """For each (entity, wanted_date) the row observed closest to it; ties go to the earlier date.

    Each side of the wanted date is an as-of lookup: wanted dates are merged into the entity's
    rows and a window carries the neighbouring observation to them. Work is one sort of rows plus
    requests, with no pairing of the two.
    """
    columns = [c for c in panel.columns if c != spec.entity]
    row = F.struct(F.col(spec.date), *[F.col(c) for c in columns if c != spec.date])
    observed = panel.select(
        spec.entity, F.col(spec.date).alias("_at"), F.lit(0).alias("_ask"), row.alias("_row")
    )
    asked = dates.select(
        spec.entity, F.col("wanted_date").alias("_at"), F.lit(1).alias("_ask"),
        F.lit(None).cast(observed.schema["_row"].dataType).alias("_row"),
    )
    up_to = Window.rowsBetween(Window.unboundedPreceding, 0).partitionBy(spec.entity)
    before = up_to.orderBy("_at", "_ask")
    after = up_to.orderBy(F.desc("_at"), "_ask")
    found = (
        observed.unionByName(asked)
        .withColumn("_prev", F.last("_row", ignorenulls=True).over(before))
        .withColumn("_next", F.last("_row", ignorenulls=True).over(after))
        .where("_ask = 1")
    )
    to_prev = F.datediff("_at", F.col("_prev")[spec.date])
    to_next = F.datediff(F.col("_next")[spec.date], "_at")
    pick = F.when(F.coalesce(to_prev <= to_next, to_prev.isNotNull()), F.col("_prev"))
    return (
        found.withColumn("_hit", pick.otherwise(F.col("_next")))
        .where(F.col("_hit").isNotNull())
        .select(spec.entity, F.col("_at").alias("wanted_date"), "_hit.*")
    )
