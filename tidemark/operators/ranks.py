"""Ranking without handing a whole table to one task.

Rows are cut into value ranges by ``repartitionByRange``, ranked inside each range and shifted by the
number of rows in the ranges before it, at every size. Equal values are collapsed to one row with a count first, so a very frequent value costs
one row, and one group's values spread over many ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.scalars import scalars
from tidemark.sources.shared import materialise

Order = list[tuple[str, str]]


def _sort(order: Order) -> list[Column]:
    return [
        F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last()
        for c, way in order
    ]


def running_counts(
    counts: DataFrame, order: Order, by: list[str] | None = None, columns: tuple[str, ...] = ("copies",)
) -> DataFrame:
    """``counts`` with ``_before_`` and each of its ``columns``: the sum over the rows ordered before.

    ``counts`` has one row per value within ``by``. ``_nth`` numbers them.
    """
    by = by or []
    ranged = counts.repartitionByRange(*[F.col(c) for c in by], *_sort(order))
    # The slice number is stored with the rows: both uses below must see the same cut.
    sliced = materialise(ranged.withColumn("_slice", F.spark_partition_id()))
    sizes = sliced.groupBy(*by, "_slice").agg(
        F.count(F.lit(1)).alias("_values"), *[F.sum(c).alias(f"_sum_{c}") for c in columns]
    )
    # One row per (group, slice): with no group that is at most the number of partitions.
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(c).alias(f"_s_{c}") for c in [*by, "_slice"]],
        F.coalesce(F.sum("_values").over(earlier), F.lit(0)).alias("_value0"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_start_{c}") for c in columns],
    )
    inside = Window.partitionBy(*by, "_slice").orderBy(*_sort(order))
    above = inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = sliced.withColumns({
        "_nth": F.row_number().over(inside),
        **{f"_in_{c}": F.coalesce(F.sum(c).over(above), F.lit(0)) for c in columns},
    })
    on = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in [*by, "_slice"]]
    return numbered.join(starts, on).select(
        *counts.columns, (F.col("_value0") + F.col("_nth")).alias("_nth"),
        *[(F.col(f"_start_{c}") + F.col(f"_in_{c}")).alias(f"_before_{c}") for c in columns],
    )


def value_ranks(df: DataFrame, order: Order, by: list[str] | None = None) -> DataFrame:
    """Per distinct value: ``copies``, competition ``rank`` and ``dense_rank`` within ``by``."""
    by = by or []
    names = [c for c, _ in order]
    counts = df.groupBy(*by, *names).agg(F.count(F.lit(1)).alias("copies"))
    return running_counts(counts, order, by).select(
        *by, *names, "copies", (F.col("_before_copies") + 1).alias("rank"),
        F.col("_nth").alias("dense_rank"),
    )


def with_ranks(
    df: DataFrame, wanted: dict[str, tuple[Order, str]], by: list[str] | None = None
) -> DataFrame:
    """Add a column per (ordering, kind), kind being ``rank``, ``dense_rank`` or ``average``.

    NULLs sort last. ``df`` is scanned for each ordering and once more, so pass a materialised
    frame. Rows meet their value's rank in an equi-join, whose large partitions Spark splits.
    """
    by = by or []
    out = df
    for i, (name, (order, kind)) in enumerate(wanted.items()):
        ranks = value_ranks(df, order, by)
        number = {
            "rank": F.col("rank").cast("int"),
            "dense_rank": F.col("dense_rank").cast("int"),
            "average": F.col("rank") + (F.col("copies") - 1) / 2,
        }[kind]
        names = [*by, *[c for c, _ in order]]
        table = ranks.select(*[F.col(c).alias(f"_k{i}_{c}") for c in names], number.alias(name))
        on = [F.col(c).eqNullSafe(F.col(f"_k{i}_{c}")) for c in names]
        out = out.join(table, on).drop(*[f"_k{i}_{c}" for c in names])
    return out.select(*df.columns, *wanted)


def with_rank(
    df: DataFrame, out: str, order: Order, kind: str = "rank", by: list[str] | None = None
) -> DataFrame:
    """``with_ranks`` for a single column."""
    return with_ranks(df, {out: (order, kind)}, by)


def top_ranked(
    df: DataFrame, out: str, value: str, k: int, by: list[str] | None = None
) -> DataFrame:
    """Rows whose descending competition rank (within ``by``) is at most k, ties included.

    Every row above a top-k value is itself among the first k rows, so ranks follow from k rows per
    group; the tied rows then join that short list instead of meeting in one task.
    """
    by = by or []
    w = Window.partitionBy(*by).orderBy(F.col(value).desc())
    known = df.where(F.col(value).isNotNull())
    if by:
        first = known.select(*by, value).withColumn("_n", F.row_number().over(w)).where(
            F.col("_n") <= k
        ).drop("_n")
    else:
        first = known.select(value).orderBy(F.col(value).desc()).limit(k)
    ranks = first.withColumn(out, F.rank().over(w)).distinct()
    ranks = ranks.select(*[F.col(c).alias(f"_k_{c}") for c in [*by, value]], out)
    on = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*by, value]]
    ranks = ranks if by else F.broadcast(ranks)  # without groups at most k rows
    return known.join(ranks, on).select(*df.columns, out)


def top_rows(df: DataFrame, order: Order, n: int) -> DataFrame:
    """First n rows of a total order; a distributed top-k, never a full sort."""
    return df.orderBy(*_sort(order)).limit(n)


def quantile(df: DataFrame, column: str, q: float) -> Column:
    """Exact linearly interpolated quantile as a scalar: NULL if no value is known.

    The two order statistics around the position are looked up by rank, so no task holds all
    values. ``df`` is scanned twice, so pass a materialised frame.
    """
    known = df.where(F.col(column).isNotNull()).select(column)
    at = q * (scalars(known, n=F.count(F.lit(1)))["n"] - 1)
    low = F.floor(at)
    ranks = value_ranks(known, [(column, "asc")])

    def holds(i: Column) -> Column:
        return (F.col("rank") <= i + 1) & (F.col("rank") + F.col("copies") > i + 1)

    pair = scalars(
        ranks.select(column, holds(low).alias("is_low"), holds(F.ceil(at)).alias("is_high")),
        lo=F.max(F.when(F.col("is_low"), F.col(column))),
        hi=F.max(F.when(F.col("is_high"), F.col(column))),
    )
    return pair["lo"] + (pair["hi"] - pair["lo"]) * (at - low)
