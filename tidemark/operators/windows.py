"""Aggregates over any number of date windows, overlapping or not, without comparing rows to windows.

Days are cut into blocks of 1, 8, 64, ... days. A day's rows are combined first, then each block's;
every window is a disjoint union of at most 14 blocks of each size, so it meets its blocks in an
equi-join and adds them up. The work is that of the days and of the windows, never of their product.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.panel import day_number

WIDTH, LEVELS = 8, 4  # the largest blocks have 8^4 days


def _named(level: int) -> Callable[[Column], Column]:
    return lambda block: F.struct(F.lit(level).alias("level"), block.alias("block"))


def _blocks(first: Column, last: Column) -> Column:
    """The blocks (level, block) that together are the days ``first`` to ``last``."""
    low, high = day_number(first), day_number(last) + 1
    none = F.array().cast("array<int>")
    parts = []
    for level in range(LEVELS + 1):
        size = WIDTH ** level
        a = F.ceil(low / size).cast("int")
        b = F.floor(high / size).cast("int")
        # Blocks up to the next larger one, and from the last larger one on.
        up, down = b, b
        if level < LEVELS:
            up = F.least((F.ceil(a / WIDTH) * WIDTH).cast("int"), b)
            down = F.greatest((F.floor(b / WIDTH) * WIDTH).cast("int"), up)
        own = F.concat(
            F.when(a < up, F.sequence(a, F.greatest(a, up - 1))).otherwise(none),
            F.when(down < b, F.sequence(down, F.greatest(down, b - 1))).otherwise(none),
        )
        parts.append(F.transform(F.when(a < b, own).otherwise(none), _named(level)))
    return F.concat(*parts)


def over_windows(
    rows: DataFrame, windows: DataFrame, partial: dict[str, Column],
    merge: dict[str, Callable[[str], Column]], by: tuple[str, ...] = (), date: str = "date",
    first: str = "start_date", last: str = "end_date",
) -> DataFrame:
    """The windows (all their columns) with the aggregates of the rows that fall on their days.

    ``partial`` makes each aggregate from rows, ``merge`` from partial ones of disjoint days.
    ``by`` are columns of both sides that must be equal. Windows that end before they start, or
    hold no row, or have a NULL among ``by`` or their dates, are left out; equal windows are one.
    """
    daily = rows.where(F.col(date).isNotNull()).groupBy(*by, F.col(date).alias("_date")).agg(
        *[c.alias(n) for n, c in partial.items()]
    )
    day = day_number("_date")
    levels = F.array(*[
        F.struct(
            F.lit(level).alias("_level"), F.floor(day / WIDTH ** level).cast("int").alias("_block")
        )
        for level in range(LEVELS + 1)
    ])
    merged = [merge[n](n).alias(n) for n in partial]
    blocks = daily.select(*by, *partial, F.inline(levels)).groupBy(*by, "_level", "_block").agg(*merged)
    parts = windows.distinct().where(F.col(first) <= F.col(last)).withColumn(
        "_part", F.explode(_blocks(F.col(first), F.col(last)))
    ).select(*windows.columns, F.col("_part.level").alias("_level"), F.col("_part.block").alias("_block"))
    return parts.join(blocks, [*by, "_level", "_block"]).groupBy(*windows.columns).agg(*merged)
