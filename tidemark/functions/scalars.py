"""Whole-frame aggregates used as scalar subqueries.

A scalar subquery is evaluated once and folded into the outer plan as a constant, so no join,
broadcast or single-partition window is needed to compare each row with a global figure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def scalars(df: DataFrame, **aggregates: Column) -> dict[str, Column]:
    """Evaluate the aggregates over ``df`` in one pass; return one column per name."""
    packed = df.agg(F.struct(*[a.alias(n) for n, a in aggregates.items()]).alias("s")).scalar()
    return {name: packed.getField(name) for name in aggregates}
