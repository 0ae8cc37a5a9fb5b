"""Peak detection and wave labels, for every entity of a panel."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.peaks import find_peaks
from tidemark.operators.panel import day_number
from tidemark.spec import EPIDEMIC, PEAK_DISTANCE, PEAK_PROMINENCE, PanelSpec

FEW_PEAKS = 2_000_000  # dates of four bytes and their entities' codes


def detect_peaks(
    panel: DataFrame, value: str = "new_cases_smoothed", distance: int = PEAK_DISTANCE,
    least: float = PEAK_PROMINENCE, spec: PanelSpec = EPIDEMIC, fallback: str = "new_cases",
) -> DataFrame:
    """(entity, date, height) of each peak. Missing values count as 0.

    One group is one entity's daily series, as long as the calendar at most.
    """
    if value not in panel.columns:
        value = fallback
    entity_type = panel.schema[spec.entity].dataType.simpleString()
    series = panel.select(
        F.col(spec.entity).alias("entity"), day_number(spec.date).alias("day"),
        F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("x"),
    )

    def peaks_of(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("day")
        return rows.take(find_peaks(rows["x"].to_numpy(), distance, least))

    found = series.groupBy("entity").applyInArrow(
        peaks_of, f"entity {entity_type}, day int, x double"
    )
    return found.select(
        F.col("entity").alias(spec.entity),
        F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")).alias(spec.date),
        F.col("x").alias("height"),
    )


def join_for(peaks: DataFrame) -> str:
    """How stored ``peaks`` reach the rows of their entities: whole to every machine if they are few,
    else by a shuffle."""
    return "broadcast" if peaks.count() <= FEW_PEAKS else "shuffle_hash"


def label_waves(
    panel: DataFrame, peaks: DataFrame, spec: PanelSpec = EPIDEMIC, unique: bool = False,
    join: str = "shuffle_hash",
) -> DataFrame:
    """Wave number of each row: a new wave starts at every peak but the last.

    Rows before the second boundary are wave 1, everything from the last peak on is wave k.
    ``unique=True`` declares that the panel has one row per (entity, date), those of all peaks
    included; an entity's peaks then go to its rows as one list, by ``join``, and no row is sorted.
    """
    if unique:
        lists = peaks.where(F.col(spec.date).isNotNull()).groupBy(spec.entity).agg(
            F.collect_set(spec.date).alias("_peaks")
        )
        day, total = F.col(spec.date), F.coalesce(F.array_size("_peaks"), F.lit(0))
        passed = F.coalesce(F.array_size(F.filter("_peaks", lambda p: p <= day)), F.lit(0))
        wave = F.greatest(F.lit(1), F.least(passed + 1, total)).cast("int")
        rest = [c for c in panel.columns if c not in (spec.entity, spec.date)]
        return panel.join(lists.hint(join), spec.entity, "left").select(
            spec.entity, spec.date, *rest, wave.alias("wave_number")
        )
    flags = peaks.select(spec.entity, spec.date, F.lit(1).alias("_peak"))
    whole = Window.partitionBy(spec.entity)
    so_far = whole.orderBy(spec.date).rowsBetween(Window.unboundedPreceding, 0)
    passed = F.count("_peak").over(so_far)
    total = F.count("_peak").over(whole)
    wave = F.greatest(F.lit(1), F.least(passed + 1, total)).cast("int")
    return panel.join(flags, [spec.entity, spec.date], "left").withColumn(
        "wave_number", wave
    ).drop("_peak")
