"""The whole job: raw CSV to cleaned panel, analysis tables, star schema, checks and view exports."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import quality, views
from tidemark.operators.clean import clean
from tidemark.operators.panel import latest_values
from tidemark.operators.stats import correlation_matrix, correlation_test, risk_scores
from tidemark.operators.star import dim_date, dim_entity, fact_daily, labels_name_entities
from tidemark.operators.waves import detect_peaks, join_for, label_waves
from tidemark.plans.handover import Handover
from tidemark.sources import commits
from tidemark.sources.io import as_staging, export_views, read_raw
from tidemark.sources.shared import fresh_path, materialise
from tidemark.spec import (
    EPIDEMIC, FOCUS_ENTITY, PEAK_DISTANCE, PEAK_PROMINENCE, RAW_COLUMNS, PanelSpec,
)

STAGES = ("clean", "analyse", "star", "validate", "export")
STAGE_OF = {
    **dict.fromkeys(("panel", "focus", "summary", "sanity"), "clean"),
    **dict.fromkeys(("waves", "correlations", "correlation_tests", "risk"), "analyse"),
    **dict.fromkeys(("staging", "dim_entity", "dim_date", "fact"), "star"),
    **dict.fromkeys(("reconciliation", "constraints"), "validate"),
}


@dataclass
class Settings:
    focus: str = FOCUS_ENTITY
    distance: int = PEAK_DISTANCE
    least: float = PEAK_PROMINENCE
    min_pop: int = 1_000_000
    unique: bool = False
    spec: PanelSpec = EPIDEMIC
    stages: tuple[str, ...] = STAGES


@dataclass
class Outcome:
    status: dict[str, str] = field(default_factory=dict)
    tables: dict[str, str] = field(default_factory=dict)

    @property
    def exit_code(self) -> int:
        return int(any(s.startswith("failed") for s in self.status.values()))


def view_builders(
    fact: DataFrame, dim: DataFrame, dates: DataFrame, focus: str = FOCUS_ENTITY,
    min_pop: int = 1_000_000,
) -> dict:
    """The eight views by name, each built only when called.

    Five of them read one stored snapshot and one stored rollup, made when the first of them is
    built; the trend, the focus's rows and the covered rows are a scan each.
    """
    @cache
    def current() -> DataFrame:
        return materialise(views.snapshot(fact))

    @cache
    def months() -> DataFrame:
        return materialise(views.rollup(fact))

    return {
        "v_global_daily_trend": lambda: views.global_daily_trend(fact),
        "v_continental_summary": lambda: views.continental_summary(fact, dim, current=current()),
        "v_country_latest": lambda: views.country_latest(fact, dim, current=current()),
        "v_entity_timeline": lambda: views.entity_timeline(fact, dates, focus),
        "v_monthly_by_group": lambda: views.monthly_by_group(fact, dim, months=months()),
        "v_coverage_progress": lambda: views.coverage_progress(fact, dim, current=current()),
        "v_high_risk": lambda: views.high_risk(fact, dim, min_pop, current=current()),
        "v_wave_summary": lambda: views.wave_summary(fact, dim, min_pop, months=months()),
    }


def run_stages(
    spark: SparkSession, source: str, out: str, settings: Settings | None = None
) -> Outcome:
    """Run the chosen stages; a failed cleaning stops the run, later failures do not.

    Stages hand over through tables in ``out`` (see ``handover``), so a lost executor or a rerun of
    one stage never repeats the ones before it. A stage refuses tables that are unfinished or were
    made from other rows than those that lie there now, whichever call wrote them.
    """
    s = settings or Settings()
    result = Outcome()
    hand = Handover(spark, out, STAGE_OF)
    table = hand.read

    def save(name: str, df: DataFrame, *inputs: str, about: dict | None = None) -> None:
        result.tables[name] = hand.save(name, df, inputs, about)

    def clean_stage() -> None:
        raw = read_raw(spark, source, RAW_COLUMNS).frame
        files, size = commits.size_of(spark, source) if not any(c in source for c in "*?[{") else (0, 0)
        about = {"source": source, "files": files, "bytes": size}
        save("panel", clean(raw, s.spec, unique=s.unique), about=about)
        panel = table("panel")
        save("focus", panel.where(panel[s.spec.entity] == s.focus), "panel")
        save("summary", latest_values(panel, s.spec), "panel")
        save("sanity", quality.sanity_counts(panel), "panel")

    def analyse_stage() -> None:
        panel, summary = table("panel"), table("summary")
        found = fresh_path(spark, "peaks")
        detect_peaks(panel, distance=s.distance, least=s.least, spec=s.spec).write.parquet(found)
        peaks = spark.read.parquet(found)
        # Blank codes are no names, and may stand for several labels.
        blank = panel.where(panel[s.spec.entity] == "")
        unique = blank.isEmpty() and labels_name_entities(panel, s.spec)
        save("waves", label_waves(panel, peaks, s.spec, unique, join_for(peaks)), "panel")
        save("correlations", correlation_matrix(summary), "summary")
        pair = ("vaccination_rate", "case_fatality_rate")
        tests = [correlation_test(summary, *pair, method=m) for m in ("pearson", "spearman")]
        save("correlation_tests", tests[0].unionByName(tests[1]), "summary")
        save("risk", risk_scores(summary, s.spec), "summary")

    def star_stage() -> None:
        labelled = table("waves")
        save("staging", as_staging(labelled), "waves")
        save("dim_entity", dim_entity(labelled, s.spec), "waves")
        save("dim_date", dim_date(labelled, s.spec), "waves")
        # Typed rows, not the staged text: they are parsed and settled already.
        unique = labels_name_entities(labelled, s.spec)
        save("fact", fact_daily(labelled, s.spec, unique=unique), "waves")

    def validate_stage() -> None:
        fact = table("fact")
        save("reconciliation", quality.reconcile(table("staging"), fact), "staging", "fact")
        report = quality.constraint_report(fact, table("dim_entity"), table("dim_date"))
        save("constraints", report, "fact", "dim_entity", "dim_date")

    def export_stage() -> None:
        fact, dim, dates = table("fact"), table("dim_entity"), table("dim_date")
        builders = view_builders(fact, dim, dates, s.focus, s.min_pop)
        for name, state in export_views(builders, f"{out}/views").items():
            result.status[name] = state

    work = {
        "clean": clean_stage, "analyse": analyse_stage, "star": star_stage,
        "validate": validate_stage, "export": export_stage,
    }
    for name in STAGES:
        if name not in s.stages:
            result.status[name] = "skipped"
            continue
        try:
            work[name]()
            result.status[name] = "ok"
        except Exception as err:  # noqa: BLE001 - reported in the outcome
            result.status[name] = f"failed: {err}"
            if name == "clean":
                break
    return result


