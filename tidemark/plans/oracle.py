"""The registered queries once more, as plain SQL over the source tables.

Each statement is a chain of common table expressions, pulled in by name as needed, and one SELECT.
They are written apart from the Spark code: joins instead of stacked sums, set logic instead of
window tricks where the two differ.
"""

from __future__ import annotations

import re

from tidemark.plans import catalog as K
from tidemark.spec import (
    AGGREGATE_PREFIX, CORRELATION_METRICS, CUMULATIVE, DAILY, DIM_COLUMNS, FACT_COLUMNS,
    KEY_COLUMNS, NUMERIC, PANEL_COLUMNS, RAW_COLUMNS, column_type,
)


def rnd(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(30,10)), {digits}) AS DOUBLE)"


def d6(expr: str, name: str | None = None) -> str:
    value = dbl(expr)
    scaled = f"({value} * 1e6 + 0.5)"
    whole = f"floor({scaled}) / 1e6"
    return f"CASE WHEN abs({scaled}) < 4503599627370496 THEN {whole} ELSE {value} END AS {name or expr}"


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def ratio(num: str, den: str) -> str:
    return f"({dbl(num)} / NULLIF({dbl(den)}, 0))"


def plain(columns) -> str:
    """Select list of preset columns, doubles as they are."""
    return ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" if column_type(c).simpleString() == "double" else c
        for c in columns
    )


def shown(columns, double=frozenset()) -> str:
    """Select list of preset columns with doubles at six decimals."""
    return ", ".join(
        d6(c) if c in double or column_type(c).simpleString() == "double" else c for c in columns
    )


CTES: dict[str, str] = {}

CTES["lines"] = """
SELECT l_orderkey, l_suppkey AS supplier, CAST(l_quantity AS BIGINT) AS units,
       l_returnflag AS flag, l_linestatus AS status, CAST(l_shipdate AS DATE) AS date
FROM lineitem"""

CTES["days"] = """
SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT min(date) AS a, max(date) AS b FROM lines)"""

CTES["suppliers"] = """
SELECT s_suppkey AS supplier, 'S' || CAST(s_suppkey AS VARCHAR) AS iso_code,
       r_name AS continent, s_name AS location,
       CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS gdp_per_capita
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

CTES["shipped"] = """
SELECT supplier, date, count(*) AS cases, count(*) FILTER (WHERE flag = 'R') AS deaths,
       sum(units) AS tests, count(*) FILTER (WHERE units >= 25) AS doses,
       count(*) FILTER (WHERE units >= 45) AS boosters,
       count(*) FILTER (WHERE status = 'O') AS open_lines,
       count(*) FILTER (WHERE status = 'O' AND flag = 'R') AS open_returns,
       count(*) FILTER (WHERE flag = 'A') AS accepted
FROM lines GROUP BY supplier, date"""

CTES["contacts"] = """
SELECT supplier, o_custkey, min(date) AS any_day,
       min(date) FILTER (WHERE units >= 25) AS large_day
FROM lines JOIN orders ON l_orderkey = o_orderkey GROUP BY supplier, o_custkey"""

CTES["reached"] = "SELECT supplier, any_day AS date, count(*) AS n FROM contacts GROUP BY ALL"
CTES["covered"] = """
SELECT supplier, large_day AS date, count(*) AS n FROM contacts
WHERE large_day IS NOT NULL GROUP BY ALL"""

CTES["fixed"] = """
SELECT supplier, sum(cases) AS lines, count(*) AS active_days, sum(tests) AS tests,
       sum(boosters) AS boosters, sum(open_lines) AS open_lines, sum(accepted) AS accepted,
       sum(deaths) AS deaths,
       (SELECT count(*) FROM contacts c WHERE c.supplier = s.supplier) AS population
FROM shipped s GROUP BY supplier"""

_run = "OVER (PARTITION BY supplier ORDER BY date ROWS UNBOUNDED PRECEDING)"
_week = "OVER (PARTITION BY supplier ORDER BY date ROWS 6 PRECEDING)"


def _mean7(c: str, w: str = _week) -> str:
    return f"CAST(sum(coalesce({c}, 0)) {w} AS DOUBLE) / count(*) {w}"


CTES["grid"] = f"""
SELECT p.supplier, d.date, s.cases, s.deaths, s.tests, s.doses, s.boosters, s.open_lines,
       s.open_returns, r.n AS reached, c.n AS covered
FROM supplier_keys p CROSS JOIN days d
LEFT JOIN shipped s ON s.supplier = p.supplier AND s.date = d.date
LEFT JOIN reached r ON r.supplier = p.supplier AND r.date = d.date
LEFT JOIN covered c ON c.supplier = p.supplier AND c.date = d.date"""
CTES["supplier_keys"] = "SELECT s_suppkey AS supplier FROM supplier"

CTES["runs"] = f"""
SELECT *, sum(cases) {_run} AS run_cases, sum(deaths) {_run} AS run_deaths,
       sum(tests) {_run} AS run_tests, sum(doses) {_run} AS run_doses,
       sum(boosters) {_run} AS run_boosters, sum(reached) {_run} AS run_reached,
       sum(covered) {_run} AS run_covered,
       {_mean7('cases')} AS smooth_cases, {_mean7('deaths')} AS smooth_deaths,
       {_mean7('doses')} AS smooth_doses,
       lag(coalesce(cases, 0), 7) OVER (PARTITION BY supplier ORDER BY date) AS week_ago
FROM grid"""


def _kept(c: str) -> str:
    return f"CASE WHEN cases IS NOT NULL THEN CAST(coalesce({c}, 0) AS BIGINT) END"


def _pm(c: str) -> str:
    return f"{ratio(c, 'population')} * 1000000"


_RAW = {
    "iso_code": "iso_code", "continent": "continent", "location": "location", "date": "date",
    "total_cases": _kept("run_cases"), "new_cases": _kept("cases"),
    "new_cases_smoothed": "smooth_cases",
    "total_cases_per_million": _pm("coalesce(run_cases, 0)"),
    "new_cases_per_million": _pm("cases"),
    "total_deaths": _kept("run_deaths"), "new_deaths": _kept("r.deaths"),
    "new_deaths_smoothed": "smooth_deaths",
    "total_deaths_per_million": _pm("coalesce(run_deaths, 0)"),
    "new_deaths_per_million": _pm("r.deaths"),
    "total_tests": _kept("run_tests"), "new_tests": _kept("r.tests"),
    "positive_rate": ratio("cases", "r.tests"),
    "icu_patients": dbl("open_returns"), "hosp_patients": dbl("r.open_lines"),
    "total_vaccinations": _kept("run_doses"), "people_vaccinated": _kept("run_reached"),
    "people_fully_vaccinated": _kept("run_covered"), "total_boosters": _kept("run_boosters"),
    "new_vaccinations": _kept("doses"), "new_vaccinations_smoothed": "smooth_doses",
    "population": "CAST(population AS BIGINT)",
    "population_density": ratio("lines", "active_days"),
    "median_age": ratio("f.tests", "lines"),
    "aged_65_older": f"{ratio('f.boosters', 'lines')} * 100",
    "gdp_per_capita": "gdp_per_capita",
    "cardiovasc_death_rate": f"{ratio('f.open_lines', 'lines')} * 100",
    "diabetes_prevalence": f"{ratio('f.accepted', 'lines')} * 100",
    "life_expectancy": dbl("active_days"),
    "human_development_index": f"1 - {ratio('f.deaths', 'lines')}",
    "stringency_index": f"{ratio('r.open_lines', 'cases')} * 100",
    "reproduction_rate": ratio("cases", "week_ago"),
}
CTES["series"] = "SELECT " + ", ".join(f"{_RAW[c]} AS {c}" for c in RAW_COLUMNS) + """
FROM runs r JOIN suppliers USING (supplier) LEFT JOIN fixed f USING (supplier)"""
CTES["regions"] = f"""
SELECT '{AGGREGATE_PREFIX}' || continent AS iso_code, continent AS location, date,
       CAST(sum(cases) AS BIGINT) AS new_cases, CAST(sum(deaths) AS BIGINT) AS new_deaths
FROM shipped JOIN suppliers USING (supplier) GROUP BY continent, date"""
CTES["raw"] = "SELECT * FROM series UNION ALL BY NAME SELECT * FROM regions"

_by = "PARTITION BY location ORDER BY date"


def _filled(c: str) -> str:
    return f"last_value({c} IGNORE NULLS) OVER ({_by} ROWS UNBOUNDED PRECEDING)"


def _mean(c: str, rows: int) -> str:
    w = f"OVER ({_by} ROWS {rows - 1} PRECEDING)"
    return f"CAST(sum({c}) {w} AS DOUBLE) / count({c}) {w}"


CTES["filled"] = "SELECT " + ", ".join(
    f"{_filled(c)} AS {c}" if c in CUMULATIVE
    else f"coalesce({c}, 0) AS {c}" if c in DAILY else c for c in RAW_COLUMNS
) + " FROM series"

_RATES = {
    "case_fatality_rate": f"CASE WHEN total_cases > 0 THEN {ratio('total_deaths', 'total_cases')} END",
    "vaccination_rate":
        f"CASE WHEN population > 0 THEN {ratio('people_fully_vaccinated', 'population')} * 100 END",
    "tests_per_case": f"CASE WHEN total_cases > 0 THEN {ratio('total_tests', 'total_cases')} END",
    "mortality_rate_per_million":
        f"CASE WHEN population > 0 THEN {ratio('total_deaths', 'population')} * 1000000 END",
}
_PARTS = {
    "year": "CAST(year(date) AS INTEGER)", "month": "CAST(month(date) AS INTEGER)",
    "week": "CAST(weekofyear(date) AS INTEGER)",
    "day_of_week": "CAST(isodow(date) - 1 AS INTEGER)",
}
CTES["panel"] = "SELECT *, " + ", ".join(
    [f"{e} AS {c}" for c, e in _RATES.items()]
    + [
        f"{_mean(src, rows)} AS rolling_{rows}day_{name}"
        for rows in (7, 14) for src, name in (("new_cases", "cases"), ("new_deaths", "deaths"))
    ]
    + [f"{e} AS {c}" for c, e in _PARTS.items()]
) + " FROM filled"

CTES["dim"] = f"""
SELECT {', '.join(DIM_COLUMNS)} FROM panel p
WHERE date = (SELECT max(date) FROM panel q WHERE q.iso_code = p.iso_code)"""
CTES["dates"] = """
SELECT date AS date_key, CAST(year(date) AS INTEGER) AS year,
       CAST(quarter(date) AS INTEGER) AS quarter, CAST(month(date) AS INTEGER) AS month,
       monthname(date) AS month_name, CAST(day(date) AS INTEGER) AS day_of_month,
       CAST(isodow(date) AS INTEGER) AS day_of_week, dayname(date) AS day_name,
       CAST(weekofyear(date) AS INTEGER) AS week_of_year
FROM (SELECT DISTINCT date FROM days)"""


def _peak_ctes(name: str, source: str, distance: int, least: float) -> None:
    """Peaks of every entity: islands of equal value, greedy spacing by recursion, prominence."""
    CTES[f"{name}_signal"] = f"""
SELECT iso_code, date, row_number() OVER (PARTITION BY iso_code ORDER BY date) AS i,
       coalesce(new_cases_smoothed, 0) AS x FROM {source}"""
    CTES[f"{name}_islands"] = f"""
SELECT iso_code, min(i) AS a, max(i) AS b, min(x) AS x FROM (
  SELECT *, sum(turn) OVER (PARTITION BY iso_code ORDER BY i) AS island FROM (
    SELECT *, CASE WHEN x = lag(x) OVER (PARTITION BY iso_code ORDER BY i) THEN 0 ELSE 1 END AS turn
    FROM {name}_signal))
GROUP BY iso_code, island"""
    CTES[f"{name}_tops"] = f"""
SELECT iso_code, list(struct_pack(i := (a + b) // 2, x := x) ORDER BY x DESC, a DESC) AS rest
FROM (
  SELECT *, lag(x) OVER (PARTITION BY iso_code ORDER BY a) AS l,
         lead(x) OVER (PARTITION BY iso_code ORDER BY a) AS r FROM {name}_islands)
WHERE x > l AND x > r GROUP BY iso_code"""
    CTES[f"{name}_greedy"] = f"""
SELECT iso_code, rest FROM {name}_tops
UNION ALL
SELECT iso_code, list_filter(rest, lambda c: abs(c.i - rest[1].i) >= {distance})
FROM {name}_greedy WHERE len(rest) > 0"""
    CTES[f"{name}_spaced"] = f"""
SELECT iso_code, rest[1].i AS i, rest[1].x AS x FROM {name}_greedy WHERE len(rest) > 0"""
    CTES[f"{name}_walls"] = f"""
SELECT p.iso_code, p.i, p.x,
       coalesce(max(s.i) FILTER (WHERE s.i < p.i AND s.x > p.x), 0) AS l,
       coalesce(min(s.i) FILTER (WHERE s.i > p.i AND s.x > p.x), 1000000000) AS r
FROM {name}_spaced p JOIN {name}_signal s USING (iso_code) GROUP BY ALL"""
    CTES[name] = f"""
SELECT w.iso_code, w.i, any_value(w.x) AS height,
       any_value(s.date) FILTER (WHERE s.i = w.i) AS date
FROM {name}_walls w JOIN {name}_signal s ON s.iso_code = w.iso_code AND s.i > w.l AND s.i < w.r
GROUP BY w.iso_code, w.i
HAVING any_value(w.x) - greatest(
  min(s.x) FILTER (WHERE s.i <= w.i), min(s.x) FILTER (WHERE s.i >= w.i)) >= {least}"""


def _wave_cte(name: str, source: str, peaks: str) -> None:
    CTES[name] = f"""
SELECT p.*, CAST(greatest(1, least(
  1 + (SELECT count(*) FROM {peaks} k WHERE k.iso_code = p.iso_code AND k.date <= p.date),
  (SELECT count(*) FROM {peaks} k WHERE k.iso_code = p.iso_code))) AS INTEGER) AS wave_number
FROM {source} p"""


_peak_ctes("peaks", "panel", K.DISTANCE, K.PROMINENCE)
_peak_ctes("wide_peaks", "panel", 2 * K.DISTANCE, K.PROMINENCE)
_wave_cte("labelled", "panel", "peaks")
_wave_cte("wide_labelled", "panel", "wide_peaks")
CTES["fact"] = f"SELECT {', '.join(FACT_COLUMNS)} FROM labelled"
# The fact without wave numbers, for the many queries that do not read them.
CTES["daily"] = "SELECT {} FROM panel".format(", ".join(c for c in FACT_COLUMNS if c != "wave_number"))
CTES["latest"] = """
SELECT d.* FROM daily d
JOIN (SELECT iso_code, max(date) AS date FROM daily GROUP BY iso_code) USING (iso_code, date)"""
CTES["latest_known"] = """
SELECT d.* FROM daily d JOIN (
  SELECT iso_code, max(date) AS date FROM daily WHERE vaccination_rate IS NOT NULL
  GROUP BY iso_code) USING (iso_code, date)"""
CTES["summary"] = "SELECT location, " + ", ".join(
    f"arg_max({c}, date) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in PANEL_COLUMNS if c != "location"
) + " FROM panel GROUP BY location"
CTES["world"] = """
SELECT 'World' AS iso_code, date, greatest(n, 0) AS new_cases, greatest(m, 0) AS new_deaths,
       greatest(CAST(sum(n) OVER w AS DOUBLE) / count(*) OVER w, 0) AS new_cases_smoothed,
       greatest(CAST(sum(m) OVER w AS DOUBLE) / count(*) OVER w, 0) AS new_deaths_smoothed
FROM (SELECT date, CAST(sum(new_cases) AS BIGINT) AS n, CAST(sum(new_deaths) AS BIGINT) AS m
      FROM panel GROUP BY date)
WINDOW w AS (ORDER BY date ROWS 6 PRECEDING)"""
_peak_ctes("world_peaks", "world", K.DISTANCE, K.PROMINENCE)
_wave_cte("world_labelled", "world", "world_peaks")

_MATERIALISED = {"panel", "raw", "series", "fact", "daily", "summary", "world", "filled", "grid"}


def _needs(sql: str) -> list[str]:
    """CTE names a statement mentions, outside string literals."""
    words = set(re.findall(r"\b[a-z_0-9]+\b", re.sub(r"'[^']*'", "", sql)))
    sources = set(re.findall(r"(?:FROM|JOIN)\s+([a-z_0-9]+)", sql))
    return [n for n in CTES if n in words and n in sources]


def statement(select: str) -> str:
    wanted: list[str] = []

    def visit(name: str) -> None:
        if name in wanted:
            return
        for n in _needs(CTES[name]):
            if n != name:
                visit(n)
        wanted.append(name)

    for n in _needs(select):
        visit(n)
    chain = ", ".join(
        f"{n} AS {'MATERIALIZED ' if n in _MATERIALISED else ''}({CTES[n]})" for n in wanted
    )
    return f"WITH RECURSIVE {chain} {select}" if chain else select


Q: dict[str, str] = {}
_dim_join = "JOIN dim USING (iso_code)"
_cfr = rnd("case_fatality_rate * 100", 4) + " AS cfr_pct"
_vax2 = rnd("vaccination_rate", 2) + " AS vaccination_rate_pct"


# --- sources and sinks
Q["read_typed"] = f"SELECT {plain(PANEL_COLUMNS)} FROM panel"
Q["write_panel"] = Q["read_typed"]
Q["entity_slice"] = f"SELECT {plain(PANEL_COLUMNS)} FROM panel WHERE location = '{K.FOCUS_LABEL}'"
Q["table_or_file"] = """
SELECT branch, iso_code, date, new_cases, CAST(vaccination_rate AS DOUBLE) AS vaccination_rate
FROM daily CROSS JOIN (VALUES ('table'), ('file')) AS b(branch)"""
Q["load_staging"] = """
SELECT iso_code, CAST(date AS VARCHAR) AS date, CAST(total_cases AS VARCHAR) AS total_cases,
       CAST(new_deaths AS VARCHAR) AS new_deaths, (SELECT count(*) FROM daily) AS rows FROM daily"""
Q["insert_new_rows"] = "SELECT iso_code, date, new_cases FROM daily"
Q["reload"] = f"SELECT {plain(DIM_COLUMNS)} FROM dim"

def _named_counts(selects: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS rows FROM ({sql})" for name, sql in selects.items()
    )


# --- cleaning
Q["drop_aggregate_rows"] = f"SELECT {', '.join(KEY_COLUMNS)} FROM series"
Q["parse_dates"] = (
    f"SELECT {', '.join(KEY_COLUMNS)}, CAST(new_cases AS VARCHAR) AS new_cases FROM raw"
)
Q["sort_panel"] = "SELECT location, date, new_cases FROM panel"
Q["cast_numeric"] = "SELECT iso_code, continent, location, CAST(date AS VARCHAR) AS date, " + (
    ", ".join(f"{dbl(c)} AS {c}" for c in NUMERIC)
) + " FROM raw"
Q["ffill_cumulative"] = f"SELECT location, date, {', '.join(CUMULATIVE)} FROM filled"
Q["zero_fill_daily"] = "SELECT iso_code, date, " + ", ".join(
    f"coalesce({c}, 0) AS {c}" for c in DAILY
) + " FROM raw"
for _key, _col in (
    ("case_fatality_rate", "case_fatality_rate"), ("vaccination_rate", "vaccination_rate"),
    ("tests_per_case", "tests_per_case"), ("mortality_per_million", "mortality_rate_per_million"),
):
    Q[_key] = f"SELECT iso_code, date, {d6(_RATES[_col], 'value')} FROM filled"
Q["rolling_7_14"] = "SELECT iso_code, date, new_cases, new_deaths, " + ", ".join(
    d6(f"rolling_{r}day_{c}", f"{c}_{r}") for r in (7, 14) for c in ("cases", "deaths")
) + " FROM panel"
Q["date_parts"] = "SELECT iso_code, date, year, month, week, day_of_week FROM panel"
Q["derive_smoothed"] = (
    f"SELECT iso_code, location, date, new_cases, {d6('rolling_7day_cases', 'new_cases_smoothed')} "
    "FROM panel"
)
Q["per_million_fallback"] = f"""
SELECT location, total_cases, total_deaths, population,
       {d6(ratio('total_cases', 'population') + ' * 1000000', 'total_cases_per_million')},
       {d6(ratio('total_deaths', 'population') + ' * 1000000', 'mortality_rate_per_million')}
FROM summary"""
Q["clip_floor"] = (
    "SELECT iso_code, date, "
    + d6("greatest(new_cases - rolling_7day_cases, 0)", "above_average") + " FROM panel"
)
Q["clean_panel"] = f"SELECT {shown(PANEL_COLUMNS)} FROM panel"
_fatal = ratio("total_deaths", "total_cases")
Q["recovery_rate"] = f"""
SELECT iso_code, date, {d6(f'(1 - {_fatal}) * 100', 'recovery')},
       {d6(f'(1 - coalesce({_fatal}, 0)) * 100', 'recovery_or_100')} FROM daily"""
Q["is_focus_flag"] = f"""
SELECT iso_code, CASE WHEN location = '{K.FOCUS_LABEL}' THEN location ELSE 'Rest of World' END AS flag
FROM dim"""
Q["percent_if_fraction"] = f"""
SELECT location,
       {d6('''CASE WHEN (SELECT max(case_fatality_rate) FROM summary) <= 1
             THEN case_fatality_rate * 100 ELSE case_fatality_rate END''', 'by_column')},
       {d6('''CASE WHEN human_development_index <= 1 THEN human_development_index * 100
             ELSE human_development_index END''', 'by_value')}
FROM summary"""
_log = "(log10(greatest(coalesce({0}, 1e6), 1e4)) - 4) / (log10(1.5e9) - 4)"
_log = f"least(greatest({_log}, 0), 1)"
_pop = "coalesce(CAST(population AS DOUBLE), 1e6)"
_lin = f"""least(greatest(({_pop} - min({_pop}) OVER (PARTITION BY continent))
  / (max({_pop}) OVER (PARTITION BY continent) - min({_pop}) OVER (PARTITION BY continent) + 1),
  0), 1)"""
Q["log_weight"] = f"""
SELECT iso_code, {d6(_log.format('CAST(population * 1000 AS DOUBLE)'), 'log')},
       {d6(_lin, 'linear')} FROM dim"""

# --- star schema and quality
Q["dim_entity"] = f"SELECT {shown(DIM_COLUMNS)} FROM dim"
Q["dim_entity_last_known"] = "SELECT iso_code, " + ", ".join(
    d6(f"max({c})", c) if column_type(c).simpleString() == "double" else f"max({c}) AS {c}"
    for c in DIM_COLUMNS if c != "iso_code"
) + " FROM panel GROUP BY iso_code"
Q["dim_date"] = "SELECT * FROM dates"
Q["fact_daily"] = f"SELECT {shown(FACT_COLUMNS)} FROM fact"
Q["latest_row"] = f"""
SELECT {shown(FACT_COLUMNS)} FROM fact f
WHERE date = (SELECT max(date) FROM fact g WHERE g.iso_code = f.iso_code)"""
Q["latest_values"] = f"SELECT {shown(PANEL_COLUMNS)} FROM summary"
Q["check_ranges"] = """
SELECT 'case_fatality_rate_above_1' AS rule, count(*) AS bad FROM panel WHERE case_fatality_rate > 1
UNION ALL
SELECT 'vaccination_rate_above_150', count(*) FROM panel WHERE vaccination_rate > 150
UNION ALL SELECT 'new_cases_negative', count(*) FROM panel WHERE new_cases < 0"""
Q["check_row_counts"] = """
SELECT s AS source_rows, f AS fact_rows, abs(s - f) AS difference,
       abs(s - f) <= greatest(1, floor(s * 0.01)) AS within_tolerance
FROM (SELECT count(*) AS s FROM panel) CROSS JOIN (SELECT count(*) AS f FROM daily)"""
Q["check_keys"] = """
SELECT 'fact_key_repeated' AS rule, count(*) AS violations
FROM (SELECT iso_code, date FROM daily GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'entity_key_repeated', count(*)
FROM (SELECT iso_code FROM dim GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'date_key_repeated', count(*)
FROM (SELECT date_key FROM dates GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'fact_entity_unknown', count(*) FROM daily
WHERE iso_code NOT IN (SELECT iso_code FROM dim)
UNION ALL SELECT 'fact_date_unknown', count(*) FROM daily
WHERE date NOT IN (SELECT date_key FROM dates)
UNION ALL SELECT 'date_quarter_range', count(*) FROM dates WHERE quarter NOT BETWEEN 1 AND 4
UNION ALL SELECT 'date_month_range', count(*) FROM dates WHERE month NOT BETWEEN 1 AND 12
UNION ALL SELECT 'date_day_of_week_range', count(*) FROM dates WHERE day_of_week NOT BETWEEN 1 AND 7
UNION ALL SELECT 'date_year_missing', count(*) FROM dates WHERE year IS NULL
UNION ALL SELECT 'entity_label_missing', count(*) FROM dim WHERE location IS NULL
UNION ALL SELECT 'fact_entity_missing', count(*) FROM daily WHERE iso_code IS NULL
UNION ALL SELECT 'fact_date_missing', count(*) FROM daily WHERE date IS NULL"""
Q["dataset_summary"] = """
SELECT count(*) AS rows, count(DISTINCT iso_code) AS entities, min(date) AS first_date,
       max(date) AS last_date FROM panel"""
_share = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg(CAST({c} IS NULL AS INTEGER)) * 100 AS missing_pct FROM panel"
    for c in PANEL_COLUMNS
)
CTES["missing"] = _share
Q["missing_profile"] = (
    f"SELECT column_name, {d6('missing_pct')} FROM missing WHERE missing_pct > 0"
)
CTES["missing_months"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, strftime(date, '%Y-%m') AS month, "
    f"avg(CAST({c} IS NULL AS INTEGER)) * 100 AS missing_pct FROM panel GROUP BY 2"
    for c in PANEL_COLUMNS if c != "date"
)
Q["missing_by_month"] = f"""
SELECT column_name, month, {d6('missing_pct')} FROM missing_months
WHERE column_name IN (
  SELECT column_name FROM missing WHERE missing_pct > 5 AND missing_pct < 95
  ORDER BY missing_pct DESC, column_name LIMIT 20)"""
Q["bi_calendar"] = """
SELECT date AS date_key, CAST(year(date) AS INTEGER) AS year,
       CAST(quarter(date) AS INTEGER) AS quarter, CAST(month(date) AS INTEGER) AS month,
       left(monthname(date), 3) AS month_name,
       CAST(1 + count(*) FILTER (WHERE dayofweek(date) = 0 AND dayofyear(date) > 1)
         OVER (PARTITION BY year(date) ORDER BY date) AS INTEGER) AS week_num,
       CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, strftime(date, '%Y-%m') AS year_month
FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT date_trunc('year', min(date)) AS a,
              date_trunc('year', max(date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS b FROM days))"""

# --- views
Q["v_global_daily_trend"] = f"""
SELECT date, {big('sum(new_cases)', 'global_new_cases')},
       {big('sum(new_deaths)', 'global_new_deaths')},
       {rnd('avg(new_cases_smoothed)', 2)} AS avg_smoothed_cases,
       {rnd('avg(new_deaths_smoothed)', 2)} AS avg_smoothed_deaths,
       {rnd('avg(reproduction_rate)', 3)} AS avg_reproduction_rate,
       {rnd('avg(stringency_index)', 2)} AS avg_stringency_index
FROM daily GROUP BY date"""
Q["v_continental_summary"] = f"""
SELECT continent, count(*) AS country_count, {big('sum(total_cases)', 'total_cases')},
       {big('sum(total_deaths)', 'total_deaths')}, {big('sum(population)', 'total_population')},
       {rnd(ratio('sum(l.total_cases)', 'sum(population)') + ' * 1e6', 2)} AS cases_per_million,
       {rnd(ratio('sum(l.total_deaths)', 'sum(population)') + ' * 1e6', 2)} AS deaths_per_million,
       {rnd(ratio('sum(l.total_deaths)', 'sum(l.total_cases)') + ' * 100', 4)} AS cfr_pct,
       {rnd('avg(vaccination_rate)', 2)} AS avg_vaccination_rate_pct
FROM latest l {_dim_join} WHERE continent IS NOT NULL GROUP BY continent"""
Q["v_country_latest"] = f"""
SELECT iso_code, location, continent, population, {d6('gdp_per_capita')}, {d6('median_age')},
       {d6('human_development_index')}, date AS latest_date, total_cases, total_deaths,
       total_vaccinations, people_fully_vaccinated, {d6('total_cases_per_million')},
       {d6('total_deaths_per_million')}, {_cfr}, {_vax2}, {d6('mortality_rate_per_million')},
       {d6('rolling_7day_cases')}, {d6('rolling_7day_deaths')}
FROM latest {_dim_join}"""
Q["v_entity_timeline"] = f"""
SELECT date, new_cases, new_deaths, {d6('new_cases_smoothed')}, {d6('new_deaths_smoothed')},
       total_cases, total_deaths, total_vaccinations, people_vaccinated, people_fully_vaccinated,
       new_vaccinations, {rnd('vaccination_rate', 4)} AS vaccination_rate_pct, {_cfr},
       {d6('rolling_7day_cases')}, {d6('rolling_7day_deaths')}, {d6('rolling_14day_cases')},
       wave_number, {d6('stringency_index')}, {d6('reproduction_rate')}, month_name, quarter,
       f.year, f.month
FROM fact f JOIN dates ON date = date_key WHERE iso_code = '{K.FOCUS}'"""
Q["v_monthly_by_group"] = f"""
SELECT year, month, strftime(date_trunc('month', min(date)), '%b %Y') AS month_label, continent,
       {big('sum(new_cases)', 'monthly_new_cases')}, {big('sum(new_deaths)', 'monthly_new_deaths')},
       {rnd('avg(rolling_7day_cases)', 0)} AS avg_7day_cases
FROM daily {_dim_join} WHERE continent IS NOT NULL AND new_cases IS NOT NULL
GROUP BY year, month, continent"""
_progress = f"""
SELECT iso_code, location, date, {rnd('vaccination_rate', 4)} AS vaccination_rate_pct,
       people_fully_vaccinated, total_boosters
FROM daily {_dim_join} WHERE vaccination_rate IS NOT NULL AND iso_code IN (
  SELECT iso_code FROM latest_known ORDER BY {{}} LIMIT 20)"""
Q["v_coverage_progress"] = _progress.format("vaccination_rate DESC, iso_code")
Q["v_coverage_progress_literal"] = _progress.format("iso_code")


def _scaled(c: str) -> str:
    low, high = f"min({c}) OVER ()", f"max({c}) OVER ()"
    return f"(({c} - {low}) / NULLIF({high} - {low}, 0))"


CTES["risk_parts"] = f"""
SELECT *, ({_scaled('total_cases_per_million')} + {_scaled('mortality_rate_per_million')}
  + (1 - {_scaled('vaccination_rate')})) / 3 AS score
FROM latest WHERE total_cases_per_million IS NOT NULL AND mortality_rate_per_million IS NOT NULL
  AND vaccination_rate IS NOT NULL"""
Q["v_high_risk"] = f"""
SELECT CAST(rank() OVER (ORDER BY score DESC NULLS LAST) AS INTEGER) AS risk_rank, location,
       continent, population, {rnd('total_cases_per_million', 0)} AS cases_per_million,
       {rnd('mortality_rate_per_million', 2)} AS deaths_per_million, {_vax2}, {_cfr},
       {rnd('score', 4)} AS composite_risk_score
FROM risk_parts {_dim_join} WHERE population >= {K.MIN_POP}"""
Q["risk_scores_sql"] = Q["v_high_risk"]
_wave_cfr = ratio("sum(new_deaths)", "sum(new_cases)")
Q["v_wave_summary"] = f"""
SELECT location, continent, wave_number, min(date) AS wave_start, max(date) AS wave_end,
       CAST(max(date) - min(date) AS INTEGER) AS wave_duration_days,
       {d6('max(new_cases_smoothed)', 'peak_smoothed_daily_cases')},
       {big('sum(new_cases)', 'total_new_cases_in_wave')},
       {big('sum(new_deaths)', 'total_new_deaths_in_wave')},
       {rnd(_wave_cfr + ' * 100', 4)} AS wave_cfr_pct
FROM fact {_dim_join} WHERE wave_number > 0 AND population >= {K.MIN_POP}
GROUP BY location, continent, wave_number"""

# --- reports
for _how in ("max", "sum"):
    Q[f"snapshot_{_how}"] = f"""
SELECT {big(f'{_how}(total_cases)', 'global_total_cases')},
       {big(f'{_how}(total_deaths)', 'global_total_deaths')},
       {big(f'{_how}(total_vaccinations)', 'global_total_vaccinations')},
       {big(f'{_how}(people_fully_vaccinated)', 'global_fully_vaccinated')},
       {big(f'{_how}(total_tests)', 'global_total_tests')},
       {rnd(ratio(f'{_how}(total_deaths)', f'{_how}(total_cases)') + ' * 100', 4)} AS global_cfr_pct
FROM latest"""
Q["group_breakdown"] = f"""
SELECT continent, count(*) AS country_count, {big('sum(total_cases)', 'total_cases')},
       {big('sum(total_deaths)', 'total_deaths')}, {big('sum(population)', 'total_population')},
       {rnd(ratio('sum(l.total_deaths)', 'sum(l.total_cases)') + ' * 100', 4)} AS cfr_pct,
       {rnd(ratio('sum(people_fully_vaccinated)', 'sum(population)') + ' * 100', 2)}
         AS avg_vaccination_rate_pct
FROM latest l {_dim_join} WHERE continent IS NOT NULL GROUP BY continent"""
Q["global_monthly"] = f"""
SELECT year, month, strftime(date_trunc('month', min(date)), '%b %Y') AS month_label,
       {big('sum(new_cases)', 'monthly_new_cases')}, {big('sum(new_deaths)', 'monthly_new_deaths')},
       {rnd('avg(reproduction_rate)', 3)} AS avg_reproduction_rate
FROM daily WHERE new_cases IS NOT NULL GROUP BY year, month"""
Q["entity_ranks"] = f"""
SELECT location, continent, {d6('total_cases_per_million')}, {d6('total_deaths_per_million')},
       {d6('vaccination_rate')}, cfr_pct, rank_cases_per_million, dense_rank_vaccination
FROM (
  SELECT *, {_cfr},
    CAST(rank() OVER (ORDER BY total_cases_per_million DESC NULLS LAST) AS INTEGER)
      AS rank_cases_per_million,
    CAST(dense_rank() OVER (ORDER BY vaccination_rate DESC NULLS LAST) AS INTEGER)
      AS dense_rank_vaccination
  FROM latest {_dim_join} WHERE total_cases_per_million IS NOT NULL)
ORDER BY rank_cases_per_million, iso_code LIMIT 30"""
_few = ", ".join(f"'{e}'" for e in K.COMPARED)
Q["day_growth"] = f"""
SELECT iso_code, date, new_cases, prev_day_cases, new_cases - prev_day_cases AS daily_change,
       {rnd(ratio('new_cases - prev_day_cases', 'prev_day_cases') + ' * 100', 2)} AS growth_pct
FROM (SELECT iso_code, date, new_cases,
        lag(new_cases) OVER (PARTITION BY iso_code ORDER BY date) AS prev_day_cases
      FROM daily WHERE iso_code IN ({_few}) AND date >= DATE '{K.SINCE}')"""
Q["rolling_check"] = f"""
SELECT iso_code, date, new_cases,
       {rnd('avg(new_cases) OVER (ORDER BY date ROWS 6 PRECEDING)', 2)} AS rolling_7day_avg_cases,
       {d6('rolling_7day_cases', 'python_rolling_7day_cases')}
FROM daily WHERE iso_code = '{K.FOCUS}'"""
CTES["peak_days"] = """
SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY iso_code ORDER BY new_cases_smoothed DESC NULLS LAST, date) AS rn FROM daily)
WHERE rn = 1"""
Q["peak_day"] = f"""
SELECT location, continent, date AS peak_date, new_cases AS peak_new_cases,
       {d6('new_cases_smoothed', 'peak_smoothed_cases')}
FROM peak_days {_dim_join} WHERE population >= {K.MIN_POP}
ORDER BY new_cases DESC NULLS LAST, iso_code LIMIT 20"""
Q["top_cfr"] = f"""
SELECT * FROM (
  SELECT *, CAST(rank() OVER (ORDER BY cfr_pct DESC) AS INTEGER) AS cfr_rank FROM (
    SELECT location, continent, population, total_cases, total_deaths, {_cfr}, {_vax2}
    FROM latest {_dim_join}
    WHERE population >= {K.MIN_POP} AND total_cases >= {K.MIN_CASES})
  WHERE cfr_pct IS NOT NULL)
WHERE cfr_rank <= 10"""
_lo, _mid, _hi = K.LEVELS
Q["milestones"] = f"""
SELECT location, {rnd('m', 2)} AS max_vax_rate_pct, date_{_lo}pct, date_{_mid}pct, date_{_hi}pct,
       CAST(date_{_mid}pct - date_{_lo}pct AS INTEGER) AS days_{_lo}_to_{_mid},
       CAST(date_{_hi}pct - date_{_mid}pct AS INTEGER) AS days_{_mid}_to_{_hi}
FROM (SELECT iso_code, location, max(vaccination_rate) AS m,
        {', '.join(f"min(date) FILTER (WHERE vaccination_rate >= {v}) AS date_{v}pct" for v in K.LEVELS)}
      FROM daily {_dim_join} WHERE vaccination_rate IS NOT NULL GROUP BY iso_code, location)
WHERE date_{_lo}pct IS NOT NULL"""
Q["top3_per_group"] = f"""
SELECT * FROM (
  SELECT continent, location, {_vax2}, CAST(rank() OVER (
    PARTITION BY continent ORDER BY vaccination_rate DESC) AS INTEGER) AS continent_rank
  FROM latest_known {_dim_join} WHERE continent IS NOT NULL AND population >= {K.MIN_POP})
WHERE continent_rank <= 3"""
_monthly = f"""
SELECT year, month, strftime(date_trunc('month', min(date)), '%b %Y') AS period,
       {big('sum(new_cases)', 'monthly_cases')}, {big('sum(new_deaths)', 'monthly_deaths')},
       max(total_vaccinations) AS cumulative_vaccinations_eom,
       max(people_fully_vaccinated) AS fully_vaccinated_eom,
       {rnd('avg(rolling_7day_cases)', 0)} AS avg_daily_cases_7d,
       {rnd('{} * 100', 4)} AS cfr_pct_eom
FROM daily WHERE iso_code = '{K.FOCUS}' GROUP BY year, month"""
Q["entity_monthly"] = _monthly.format("max(case_fatality_rate)")
Q["entity_monthly_eom"] = _monthly.format(
    "last(case_fatality_rate ORDER BY date)"
)
_four = "vaccination_rate", "case_fatality_rate", "total_cases_per_million", "total_deaths_per_million"


def _compared(title: str, wrap: str) -> str:
    v, c, n, m = (wrap.format(x) for x in _four)
    return f"""SELECT '{title}' AS entity, {rnd(v, 2)} AS vaccination_rate_pct,
  {rnd(f'{c} * 100', 4)} AS cfr_pct, {rnd(n, 0)} AS cases_per_million,
  {rnd(m, 2)} AS deaths_per_million FROM latest"""


Q["focus_vs_average"] = (
    f"{_compared(K.FOCUS_LABEL, '{}')} WHERE iso_code = '{K.FOCUS}' UNION ALL "
    f"{_compared('World Average', 'avg({})')}"
)
Q["wave_periods"] = f"""
SELECT wave_number, min(date) AS wave_start, max(date) AS wave_end,
       CAST(max(date) - min(date) AS INTEGER) AS wave_duration_days,
       {d6('max(new_cases_smoothed)', 'peak_smoothed_cases')},
       {big(rnd('sum(new_cases_smoothed)', 0), 'total_smoothed_cases_in_wave')}
FROM fact WHERE iso_code = '{K.FOCUS}' AND new_cases_smoothed IS NOT NULL
GROUP BY wave_number"""
Q["coverage_tiers"] = f"""
SELECT location, continent, {_vax2}, {_cfr},
       {rnd('total_deaths_per_million', 2)} AS deaths_per_million, {d6('median_age')},
       {d6('gdp_per_capita')},
       CASE {' '.join(f"WHEN vaccination_rate >= {b} THEN '{t}'" for b, t in K.TIERS)}
         ELSE '{K.TIER_REST}' END AS vaccination_tier
FROM latest {_dim_join} WHERE vaccination_rate IS NOT NULL AND case_fatality_rate IS NOT NULL
  AND population >= {K.MIN_POP}"""
Q["above_below_average"] = f"""
SELECT location, continent, {rnd('mortality_rate_per_million', 2)} AS deaths_per_million, {_vax2},
       {_cfr}, {d6('m', 'avg_mortality')}, {d6('v', 'avg_vaccination')}
FROM latest {_dim_join} CROSS JOIN (
  SELECT avg(mortality_rate_per_million) AS m, avg(vaccination_rate) AS v FROM latest
  WHERE mortality_rate_per_million IS NOT NULL AND vaccination_rate IS NOT NULL)
WHERE mortality_rate_per_million > m AND vaccination_rate < v AND population >= {K.MIN_POP}"""
CTES["first_cases"] = """
SELECT iso_code, min(date) AS first_case_date FROM daily WHERE new_cases > 0 GROUP BY iso_code"""
Q["pandemic_timeline"] = f"""
SELECT location, continent, first_case_date, p.date AS peak_date,
       {rnd('p.new_cases_smoothed', 0)} AS peak_daily_cases_smoothed, l.date AS latest_date,
       l.total_cases, l.total_deaths, {rnd('l.vaccination_rate', 2)} AS vaccination_rate_pct
FROM latest l {_dim_join} JOIN first_cases USING (iso_code)
JOIN peak_days p USING (iso_code)
WHERE p.new_cases_smoothed IS NOT NULL
ORDER BY l.total_cases DESC NULLS LAST, iso_code LIMIT 20"""
CTES["latest_tested"] = """
SELECT d.* FROM daily d JOIN (
  SELECT iso_code, max(date) AS date FROM daily
  WHERE positive_rate IS NOT NULL AND tests_per_case IS NOT NULL
  GROUP BY iso_code) USING (iso_code, date)"""
Q["testing_adequacy"] = f"""
SELECT location, continent, {rnd('positive_rate * 100', 2)} AS positivity_rate_pct,
       {rnd('tests_per_case', 1)} AS tests_per_confirmed_case, total_tests AS cumulative_tests,
       {rnd('total_cases_per_million', 0)} AS cases_per_million,
       CASE {' '.join(f"WHEN positive_rate < {b} THEN '{t}'" for b, t in K.TESTED)}
         ELSE '{K.TESTED_REST}' END AS testing_adequacy
FROM latest_tested {_dim_join} WHERE population >= {K.MIN_POP}
ORDER BY positive_rate DESC NULLS LAST, iso_code LIMIT 20"""

# --- statistics
Q["detect_peaks"] = f"SELECT iso_code, date, {d6('height')} FROM peaks"
Q["label_waves"] = "SELECT iso_code, date, wave_number FROM wide_labelled"
_PAIRS = [(a, b) for a in CORRELATION_METRICS for b in CORRELATION_METRICS]
CTES["pairs"] = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y "
    f"FROM summary WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a, b in _PAIRS
)
CTES["pair_ranks"] = """
SELECT a, b, rank() OVER (PARTITION BY a, b ORDER BY x)
         + (count(*) OVER (PARTITION BY a, b, x) - 1) / 2.0 AS x,
       rank() OVER (PARTITION BY a, b ORDER BY y)
         + (count(*) OVER (PARTITION BY a, b, y) - 1) / 2.0 AS y
FROM pairs"""


def _matrix(source: str, name: str) -> str:
    cells = ", ".join(d6(f"max(r) FILTER (WHERE b = '{c}')", c) for c in CORRELATION_METRICS)
    return f"""SELECT a AS metric, {cells}, '{name}' AS correlation_type
  FROM (SELECT a, b, corr(x, y) AS r FROM {source} GROUP BY a, b) GROUP BY a"""


Q["correlation_matrix"] = (
    f"{_matrix('pairs', 'pearson')} UNION ALL {_matrix('pair_ranks', 'spearman')}"
)
# Two-sided tail of Student's t with a whole number of degrees of freedom, as its finite series:
# with theta = atan(t / sqrt(v)), every term is the one before times cos^2 and a fixed fraction.
CTES["tested"] = """
SELECT 'pearson' AS method, count(*) AS n, corr(x, y) AS r FROM pairs
WHERE a = 'vaccination_rate' AND b = 'case_fatality_rate'
UNION ALL
SELECT 'spearman', count(*), corr(x, y) FROM pair_ranks
WHERE a = 'vaccination_rate' AND b = 'case_fatality_rate'"""
CTES["angles"] = """
SELECT method, n, r, n - 2 AS v, atan(abs(r) / sqrt(1 - r * r)) AS theta FROM tested
WHERE n >= 10"""
CTES["terms"] = """
SELECT method, v % 2 AS k, CASE WHEN v % 2 = 1 THEN cos(theta) ELSE 1.0 END AS term, v, theta
FROM angles
UNION ALL
SELECT method, k + 2,
       term * cos(theta) ** 2 * (CASE WHEN v % 2 = 1 THEN (k + 1) / (k + 2.0)
                                      ELSE (k + 1) / (k + 2.0) END), v, theta
FROM terms WHERE k + 2 <= v - 2"""
Q_TEST = """
SELECT method, n AS pairs, {r}, {p}, CASE WHEN p < 0.05 THEN
         CASE WHEN r < 0 THEN 'negative' ELSE 'positive' END END AS direction
FROM (
  SELECT method, n, r, 1 - CASE WHEN any_value(a.v) % 2 = 1
      THEN 2 / pi() * (any_value(a.theta) + sin(any_value(a.theta)) * sum(term))
      ELSE sin(any_value(a.theta)) * sum(term) END AS p
  FROM angles a JOIN terms USING (method) WHERE method = '{m}' GROUP BY method, n, r)"""
for _m in ("pearson", "spearman"):
    Q[f"{_m}_test"] = Q_TEST.format(r=d6("r"), p="CAST(printf('%.6e', p) AS DOUBLE) AS p_value", m=_m)


def _zero_scaled(c: str, source: str) -> str:
    low, high = f"(SELECT min({c}) FROM {source})", f"(SELECT max({c}) FROM {source})"
    return f"""CASE WHEN {c} IS NULL THEN NULL WHEN {low} = {high} THEN 0
  ELSE ({c} - {low}) / ({high} - {low}) END"""


Q["min_max"] = "SELECT location, " + ", ".join(
    d6(_zero_scaled(c, "summary"), f"scaled_{c}")
    for c in ("vaccination_rate", "case_fatality_rate", "gdp_per_capita")
) + " FROM summary"
CTES["scorable"] = """
SELECT total_cases_per_million, mortality_rate_per_million, vaccination_rate, location, continent
FROM summary WHERE total_cases_per_million IS NOT NULL
  AND mortality_rate_per_million IS NOT NULL AND vaccination_rate IS NOT NULL"""
CTES["scored"] = f"""
SELECT *, (score_cases + score_deaths + score_unvax) / 3 AS composite_risk_score FROM (
  SELECT *, {_zero_scaled('total_cases_per_million', 'scorable')} AS score_cases,
         {_zero_scaled('mortality_rate_per_million', 'scorable')} AS score_deaths,
         1 - {_zero_scaled('vaccination_rate', 'scorable')} AS score_unvax FROM scorable)"""
_scores = ("score_cases", "score_deaths", "score_unvax", "composite_risk_score")
Q["risk_scores"] = f"""
SELECT CAST(row_number() OVER (ORDER BY composite_risk_score DESC, location) AS INTEGER)
         AS risk_rank,
       {d6('total_cases_per_million')}, {d6('mortality_rate_per_million')}, {d6('vaccination_rate')},
       location, continent, {', '.join(d6(c) for c in _scores)}
FROM scored"""


def _eps(c: str) -> str:
    return (f"(({c} - (SELECT min({c}) FROM summary)) / ((SELECT max({c}) FROM summary)"
            f" - (SELECT min({c}) FROM summary) + 1e-9))")


Q["risk_weighted"] = "SELECT location, " + d6(
    f"{_eps('case_fatality_rate')} * 0.4 + {_eps('total_deaths_per_million')} * 0.4 "
    f"+ (1 - {_eps('vaccination_rate')}) * 0.2", "composite_risk_score"
) + " FROM summary"
Q["ols_trend"] = f"""
SELECT CAST(point AS INTEGER) AS point, {d6('lo + (hi - lo) * point / 99', 'x')},
       {d6('slope * (lo + (hi - lo) * point / 99) + intercept', 'fitted')},
       {d6('slope')}, {d6('intercept')}
FROM (SELECT regr_slope(case_fatality_rate, vaccination_rate) AS slope,
        regr_intercept(case_fatality_rate, vaccination_rate) AS intercept,
        min(vaccination_rate) AS lo, max(vaccination_rate) AS hi,
        unnest(generate_series(0, 99)) AS point
      FROM summary WHERE vaccination_rate IS NOT NULL AND case_fatality_rate IS NOT NULL)"""
CTES["trimmed"] = """
SELECT *, CASE WHEN case_fatality_rate <= 1 THEN case_fatality_rate * 100
          ELSE case_fatality_rate END AS cfr_pct FROM summary
WHERE vaccination_rate > 0 AND case_fatality_rate < (
  SELECT quantile_cont(case_fatality_rate, 0.98) FROM summary WHERE vaccination_rate IS NOT NULL)"""
Q["quantile_trim"] = f"""
SELECT location, {d6('vaccination_rate')}, {d6('case_fatality_rate')} FROM trimmed"""

# --- chart and BI datasets
_trend = f"""
SELECT date, {big('sum(new_cases)', 'daily_cases')}, {big('sum(new_deaths)', 'daily_deaths')},
       {d6('avg(rolling_7day_cases)', 'avg_7d_cases')},
       {d6('avg(rolling_7day_deaths)', 'avg_7d_deaths')}
FROM panel {{}} GROUP BY date"""
_p, _r = (v / 100 for v in K.WINDOW)


def _in_window(where: str) -> str:
    a, b = f"(SELECT min(date) FROM panel {where})", f"(SELECT max(date) FROM panel {where})"
    return (f"date BETWEEN {a} + CAST(floor({_p} * ({b} - {a})) AS INTEGER) "
            f"AND {a} + CAST(floor({_r} * ({b} - {a})) AS INTEGER)")


_grouped = f"WHERE continent = '{K.GROUP}'"
Q["trend_filtered"] = _trend.format(f"{_grouped} AND {_in_window(_grouped)}")
Q["trend_all"] = _trend.format("")
Q["percent_window"] = f"""
SELECT a + CAST(floor({_p} * (b - a)) AS INTEGER) AS start_date,
       a + CAST(floor({_r} * (b - a)) AS INTEGER) AS end_date
FROM (SELECT min(date) AS a, max(date) AS b FROM panel)"""
Q["metric_series"] = f"""
SELECT date, new_cases AS value, {d6('rolling_7day_cases', 'smoothed')} FROM panel
WHERE location = '{K.FOCUS_LABEL}'"""
Q["wave_extent"] = f"""
SELECT wave_number, min(date) AS start_date, max(date) AS end_date FROM fact
WHERE iso_code = '{K.FOCUS}' GROUP BY wave_number"""
Q["wave_extent_unlabelled"] = " UNION ALL ".join(
    f"""SELECT {n} AS wave_number, DATE '{a}' AS start_date, DATE '{b}' AS end_date,
  CAST(sum(new_cases) AS BIGINT) AS cases FROM daily
  WHERE iso_code = '{K.FOCUS}' AND date BETWEEN DATE '{a}' AND DATE '{b}'"""
    for n, a, b in K.WAVE_BANDS
)
Q["quarter_windows"] = """
SELECT iso_code, a AS start_date, b AS end_date, CAST(sum(new_cases) AS BIGINT) AS cases,
       max(new_cases) AS peak_value, arg_max(date, (new_cases, -date_diff('day', DATE '1970-01-01', date)))
         AS peak_date
FROM (SELECT iso_code, date AS a, date + 91 AS b FROM daily WHERE day(date) = 1) w
JOIN daily USING (iso_code)
WHERE date BETWEEN a AND b AND new_cases IS NOT NULL GROUP BY iso_code, a, b"""
Q["peak_in_window"] = " UNION ALL ".join(
    f"""(SELECT '{name}' AS window_name, date AS peak_date, new_cases AS peak_value FROM daily
  WHERE iso_code = '{K.FOCUS}' AND date BETWEEN DATE '{a}' AND DATE '{b}'
  ORDER BY new_cases DESC, date LIMIT 1)""" for name, a, b in K.PEAK_WINDOWS
)
Q["top_n_metric"] = f"""
SELECT location, continent, {d6('total_cases_per_million')}, population FROM summary
WHERE total_cases_per_million IS NOT NULL
ORDER BY summary.total_cases_per_million DESC, location LIMIT 15"""
_by_value = "CASE WHEN case_fatality_rate <= 1 THEN case_fatality_rate * 100 ELSE case_fatality_rate END"


def _scatter(where: str) -> str:
    return f"""
SELECT location, continent, {d6('vaccination_rate')}, {d6('cfr_pct')}, {d6(_lin, 'weight')},
       FALSE AS is_focus
FROM (SELECT *, CASE WHEN (SELECT max(case_fatality_rate) FROM summary) <= 1
        THEN case_fatality_rate * 100 ELSE case_fatality_rate END AS cfr_pct FROM summary)
WHERE vaccination_rate > 0 AND cfr_pct IS NOT NULL {where}
UNION ALL
SELECT location, continent, {d6('vaccination_rate')}, {d6(_by_value, 'cfr_pct')}, 1.0, TRUE
FROM summary WHERE iso_code = '{K.FOCUS}'"""


Q["scatter_coverage_cfr"] = _scatter("")
Q["scatter_coverage_cfr_group"] = _scatter(f"AND continent = '{K.GROUP}'")
Q["scatter_coverage_cfr_trimmed"] = f"""
SELECT location, continent, {d6('vaccination_rate')}, {d6('cfr_pct')},
       {d6(_log.format('CAST(population AS DOUBLE)'), 'weight')},
       location = '{K.FOCUS_LABEL}' AS is_focus
FROM trimmed"""


def _line(rows: str, points: int, more: str = "") -> str:
    at = f"lo + (hi - lo) * point / {points - 1}"
    return f"""
SELECT CAST(point AS INTEGER) AS point, {d6(at, 'x')},
       {d6(f'slope * ({at}) + intercept', 'fitted')}, {d6('slope')}, {d6('intercept')}{more}
FROM (SELECT regr_slope(cfr_pct, vaccination_rate) AS slope,
        regr_intercept(cfr_pct, vaccination_rate) AS intercept, min(vaccination_rate) AS lo,
        max(vaccination_rate) AS hi,
        CASE WHEN count(*) >= 10 THEN corr(cfr_pct, vaccination_rate) END AS r,
        CASE WHEN count(*) >= 10 THEN corr(rx, ry) END AS rs, unnest(generate_series(0, {points - 1})) AS point
      FROM (SELECT cfr_pct, vaccination_rate,
              rank() OVER (ORDER BY cfr_pct) + (count(*) OVER (PARTITION BY cfr_pct) - 1) / 2.0
                AS rx,
              rank() OVER (ORDER BY vaccination_rate)
                + (count(*) OVER (PARTITION BY vaccination_rate) - 1) / 2.0 AS ry
            FROM ({rows})) HAVING count(*) > 5)"""


_scattered = """SELECT * FROM (SELECT *, CASE WHEN (SELECT max(case_fatality_rate) FROM summary) <= 1
    THEN case_fatality_rate * 100 ELSE case_fatality_rate END AS cfr_pct FROM summary)
  WHERE vaccination_rate > 0 AND cfr_pct IS NOT NULL"""
Q["scatter_trend"] = _line(_scattered, 100)
Q["scatter_trend_group"] = _line(f"{_scattered} AND continent = '{K.GROUP}'", 100)
Q["scatter_trend_trimmed"] = _line(
    "SELECT * FROM trimmed", 200, f", {d6('r', 'pearson_r')}, {d6('rs', 'spearman_r')}"
)
Q["kpi_cards"] = f"""
SELECT {big('sum(c)', 'total_cases')}, {big('sum(d)', 'total_deaths')},
       {d6(ratio('sum(v * p)', 'sum(p)'), 'vaccination_pct')},
       {d6('CAST(sum(d) AS DOUBLE) / greatest(sum(c), 1) * 100', 'cfr_pct')}
FROM (SELECT iso_code, max(total_cases) AS c, max(total_deaths) AS d, max(vaccination_rate) AS v,
        max(population) AS p FROM panel WHERE {_in_window('')} GROUP BY iso_code)"""
Q["global_daily_rolling"] = f"""
SELECT date, new_cases, new_deaths, {d6('new_cases_smoothed', 'rolling_7d_cases')},
       {d6('new_deaths_smoothed', 'rolling_7d_deaths')} FROM world"""
Q["global_totals"] = f"""
SELECT {big('sum(total_cases)', 'total_cases')}, {big('sum(total_deaths)', 'total_deaths')},
       (SELECT max(new_cases) FROM panel) AS max_single_day_cases FROM summary"""
CTES["bounds"] = """
SELECT iso_code, 0 AS part, min(date) AS mark FROM panel GROUP BY iso_code
UNION ALL SELECT iso_code, 2, max(date) FROM panel GROUP BY iso_code
UNION ALL SELECT iso_code, 1, date FROM peaks"""
Q["wave_boundaries"] = """
SELECT iso_code, CAST(n AS INTEGER) AS interval, mark AS start_date, ends AS end_date FROM (
  SELECT iso_code, mark, row_number() OVER (PARTITION BY iso_code ORDER BY part, mark) AS n,
         lead(mark) OVER (PARTITION BY iso_code ORDER BY part, mark) AS ends FROM bounds)
WHERE ends IS NOT NULL"""
_wanted = ", ".join(f"(DATE '{d}')" for d in K.WANTED_DATES)
Q["nearest_date"] = f"""
SELECT iso_code, wanted_date, date, new_cases FROM (
  SELECT iso_code, wanted_date, date, new_cases, row_number() OVER (
    PARTITION BY iso_code, wanted_date ORDER BY abs(date - wanted_date), date) AS rn
  FROM series CROSS JOIN (VALUES {_wanted}) AS wanted(wanted_date) WHERE new_cases IS NOT NULL)
WHERE rn = 1"""
_named = ", ".join(f"'{x}'" for x in K.LABELS)
CTES["benchmarks"] = f"""
SELECT location, {', '.join(_four)} FROM panel JOIN (
  SELECT location, max(date) AS date FROM panel GROUP BY location) USING (location, date)
WHERE location IN ({_named})
UNION ALL SELECT 'World Average', {', '.join(f'avg({c})' for c in (
    'vaccination_rate', 'case_fatality_rate', 'total_cases_per_million',
    'total_deaths_per_million'))} FROM summary"""
CTES["benchmark_pct"] = f"SELECT *, {_by_value} AS cfr_pct FROM benchmarks"
Q["benchmark_compare"] = (
    "SELECT location, " + ", ".join(d6(c) for c in (*_four, "cfr_pct")) + " FROM benchmark_pct"
)
_radar = ("total_cases_per_million", "total_deaths_per_million", "vaccination_rate", "cfr_pct")
Q["radar_normalised"] = " UNION ALL ".join(
    f"SELECT location, '{c}' AS metric, "
    + d6(f"""({c} - (SELECT min({c}) FROM benchmark_pct)) / ((SELECT max({c}) FROM benchmark_pct)
      - (SELECT min({c}) FROM benchmark_pct) + 1e-9) * 100""", "scaled") + " FROM benchmark_pct"
    for c in _radar
)
Q["top_risk"] = f"""
SELECT location, continent, {d6('vaccination_rate')}, {d6('composite_risk_score')},
       {d6('(SELECT avg(composite_risk_score) FROM scored)', 'avg_risk_score')},
       {d6('(SELECT avg(vaccination_rate) FROM scored)', 'avg_vaccination_rate')}
FROM scored ORDER BY scored.composite_risk_score DESC, location LIMIT 15"""
Q["focus_vs_benchmarks"] = "SELECT date, " + ", ".join(
    d6(f"max(new_cases_smoothed) FILTER (WHERE location = '{x}')", f'"{x}"') for x in K.LABELS
) + f" FROM panel WHERE location IN ({_named}) GROUP BY date"
Q["map_metric"] = (
    f"SELECT iso_code, location, {d6('vaccination_rate', 'value')} FROM latest {_dim_join}"
)
Q["group_by_month_stack"] = f"""
SELECT CAST(date_trunc('month', date) AS DATE) AS month, continent,
       {big('sum(new_cases)', 'new_cases')}, {big('sum(new_deaths)', 'new_deaths')}
FROM panel GROUP BY ALL"""
Q["group_share"] = f"""
SELECT continent, {big('sum(total_cases)', 'value')},
       {d6('CAST(sum(total_cases) AS DOUBLE) / (SELECT sum(total_cases) FROM latest) * 100',
           'share_pct')}
FROM latest {_dim_join} GROUP BY continent"""


def _leaders(metric: str) -> str:
    return f"""
SELECT location, continent, {metric} AS value FROM latest {_dim_join}
ORDER BY {metric} DESC NULLS LAST, iso_code LIMIT 10"""


Q["top_n_entities"] = _leaders("total_deaths")
Q["entity_kpis"] = f"""
SELECT iso_code, total_cases, total_deaths, people_fully_vaccinated,
       {d6(f'{_fatal} * 100', 'cfr_pct')},
       {d6(f'(1 - coalesce({_fatal}, 0)) * 100', 'recovery_pct')}
FROM latest WHERE iso_code = '{K.FOCUS}'"""
Q["vaccination_progress_focus"] = f"""
SELECT date, total_vaccinations, people_fully_vaccinated FROM daily WHERE iso_code = '{K.FOCUS}'"""
Q["month_heatmap"] = "SELECT year, " + ", ".join(
    big(f"sum(new_cases) FILTER (WHERE month = {m})", f"month_{m}") for m in range(1, 13)
) + f" FROM daily WHERE iso_code = '{K.FOCUS}' GROUP BY year"
CTES["weekly"] = """
SELECT iso_code, date, year, month, coalesce(new_cases, 0) AS value,
       lag(coalesce(new_cases, 0), 7) OVER (PARTITION BY iso_code ORDER BY date) AS value_7_back
FROM daily"""
_growth = ratio("value - value_7_back", "value_7_back") + " * 100"
Q["weekly_growth"] = (
    f"SELECT iso_code, date, value, value_7_back, {d6(_growth, 'growth_pct')} FROM weekly"
)
Q["growth_heatmap"] = "SELECT iso_code, year, " + ", ".join(
    d6(f"avg({_growth}) FILTER (WHERE month = {m})", f"month_{m}") for m in range(1, 13)
) + " FROM weekly GROUP BY iso_code, year"
_mom = ratio("value - previous", "previous") + " * 100"
CTES["monthly_sums"] = """
SELECT CAST(date_trunc('month', date) AS DATE) AS month, CAST(sum(new_cases) AS BIGINT) AS value
FROM daily GROUP BY 1"""
Q["mom_growth"] = f"""
SELECT month, value, previous, {d6(f'coalesce({_mom}, 0)', 'growth_pct')} FROM (
  SELECT m.month, m.value, p.value AS previous FROM monthly_sums m
  LEFT JOIN monthly_sums p ON p.month = m.month - INTERVAL 1 MONTH)"""
Q["mom_growth_by_entity"] = f"""
SELECT location, month, value, previous, {d6(_mom, 'growth_pct')} FROM (
  SELECT location, CAST(date_trunc('month', date) AS DATE) AS month,
         CAST(sum(new_cases) AS BIGINT) AS value,
         CAST(lag(sum(new_cases)) OVER (PARTITION BY location ORDER BY date_trunc('month', date))
           AS BIGINT) AS previous
  FROM panel GROUP BY location, date_trunc('month', date))"""
Q["calendar_7d_avg"] = f"""
SELECT date, {big('value', 'value')}, {d6('''avg(value) OVER (
  ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)''', 'calendar_avg')}
FROM (SELECT date, sum(new_cases) AS value FROM daily GROUP BY date)"""
Q["calendar_7d_avg_by_entity"] = f"""
SELECT iso_code, date, {big('new_cases', 'value')}, {d6('''avg(new_cases) OVER (
  PARTITION BY iso_code ORDER BY date
  RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)''', 'calendar_avg')}
FROM raw WHERE new_cases IS NOT NULL"""
for _n in (7, 14):
    Q[f"window_avg_{_n}"] = f"""
SELECT date, {big('value', 'value')},
       {d6(f'avg(value) OVER (ORDER BY date ROWS {_n - 1} PRECEDING)', 'window_avg')}
FROM (SELECT date, sum(new_cases) AS value FROM daily GROUP BY date)"""
_mine = f"sum(total_cases) FILTER (WHERE iso_code = '{K.FOCUS}')"
Q["share_of_world"] = f"""
SELECT {big(_mine, 'focus_total')}, {big('sum(total_cases)', 'world_total')},
       {d6(ratio(_mine, 'sum(total_cases)') + ' * 100', 'share_pct')} FROM latest"""
Q["dense_rank_entities"] = f"""
SELECT location AS member, value, CAST(dense_rank() OVER (ORDER BY value DESC) AS INTEGER)
  AS dense_rank
FROM (SELECT iso_code, max(total_cases) AS value FROM daily GROUP BY iso_code) {_dim_join}"""
Q["dense_rank_groups"] = f"""
SELECT continent AS member, {big('sum(total_cases)', 'value')},
       CAST(dense_rank() OVER (ORDER BY sum(total_cases) DESC) AS INTEGER) AS dense_rank
FROM latest {_dim_join} GROUP BY continent"""
Q["rank_entities"] = f"""
SELECT location, total_cases, avg_deaths_per_million,
       CAST(rank() OVER (ORDER BY total_cases DESC NULLS LAST) AS INTEGER) AS rank_total_cases,
       CAST(rank() OVER (ORDER BY avg_deaths_per_million DESC NULLS LAST) AS INTEGER)
         AS rank_deaths_per_million
FROM (SELECT iso_code, last(total_cases ORDER BY date) AS total_cases,
        {rnd('avg(total_deaths_per_million)', 4)} AS avg_deaths_per_million
      FROM daily GROUP BY iso_code) {_dim_join}"""
Q["global_wave_bands"] = f"""
SELECT date, new_cases, {d6('new_cases_smoothed')}, wave_number,
       date IN (SELECT date FROM world_peaks) AS is_peak FROM world_labelled"""
Q["trends_filtered"] = f"""
SELECT location, date, new_cases, new_deaths, {', '.join(d6(c) for c in (
    'rolling_7day_cases', 'rolling_7day_deaths', 'vaccination_rate', 'stringency_index',
    'reproduction_rate'))}
FROM panel WHERE location IN ({_named}) AND date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'"""
Q["canned_top_cases"] = _leaders("total_cases")
Q["canned_high_cfr"] = Q["top_cfr"]
Q["canned_vacc_leaders"] = Q["top3_per_group"]
Q["canned_monthly_trend"] = Q["global_monthly"]
Q["canned_continent_summary"] = Q["v_continental_summary"]
Q["read_raw_panel"] = Q["cast_numeric"]
_EXPORTED = (
    "v_global_daily_trend", "v_continental_summary", "v_country_latest", "v_entity_timeline",
    "v_monthly_by_group", "v_coverage_progress", "v_high_risk", "v_wave_summary",
)
Q["export_views"] = _named_counts({name: Q[name] for name in _EXPORTED})



def _cells(name: str) -> str:
    """The figures of a view as (view, row, cell, value)."""
    keys, numbers = K.EXPORT_CELLS[name]
    row = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    cells = ", ".join(f"{{'cell': '{c}', 'value': CAST({c} AS DOUBLE)}}" for c in numbers)
    return f"""
SELECT '{name}' AS view, row, u.cell AS cell, {d6('u.value', 'value')}
FROM (SELECT concat_ws('|', {row}) AS row, unnest([{cells}]) AS u FROM ({Q[name]}))
WHERE u.value IS NOT NULL"""


Q["export_contents"] = " UNION ALL ".join(_cells(name) for name in _EXPORTED)
Q["full_run_risk"], Q["full_run_waves"] = Q["risk_scores"], Q["v_wave_summary"]
Q["full_run"] = _named_counts({
    "panel": "SELECT 1 FROM panel", "staging": "SELECT 1 FROM panel",
    "waves": "SELECT 1 FROM panel", "fact": "SELECT 1 FROM panel",
    "focus": f"SELECT 1 FROM panel WHERE iso_code = '{K.FOCUS}'",
    "summary": "SELECT 1 FROM summary", "dim_entity": "SELECT 1 FROM dim",
    "dim_date": "SELECT 1 FROM dates", "risk": "SELECT 1 FROM scored",
    "correlations": Q["correlation_matrix"],
    "correlation_tests": "SELECT 1 FROM tested WHERE n >= 10",
    "sanity": Q["check_ranges"], "constraints": Q["check_keys"],
    "reconciliation": Q["check_row_counts"],
})


def oracle_sql() -> dict[str, str]:
    return {key: statement(select) for key, select in Q.items()}
