"""Column expressions: safe division, stable rounding, rates and date parts.

All of them compose built-in functions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import scalars


def rnd(col: Column, digits: int) -> Column:
    """Half-up rounding that does not depend on the last bits of a double."""
    return F.round(col.cast("decimal(30,10)"), digits).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL where the denominator is zero or missing."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_if_positive(num: Column, den: Column) -> Column:
    """num / den only where the denominator is above zero."""
    return F.when(den > 0, ratio(num, den))


def case_fatality_rate(deaths: str = "total_deaths", cases: str = "total_cases") -> Column:
    return ratio_if_positive(F.col(deaths), F.col(cases))


def vaccination_rate(covered: str = "people_fully_vaccinated", pop: str = "population") -> Column:
    return ratio_if_positive(F.col(covered), F.col(pop)) * 100


def tests_per_case(tests: str = "total_tests", cases: str = "total_cases") -> Column:
    return ratio_if_positive(F.col(tests), F.col(cases))


def per_million(value: str, pop: str = "population") -> Column:
    return ratio_if_positive(F.col(value), F.col(pop)) * 1_000_000


def recovery_rate(deaths: Column, cases: Column, alternate: float | None = None) -> Column:
    """Percent not fatal; ``alternate`` replaces the fatality ratio when it is undefined."""
    fatal = ratio(deaths, cases)
    if alternate is not None:
        fatal = F.coalesce(fatal, F.lit(float(alternate)))
    return (1 - fatal) * 100


def focus_flag(label: str, focus: str, rest: str = "Rest of World") -> Column:
    return F.when(F.col(label) == focus, F.lit(focus)).otherwise(F.lit(rest))


def percent_if_fraction(col: Column) -> Column:
    """Value-wise unit guess: anything at most 1 is a fraction and becomes a percentage."""
    return F.when(col <= 1, col * 100).otherwise(col)


def percent_if_all_fractions(df: DataFrame, col: str, out: str) -> DataFrame:
    """Column-wise unit guess: scale by 100 only when the column's maximum is at most 1."""
    top = scalars(df, top=F.max(col))["top"]
    return df.withColumn(out, F.when(top <= 1, F.col(col) * 100).otherwise(F.col(col)))


def log_weight(pop: Column) -> Column:
    """Marker weight in [0, 1] on a log10 scale between 1e4 and 1.5e9."""
    known = F.greatest(F.coalesce(pop.cast("double"), F.lit(1e6)), F.lit(1e4))
    scaled = (F.log10(known) - 4) / (F.log10(F.lit(1.5e9)) - 4)
    return F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0))


def linear_weight(df: DataFrame, pop: str, by: str, out: str) -> DataFrame:
    """Marker weight in [0, 1], linear between each group's smallest and largest value."""
    value = F.coalesce(F.col(pop).cast("double"), F.lit(1e6))
    spans = df.groupBy(by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    scaled = (value - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + 1)
    return (
        df.join(spans, by)
        .withColumn(out, F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0)))
        .drop("_lo", "_hi")
    )


def clip_floor(col: Column, floor: float = 0) -> Column:
    return F.when(col.isNotNull(), F.greatest(col, F.lit(floor)))


def month_label(date: Column) -> Column:
    return F.date_format(F.trunc(date, "month"), "MMM yyyy")


def tier(col: Column, cuts: list[tuple[float, str]], otherwise: str) -> Column:
    """First label whose lower bound the value reaches; cuts run from high to low."""
    (bound, name), *rest = cuts
    chain = F.when(col >= bound, F.lit(name))
    for bound, name in rest:
        chain = chain.when(col >= bound, F.lit(name))
    return chain.otherwise(F.lit(otherwise))
