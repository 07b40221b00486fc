"""Person-by-school-year panels, per-person windows, sums and rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.functions.dates import end_of_august, september
from linkcohort.functions.values import as_col


def with_year7(df: DataFrame, spine: DataFrame, on: str, y7: str = "y7_year") -> DataFrame:
    """Inner join the year-7 year of cohort members; others drop out.

    Doubles as the restriction to the cohort, so no separate semi-join is needed.
    """
    return df.join(spine.select(on, y7).filter(F.col(y7).isNotNull()).distinct(), on, "inner")


def school_year_panel(
    df: DataFrame, spine: DataFrame, on: str, academic_year: str, lo: int, hi: int, y7: str = "y7_year", out: str = "year"
) -> DataFrame:
    """School year a record falls in for its person, kept within [lo, hi]."""
    return (
        with_year7(df, spine, on, y7)
        .withColumn(out, F.col(academic_year) - (F.col(y7) - 7))
        .filter(F.col(out).between(lo, hi))
    )


def within_window(
    df: DataFrame, date: Column | str, lo: Column, hi: Column, joiner: str = "and"
) -> DataFrame:
    """Rows dated in [lo, hi). ``joiner='or'`` keeps rows meeting either bound."""
    d = as_col(date)
    if joiner == "or":
        return df.filter((d >= lo) | (d <= hi))
    return df.filter((d >= lo) & (d < hi))


def within_school_window(
    df: DataFrame,
    spine: DataFrame,
    on: str,
    date: str,
    back_from: int = 7,
    back_to: int = 1,
    end_inclusive: bool = False,
    y7: str = "y7_year",
) -> DataFrame:
    """Rows from 1 September of (y7 - back_from) up to 31 August of (y7 - back_to).

    The last day itself is left out unless ``end_inclusive``.
    """
    df = with_year7(df, spine, on, y7)
    hi = end_of_august(F.col(y7) - back_to)
    return within_window(df, date, september(F.col(y7) - back_from), F.date_add(hi, 1) if end_inclusive else hi)


def around_event(
    df: DataFrame, events: DataFrame, on: str, date: str, index: str, days_before: int, days_after: int
) -> DataFrame:
    """Rows within so many days of the person's index date (one per person)."""
    joined = df.join(events.select(on, index).filter(F.col(index).isNotNull()), on, "inner")
    return within_window(
        joined, date, F.date_sub(F.col(index), days_before), F.date_add(F.col(index), days_after + 1)
    )


def collapse_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum several enrolments into one row per key; a missing value counts as 0."""
    return df.groupBy(*keys).agg(*[F.expr(f"coalesce(sum(`{m}`), 0) AS `{m}`") for m in measures])


def annualise(df: DataFrame, stems: Sequence[str], terms: Sequence[str], suffix: str = "annual") -> DataFrame:
    """``<stem>_annual`` as the sum of ``<stem>_<term>``, missing terms as 0."""
    totals = {f"{s}_{suffix}": F.expr(" + ".join(f"coalesce(`{s}_{t}`, 0)" for t in terms)) for s in stems}
    return df.withColumns(totals).drop(*[f"{s}_{t}" for s in stems for t in terms])


def rate(numerator: Column | str, denominator: Column | str) -> Column:
    """Percentage to one decimal; NULL if the denominator is 0."""
    return F.round(F.try_divide(as_col(numerator), as_col(denominator)) * 100, 1)


def rates(df: DataFrame, of: Mapping[str, str], denominator: str) -> DataFrame:
    """Several percentages with one denominator: ``{rate column: numerator}``."""
    return df.withColumns({out: rate(num, denominator) for out, num in of.items()})
