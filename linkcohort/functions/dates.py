"""Academic-year and approximate-date arithmetic on columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.functions.values import as_col, as_int


def parse_date(c: Column | str) -> Column:
    """A date from ``yyyy-MM-dd`` text; anything unreadable becomes NULL.

    A cast reads this form an order of magnitude faster than a format string; it
    would also take a bare year or month, which the length rules out.
    """
    c = as_col(c)
    return F.when(F.length(c) >= 8, c.try_cast("date"))


def month_date(year: Column | str, month: Column | str, day: int = 15) -> Column:
    """Mid-month date for a known year and month (NULL for an impossible one)."""
    y, m = as_int(year), as_int(month)
    text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lit(f"{day:02d}"))
    return F.when(y.isNotNull() & m.isNotNull(), parse_date(text))


def dob_approx(mydob: Column | str) -> Column:
    """Approximate birth date, on the 15th, from ``mmyyyy`` or ``myyyy``."""
    raw = as_col(mydob).cast("string")
    text = F.when(F.length(raw) == 5, F.lpad(raw, 6, "0")).otherwise(raw)
    return month_date(F.substring(text, 3, 4), F.substring(text, 1, 2))


def academic_year(date: Column | str) -> Column:
    """Year in which the September that opens the next school year falls due."""
    date = as_col(date)
    return F.year(date) + (F.month(date) >= 9).cast("int")


def inception_year(academic_yob: Column | str) -> Column:
    """Academic year (ending) in which a birth cohort sits in year 7."""
    return as_col(academic_yob) + F.lit(12)


def parse_acad_year(c: Column | str) -> Column:
    """2015 from ``'2014/2015'``."""
    return F.substring(as_col(c), 6, 4).try_cast("int")


def september(year: Column | str | int) -> Column:
    return F.make_date(F.lit(year) if isinstance(year, int) else as_col(year), F.lit(9), F.lit(1))


def end_of_august(year: Column | str | int) -> Column:
    return F.make_date(F.lit(year) if isinstance(year, int) else as_col(year), F.lit(8), F.lit(31))


def offset_dates(df: DataFrame, date: str, days: Iterable[int]) -> DataFrame:
    """Add one shifted copy of a date column per offset, ``<date>_plus_<n>_days``."""
    return df.withColumns({f"{date}_plus_{n}_days": F.date_add(F.col(date), n) for n in days})


def waiting_days(referred: Column | str, seen: Column | str) -> Column:
    """Days from a referral to the date seen."""
    return F.datediff(as_col(seen), as_col(referred))
