"""Column-level cleaning: sentinels, plausible ranges, recodes, flag algebra.

Everything here takes and returns Column expressions (or a DataFrame with
columns replaced), so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_int(c: Column | str) -> Column:
    """Lenient integer read of a field that some vintages store as text."""
    return as_col(c).try_cast("int")


def nullify(c: Column | str, values: Iterable) -> Column:
    """NULL where the value is one of the sentinels, unchanged otherwise."""
    c = as_col(c)
    return F.when(c.isin(list(values)), None).otherwise(c)


def nullify_outside(c: Column | str, lo=None, hi=None) -> Column:
    """NULL where the value lies outside the closed range [lo, hi]."""
    c = as_col(c)
    tests = [c >= F.lit(lo)] if lo is not None else []
    tests += [c <= F.lit(hi)] if hi is not None else []
    return F.when(reduce(and_, tests), c)


def blank_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(F.trim(c) != "", c)


def recode(c: Column | str, mapping: Mapping[object, Sequence], normalise: bool = False) -> Column:
    """Map raw spellings to labels: ``{label: [raw, ...]}``; anything else is NULL.

    ``normalise`` trims and lower-cases the raw value first.
    """
    c = as_col(c)
    if normalise:
        c = F.trim(F.lower(c))
    out = None
    for label, raws in mapping.items():
        test = c.isin(list(raws))
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out


def case_update(c: Column | str, updates: Sequence[tuple[Column, object]]) -> Column:
    """A run of conditional updates to one column, the last true one winning.

    A condition that is NULL leaves the value alone.
    """
    out = None
    for cond, value in reversed(list(updates)):
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return as_col(c) if out is None else out.otherwise(as_col(c))


def zero_where(df: DataFrame, cols: Iterable[str], cond: Column) -> DataFrame:
    """Set every listed column to 0 on the rows where the condition holds."""
    return df.withColumns({c: F.when(cond, F.lit(0)).otherwise(F.col(c)).cast(df.schema[c].dataType) for c in cols})


def any_true(cols: Iterable[Column | str]) -> Column:
    """Three-valued OR across flags."""
    return reduce(or_, [as_col(c) for c in cols])


def count_true(cols: Iterable[Column | str]) -> Column:
    """How many of the flags are true; NULL if any flag is NULL."""
    return reduce(lambda a, b: a + b, [as_col(c).cast("int") for c in cols])


def max_or_null(c: Column | str) -> Column:
    """Aggregate: the maximum, or NULL as soon as one input is NULL."""
    c = as_col(c)
    return F.when(F.count_if(c.isNull()) == 0, F.max(c))


def flag_by_pattern(pattern: str, *cols: Column | str) -> Column:
    """True if any of the text columns contains the (lower-case) pattern."""
    return any_true([F.coalesce(F.lower(as_col(c)).rlike(pattern), F.lit(False)) for c in cols])
