"""Long to wide and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "variable", value: str = "value",
         drop_blank: bool = True) -> DataFrame:
    """One row per id and value column; NULL and empty values dropped by default."""
    long = df.unpivot(list(ids), list(values), variable, value)
    if drop_blank:
        v = F.col(value)
        long = long.filter(v.isNotNull() & (v.cast("string") != ""))
    return long


def dcast(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    by_values: Sequence,
    values: Sequence[str],
) -> DataFrame:
    """Wide columns ``<value>_<by>`` for the given values of ``by``.

    One value per cell is expected; if there are several the largest is taken.
    """
    here = {b: F.col(by) == b for b in by_values}
    return df.groupBy(*keys).agg(*[F.max(F.when(here[b], F.col(v))).alias(f"{v}_{b}") for v in values for b in by_values])
