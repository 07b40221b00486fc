"""Reports that let a user see what a step did. All return small DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Number of rows breaking each rule (a rule that is NULL is not broken)."""
    row = df.agg(*[F.count_if(~c).alias(n) for n, c in rules.items()])
    return row.unpivot([], list(rules), "rule", "n_violations")


def violating(df: DataFrame, rule: Column) -> DataFrame:
    """The rows that break a rule."""
    return df.filter(~rule)


def tabulate(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Frequencies, NULL counted as a value of its own."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Rows against distinct keys."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("n_unique"))


def missingness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULLs per column."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return row.unpivot([], list(cols), "column", "n_missing")
