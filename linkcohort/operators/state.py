"""Reductions as states that can be stored and merged, so that new extracts need no second look at the old ones.

A state has one row per person, column and value (counts) or per person (bounds);
merging two is one more aggregate, and a state is never larger than the distinct
values of each person, however many rows they came from.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_state(df: DataFrame, on: str, cols: Sequence[str]) -> DataFrame:
    """``on``, ``variable``, ``value``, ``n``: how often each person has each value; NULL values are not counted.

    Values are text; the types come back with :func:`modes_of`.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in cols])
    rows = df.filter(F.col(on).isNotNull()).select(on, F.explode(cells).alias("_c")).select(on, "_c.*")
    # a person without any value keeps a row, so that it is not lost
    kept = rows.groupBy(on, "variable", "value").agg(F.count(F.lit(1)).alias("n"))
    return kept.withColumn("n", F.when(F.col("value").isNull(), 0).otherwise(F.col("n")))


def merge_counts(*states: DataFrame) -> DataFrame:
    """The state of all rows that the states were made from."""
    both = reduce(DataFrame.unionByName, states)
    on = next(c for c in both.columns if c not in ("variable", "value", "n"))
    return both.groupBy(on, "variable", "value").agg(F.sum("n").alias("n"))


def modes_of(state: DataFrame, on: str, types: Mapping[str, str]) -> DataFrame:
    """Each person's most frequent value of each column of ``types``, the smallest of several, as :func:`modal` gives it."""

    def pick(c: str, kind: str) -> Column:
        here = (F.col("variable") == c) & F.col("value").isNotNull()
        return F.min(F.when(here, F.struct((-F.col("n")).alias("less"), F.col("value").cast(kind).alias("v"))))["v"].alias(c)

    return state.groupBy(on).agg(*[pick(c, kind) for c, kind in types.items()])


def bound_state(df: DataFrame, on: str, bounds: Sequence[str] = (), flags: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per person: least and greatest value of each column (``<col>_least``, ``<col>_greatest``) and whether any row meets each condition."""
    low = [F.min(c).alias(f"{c}_least") for c in bounds] + [F.max(c).alias(f"{c}_greatest") for c in bounds]
    ever = [F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in (flags or {}).items()]
    return df.filter(F.col(on).isNotNull()).groupBy(on).agg(*low, *ever)


def merge_bounds(*states: DataFrame) -> DataFrame:
    """Merges states of :func:`bound_state`: the first column is the person's, flags are the boolean ones."""
    both = reduce(DataFrame.unionByName, states)
    on, rest = both.columns[0], both.columns[1:]
    flags = {f.name for f in both.schema.fields if f.dataType.simpleString() == "boolean" and not f.name.endswith(("_least", "_greatest"))}
    how = {c: F.bool_or if c in flags else F.min if c.endswith("_least") else F.max for c in rest}
    return both.groupBy(on).agg(*[how[c](c).alias(c) for c in rest])
