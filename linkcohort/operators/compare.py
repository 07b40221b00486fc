"""Comparing sources and groups of people: concordance of values, balance of covariates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concordance(a: DataFrame, b: DataFrame, on: str, cols: Sequence[str]) -> DataFrame:
    """``variable``, ``value_a``, ``value_b``, ``n``: how many people have which pair of values in two sources.

    Both sources have one row per person and the same columns; people of one
    source alone are left out, a missing value is a value. One join of the ids and
    one pass over all variables; what is shuffled after it are counts.
    """
    both = a.select(on, *[F.col(c).cast("string").alias(f"_a_{c}") for c in cols]).join(
        b.select(on, *[F.col(c).cast("string").alias(f"_b_{c}") for c in cols]), on
    )
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(f"_a_{c}").alias("value_a"), F.col(f"_b_{c}").alias("value_b")) for c in cols]
    return both.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").groupBy("variable", "value_a", "value_b").agg(F.count(F.lit(1)).alias("n"))


def agreement(pairs: DataFrame) -> DataFrame:
    """Per variable of :func:`concordance`: people with both values, one or none, share that agree, Cohen's kappa.

    Kappa is NULL where chance alone would always agree. Works on the counts of
    pairs only.
    """
    known = F.col("value_a").isNotNull() & F.col("value_b").isNotNull()

    def people(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

    totals = pairs.groupBy("variable").agg(
        people(known).alias("n_both"),
        people(F.col("value_a").isNotNull() & F.col("value_b").isNull()).alias("n_only_a"),
        people(F.col("value_a").isNull() & F.col("value_b").isNotNull()).alias("n_only_b"),
        people(F.col("value_a").isNull() & F.col("value_b").isNull()).alias("n_neither"),
        people(F.col("value_a") == F.col("value_b")).alias("n_agree"),
    )
    sides = F.array(F.struct(F.col("value_a").alias("v"), F.col("n").alias("x"), F.lit(0).alias("y")), F.struct(F.col("value_b").alias("v"), F.lit(0).alias("x"), F.col("n").alias("y")))
    margins = pairs.filter(known).select("variable", F.explode(sides).alias("m")).groupBy("variable", "m.v").agg(F.sum("m.x").alias("x"), F.sum("m.y").alias("y"))
    chance = margins.groupBy("variable").agg(F.sum(F.col("x").cast("double") * F.col("y")).alias("_by_chance"))
    n = F.col("n_both").cast("double")
    expected = F.col("_by_chance") / (n * n)
    out = totals.join(chance, "variable", "left")
    return out.select(
        "variable", "n_both", "n_only_a", "n_only_b", "n_neither", "n_agree",
        F.round(F.try_divide(F.col("n_agree") * 100.0, n), 1).alias("pct_agree"),
        F.round(F.try_divide(F.try_divide(F.col("n_agree"), n) - expected, 1 - expected), 4).alias("kappa"),
    )


def standardised_differences(df: DataFrame, group: Column, numbers: Sequence[str], categories: Sequence[str] = ()) -> DataFrame:
    """``variable``, ``level``, ``n_in``, ``n_out``, ``mean_in``, ``mean_out``, ``std_diff`` of people in a group and out of it.

    For a number, the difference of means over the root of the mean of both
    variances (n - 1); for each level of a category, the same of its shares. Missing
    values are left out of their variable and counted nowhere; a NULL ``group`` is
    out. All from one pass of grouped moments.
    """
    none = F.lit(None).cast("string")
    cells = [F.struct(F.lit(c).alias("variable"), none.alias("level"), F.col(c).cast("double").alias("x")) for c in numbers]
    cells += [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level"), F.when(F.col(c).isNotNull(), 1.0).alias("x")) for c in categories]
    rows = df.select(F.coalesce(group, F.lit(False)).alias("_in"), F.explode(F.array(*cells)).alias("c")).select("_in", "c.*").filter(F.col("x").isNotNull())

    def moments(inside: bool) -> list[Column]:
        x = F.when(F.col("_in") if inside else ~F.col("_in"), F.col("x"))
        name = "in" if inside else "out"
        return [F.count(x).alias(f"n_{name}"), F.avg(x).alias(f"_mean_{name}"), F.var_samp(x).alias(f"_var_{name}")]

    by_level = rows.groupBy("variable", "level").agg(*moments(True), *moments(False))
    totals = by_level.groupBy("variable").agg(F.sum("n_in").alias("_all_in"), F.sum("n_out").alias("_all_out"))
    out = by_level.join(totals, "variable")
    number = F.col("level").isNull()

    def mean(name: str) -> Column:
        return F.when(number, F.col(f"_mean_{name}")).otherwise(F.try_divide(F.col(f"n_{name}"), F.col(f"_all_{name}")))

    out = out.withColumns({"mean_in": mean("in"), "mean_out": mean("out")})

    def variance(name: str) -> Column:
        p = F.col(f"mean_{name}")
        return F.when(number, F.col(f"_var_{name}")).otherwise(p * (1 - p))

    spread = F.sqrt((variance("in") + variance("out")) / 2)
    diff = F.try_divide(F.col("mean_in") - F.col("mean_out"), spread)
    return out.select(
        "variable", "level", "n_in", "n_out", F.round("mean_in", 4).alias("mean_in"), F.round("mean_out", 4).alias("mean_out"), F.round(diff, 4).alias("std_diff")
    )


def linkage_bias(people: DataFrame, linked: str, numbers: Sequence[str], categories: Sequence[str] = ()) -> DataFrame:
    """:func:`standardised_differences` of people with the other identifier and without it."""
    return standardised_differences(people, F.col(linked).isNotNull(), numbers, categories)
