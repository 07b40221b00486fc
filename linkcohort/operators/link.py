"""Joining onto a spine: semi, anti, left, existence flags, bridging links.

A spine usually has people without the identifier being joined on. Those rows
can match nothing, and hashed together they would be one huge partition, so
left joins here set them aside and add them back.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.operators.reduce import first_per


def restrict_to(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose id is among ``ids`` (NULL ids are dropped)."""
    return df.join(ids.select(on), on, "left_semi")


def add_new_members(spine: DataFrame, extra: DataFrame, on: str, order_by: Sequence[str]) -> DataFrame:
    """Append people of ``extra`` who are not on the spine yet, one row each."""
    new = extra.join(spine.select(on), on, "left_anti")
    return spine.unionByName(first_per(new, on, order_by), allowMissingColumns=True)


def attach(
    spine: DataFrame,
    on: str,
    *summaries: DataFrame,
    fill: Mapping[str, object] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Left join one-row-per-id summaries onto the spine.

    ``fill`` gives the value of a column for people who have an id but no row in
    its summary; people without an id get NULL. ``null_safe`` matches a NULL id
    to a NULL id instead.

    All summaries keyed alike are joined in one call, so the spine is exchanged
    once per identifier.
    """
    if null_safe:
        out = spine
        for s in summaries:
            s = s.withColumnRenamed(on, "_on")
            out = out.join(s, F.col(on).eqNullSafe(F.col("_on")), "left").drop("_on")
        return _fill(out, fill)
    out = spine.filter(F.col(on).isNotNull())
    for s in summaries:
        out = out.join(s, on, "left")
    out = _fill(out, fill).select(*spine.columns, *[c for s in summaries for c in s.columns if c != on])
    return out.unionByName(spine.filter(F.col(on).isNull()), allowMissingColumns=True)


def _fill(df: DataFrame, fill: Mapping[str, object] | None) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()}) if fill else df


def exists_summary(df: DataFrame, on: str, flags: Mapping[str, Column]) -> DataFrame:
    """One row per id: whether any of its rows meets each condition."""
    return df.groupBy(on).agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in flags.items()])


def flag_exists(
    spine: DataFrame,
    df: DataFrame,
    on: str,
    flags: Mapping[str, Column],
    negate: Iterable[str] = (),
) -> DataFrame:
    """Flags "this id has a row in df that meets ..."; NULL where the id is NULL.

    Any number of flags cost one aggregate and one join. Those in ``negate``
    say that there is no such row.
    """
    out = attach(spine, on, exists_summary(df, on, flags), fill={n: False for n in flags})
    return out.withColumns({n: ~F.col(n) for n in negate})


def flags_by_group(
    spine: DataFrame,
    df: DataFrame,
    on: str,
    group: str,
    groups: Sequence[str],
    prefix: str,
    where: Column | None = None,
) -> DataFrame:
    """One flag per category, ``<prefix><category>``, for categories named up front."""
    cond = {f"{prefix}{g}": F.col(group) == g for g in groups}
    if where is not None:
        cond = {n: c & where for n, c in cond.items()}
    return flag_exists(spine, df, on, cond)


def link(
    spine: DataFrame,
    bridge: DataFrame,
    on: str,
    add: str,
    unique: Sequence[str] | None = None,
) -> DataFrame:
    """Add the other identifier through a bridging table that is unique on neither.

    ``unique`` names the identifiers to make unique, in turn: the first pair of
    each, by the other identifier. The default is ``add`` then ``on``, after which
    the spine cannot fan out; with ``add`` alone a person linked to several
    identifiers appears once for each.
    """
    pairs = restrict_to(bridge.select(on, add).filter(F.col(add).isNotNull()), spine, on)
    for c in unique or [add, on]:
        pairs = first_per(pairs, c, [add if c == on else on])
    return attach(spine, on, pairs)


def linkage_report(spine: DataFrame, linked: str, by: Sequence[str] = ()) -> DataFrame:
    """How many people carry the other identifier, and what share, per group."""
    rows = spine.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(linked).alias("n_linked"),
        F.countDistinct(linked).alias("n_distinct"),
    )
    return rows.withColumn("pct_linked", F.round(F.col("n_linked") * 100.0 / F.col("n"), 1))


def eligibility(df: DataFrame, id_col: str, dob: str, lo: Column, hi: Column) -> DataFrame:
    """``born_in_year``: dob in [lo, hi); ``eligible``: that and the id is known.

    FALSE without an id; NULL with an id but no dob.
    """
    born = (F.col(dob) >= lo) & (F.col(dob) < hi)
    return df.withColumns({"born_in_year": born, "eligible": F.col(id_col).isNotNull() & born})


def flag_by_lookup(df: DataFrame, lookup: DataFrame, on: str, cond: Column, out: str) -> DataFrame:
    """True on rows whose key is a lookup row meeting the condition, else NULL."""
    hits = lookup.filter(cond).select(on).distinct().withColumn(out, F.lit(True))
    return df.join(hits, on, "left")


def fill_from(df: DataFrame, other: DataFrame, on: str, cols: Sequence[str]) -> DataFrame:
    """Fill missing values from a second source, flagging where the two disagree."""
    renamed = other.select(on, *[F.col(c).alias(f"_o_{c}") for c in cols])
    out = attach(df, on, renamed)
    return out.withColumns(
        {f"{c}_differs": F.col(c) != F.col(f"_o_{c}") for c in cols}
        | {c: F.coalesce(F.col(c), F.col(f"_o_{c}")) for c in cols}
    ).drop(*[f"_o_{c}" for c in cols])
