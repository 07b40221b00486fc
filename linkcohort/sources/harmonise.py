"""One canonical frame out of many yearly tables whose column names drift."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.functions.values import as_col, as_int
from linkcohort.sources.catalog import Tables, open_table


def numbered(prefix: str, n: int) -> list[str]:
    """``prefix_01 .. prefix_n``."""
    return [f"{prefix}_{i:02d}" for i in range(1, n + 1)]


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def find_column(df: DataFrame, pattern: str) -> str | None:
    """The one column whose lower-cased name matches; an error if several do."""
    return _find(df.columns, pattern)


def _find(names: Sequence[str], pattern: str) -> str | None:
    hits = [c for c in names if re.search(pattern, c.lower())]
    if len(hits) > 1:
        raise ValueError(f"pattern {pattern!r} matches several columns: {hits}")
    return hits[0] if hits else None


def harmonise(
    df: DataFrame,
    columns: Mapping[str, str],
    types: Mapping[str, str] | None = None,
    optional: Iterable[str] = (),
) -> DataFrame:
    """Select and rename columns found by regex, in canonical order.

    ``types`` casts (leniently). A column that is absent is an error unless it
    is ``optional``, in which case it is a typed NULL.
    """
    return df.selectExpr(*canonical(df, columns, types, optional))


def canonical(
    df: DataFrame, columns: Mapping[str, str], types: Mapping[str, str] | None = None, optional: Iterable[str] = ()
) -> list[str]:
    """The select list of :func:`harmonise`, as SQL expressions."""
    types, optional = types or {}, set(optional)
    names, out = df.columns, []
    for canon, pattern in columns.items():
        hit = _find(names, pattern)
        if hit is None and canon not in optional:
            raise ValueError(f"no column matches {pattern!r} among {names}")
        if hit is None:
            out.append(f"CAST(NULL AS {types.get(canon, 'string')}) AS `{canon}`")
        elif canon in types:
            out.append(f"TRY_CAST(`{hit}` AS {types[canon]}) AS `{canon}`")
        else:
            out.append(f"`{hit}` AS `{canon}`")
    return out


def year_group(
    years: Sequence[str | int],
    age_op: str | None = None,
    age: int | None = None,
    year_col: str = "ncyearactual",
    age_col: str = "ageatstart",
    ungraded: str = "X",
) -> Column:
    """In one of the year groups, or ungraded and on the right side of an age."""
    in_year = F.col(year_col).isin([str(y) for y in years])
    if age_op is None:
        return in_year
    a = as_int(age_col)
    test = {"==": a == age, "<": a < age, "<=": a <= age, ">": a > age, ">=": a >= age}[age_op]
    return in_year | ((F.col(year_col) == ungraded) & test)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, matched by column name, missing columns as NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_family(
    tables: Tables,
    names: Sequence[str],
    columns: Mapping[str, str],
    types: Mapping[str, str] | None = None,
    optional: Iterable[str] | Callable[[str], Iterable[str]] = (),
    where: Column | Callable[[str], Column | None] | None = None,
    keep: Sequence[str] | None = None,
    lineage: str = "source_table",
) -> DataFrame:
    """Harmonise every table of a family and stack them, with the table name kept.

    ``where`` is a predicate on canonical columns; it and ``optional`` may also be
    functions of the table name, for vintages that need their own. Columns in ``columns`` but not
    in ``keep`` serve the predicate only. One lazy plan: each branch prunes its
    columns and pushes its predicate to its own scan.
    """
    if not names:
        raise ValueError("no table of the family was found")
    frames = []
    for name in names:
        absent = optional(name) if callable(optional) else optional
        df = harmonise(open_table(tables, name), columns, types, absent)
        cond = where(name) if callable(where) else where
        if cond is not None:
            df = df.filter(cond)
        frames.append(df.selectExpr(*(f"`{c}`" for c in keep or columns), f"'{name}' AS `{lineage}`"))
    return union_all(frames)


def census_year(name: Column | str) -> Column:
    """2015 from ``Autumn_Census_2015``."""
    return F.regexp_extract(F.lower(as_col(name)), r"_census_([0-9]+)", 1).try_cast("int")


def census_term(name: Column | str) -> Column:
    """``autumn`` from ``Autumn_Census_2015``."""
    return F.regexp_extract(F.lower(as_col(name)), r"^([a-z]+)_census_[0-9]", 1)
