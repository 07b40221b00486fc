"""Finding the tables of a family by name, in a session catalog or a mapping."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

Tables = Mapping[str, DataFrame] | SparkSession


def table_names(tables: Tables) -> list[str]:
    """Names of every table and view on offer."""
    if isinstance(tables, Mapping):
        return sorted(tables)
    return sorted(t.name for t in tables.catalog.listTables())


def open_table(tables: Tables, name: str) -> DataFrame:
    return tables[name] if isinstance(tables, Mapping) else tables.table(name)


def discover(
    tables: Tables,
    include: str,
    years: Iterable[int] | None = None,
    exclude: str | None = None,
) -> list[str]:
    """Table names that match ``include``, mention one of ``years`` and miss ``exclude``.

    Only names are looked at, so tables outside the years are never opened.
    """
    wanted = [str(y) for y in years] if years is not None else None
    return [
        n
        for n in table_names(tables)
        if re.search(include, n, re.IGNORECASE)
        and (wanted is None or any(y in n for y in wanted))
        and not (exclude and re.search(exclude, n, re.IGNORECASE))
    ]
