"""Reading the school census family, alternative provision and referral units."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.config import AP_COLUMNS, CENSUS_COLUMNS, CENSUS_TYPES, PRU_COLUMNS, Config
from linkcohort.functions import parse_acad_year
from linkcohort.operators import restrict_to
from linkcohort.sources import Tables, discover, union_family

READING_YEARS = ("R", 1, 2, 3, 4, 5, 6, 7)


@dataclass(frozen=True)
class CensusStep:
    """A study's tables, with the rows of :func:`census_step` in place of its censuses."""

    tables: Tables
    rows: DataFrame


def census_rows(
    tables: Tables,
    cfg: Config,
    years: Iterable[int],
    keep: Sequence[str],
    where: Column | Callable[[str], tuple[Hashable, Column]] | None,
    optional: Callable[[str], Iterable[str]] = lambda name: (),
) -> DataFrame:
    """Canonical columns of every census of the given years, with ``source_table``.

    A ``where`` that depends on the table returns what its rule is known by, and the rule.
    """
    if isinstance(tables, CensusStep):
        return _from_step(tables, cfg, years, keep, where)
    names = discover(tables, cfg.census_tables, years, cfg.census_exclude)
    need = [*keep, "ncyearactual", "ageatstart"] if where is not None else keep
    columns = {c: CENSUS_COLUMNS[c] for c in dict.fromkeys(need)}
    types = {c: CENSUS_TYPES[c] for c in columns}
    return union_family(tables, names, columns, types, optional, (lambda n: where(n)[1]) if callable(where) else where, keep)


def _from_step(step: CensusStep, cfg: Config, years: Iterable[int], keep: Sequence[str], where) -> DataFrame:
    names = discover(step.tables, cfg.census_tables, years, cfg.census_exclude)
    table, cond = F.col("source_table"), where
    if callable(where):
        by_rule: dict[Hashable, tuple[Column, list[str]]] = {}
        for n in names:
            rule, c = where(n)
            by_rule.setdefault(rule, (c, []))[1].append(n)
        cond = reduce(lambda a, b: a | b, [table.isin(ns) & c for c, ns in by_rule.values()], F.lit(False))
    rows = step.rows.filter(table.isin(names))
    return (rows if cond is None else rows.filter(cond)).select(*keep, "source_table")


def census_step(tables: Tables, cfg: Config, spine: DataFrame) -> DataFrame | None:
    """Every census that a module reads, harmonised and cut to the spine, once for all of them.

    Columns that a vintage lacks are NULL. None if there is no census.
    """
    names = discover(tables, cfg.census_tables, sorted({*cfg.primary_years, *cfg.secondary_years}), cfg.census_exclude)
    if not names:
        return None
    columns = {c: CENSUS_COLUMNS[c] for c in CENSUS_TYPES}
    rows = union_family(tables, names, columns, CENSUS_TYPES, [c for c in columns if c != "pmr"])
    return restrict_to(rows, spine, "pmr")


def _family(tables: Tables, pattern: str, columns: dict[str, str], want: Sequence[str]) -> DataFrame | None:
    """All tables of a family, or None if there is none."""
    tables = tables.tables if isinstance(tables, CensusStep) else tables
    names = discover(tables, f"^{pattern}")
    if not names:
        return None
    columns = {c: columns[c] for c in want}
    df = union_family(tables, names, columns, {c: CENSUS_TYPES[c] for c in columns}).drop("source_table")
    return df.withColumn("academicyear", parse_acad_year("academicyear")) if "academicyear" in want else df


def ap_rows(tables: Tables, cfg: Config, keep: Sequence[str], where: Column) -> DataFrame | None:
    """Alternative provision rows; ``where`` may use ``academicyear`` and ``ageatstart``."""
    want = list(dict.fromkeys([*keep, "academicyear", "ageatstart"]))
    df = _family(tables, cfg.ap_table, AP_COLUMNS, want)
    return None if df is None else df.filter(where).select(*keep)


def pru_rows(tables: Tables, cfg: Config, keep: Sequence[str], where: Column) -> DataFrame | None:
    """Referral-unit rows; ``where`` may use ``ncyearactual`` and ``ageatstart``."""
    want = list(dict.fromkeys([*keep, "ncyearactual", "ageatstart"]))
    df = _family(tables, cfg.pru_table, PRU_COLUMNS, want)
    return None if df is None else df.filter(where).select(*keep)


def academic_years(years: Iterable[int]) -> Column:
    years = list(years)
    return F.col("academicyear").between(min(years), max(years))
