"""School panels: enrolment, exclusion, absence, exams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.config import ABSENCE_STEMS, ABSENCE_TERMS, Config
from linkcohort.functions import parse_acad_year, zero_where
from linkcohort.operators import (
    annualise, collapse_sum, ever, rate, rates, restrict_to, school_year_panel,
)
from linkcohort.plans.census import academic_years, ap_rows, census_rows
from linkcohort.sources import Tables, discover, union_family

ANNUAL_RATES = {
    "abs_auth_rate": "authorised_annual",
    "abs_unauth_rate": "unauthorised_annual",
    "abs_overall_rate": "overall_annual",
    "abs_illness_rate": "illness_annual",
    "abs_appts_rate": "appts_annual",
    "abs_illness_appts_rate": "illness_appts_annual",
}


def enrolments(tables: Tables, cfg: Config, spine: DataFrame) -> DataFrame:
    """Which censuses each pupil is in, school years 8 to 11."""
    years = cfg.secondary_years[1:]
    rows = census_rows(tables, cfg, years, ["pmr", "academicyear"], None)
    rows = rows.select(
        "pmr",
        parse_acad_year("academicyear").alias("academicyear"),
        F.substring_index("source_table", "_", 1).alias("census"),
    )
    ap = ap_rows(tables, cfg, ["pmr", "academicyear"], academic_years(years))
    if ap is not None:
        rows = rows.unionByName(ap.withColumn("census", F.lit("AP")))
    return school_year_panel(rows.distinct(), spine, "pmr", "academicyear", 8, 11)


def exclusions(tables: Tables, cfg: Config, spine: DataFrame) -> DataFrame:
    """Distinct exclusion events in school years 7 to 11."""
    names = discover(tables, cfg.exclusion_tables, cfg.secondary_years)
    columns = {
        "pmr": "pupilmatchingrefanonymous", "academicyear": "^academicyear",
        "exclusion_category": "category", "sessions": "sessions", "startdate": "startdate",
    }
    rows = union_family(tables, names, columns).drop("source_table").distinct()
    rows = rows.withColumn("academicyear", parse_acad_year("academicyear"))
    return school_year_panel(rows, spine, "pmr", "academicyear", 7, 11)


def exclusion_kinds(fixed_term: Sequence[str], permanent: Sequence[str]) -> dict[str, Column]:
    """Conditions that split exclusions into fixed-term and permanent."""
    category = F.col("exclusion_category")
    return {"ever_fixed_term": category.isin(list(fixed_term)), "ever_permanent": category.isin(list(permanent))}


def absence_rows(tables: Tables, cfg: Config) -> DataFrame:
    names = discover(tables, cfg.absence_tables, cfg.secondary_years)
    measures = {f"{s}_{t}": sp + tp for s, sp in ABSENCE_STEMS.items() for t, tp in ABSENCE_TERMS.items()}
    columns = {"pmr": "pupilmatchingrefanonymous", "academicyear": "^academicyear", **measures}
    rows = union_family(tables, names, columns, dict.fromkeys(measures, "int")).drop("source_table")
    return rows.withColumn("academicyear", parse_acad_year("academicyear"))


def annual_absence(panel: DataFrame, cfg: Config, stems=tuple(ABSENCE_STEMS), terms=tuple(ABSENCE_TERMS)) -> DataFrame:
    """Sessions per pupil and school year over all terms and enrolments.

    Summer does not count in year 11; implausibly long years are dropped.
    """
    measures = [f"{s}_{t}" for s in stems for t in terms]
    df = collapse_sum(panel, ["pmr", "year"], measures)
    summer = [m for m in measures if m.rsplit("_", 1)[1] in cfg.year11_zeroed_terms]
    df = annualise(zero_where(df, summer, F.col("year") == 11), stems, terms)
    return df.filter(F.col("sessionspossible_annual") <= cfg.max_sessions)


def absence(tables: Tables, cfg: Config, spine: DataFrame) -> DataFrame:
    """Absence rates per pupil and school year 7 to 11, and persistent absence."""
    panel = school_year_panel(absence_rows(tables, cfg), spine, "pmr", "academicyear", 7, 11)
    return absence_rates(annual_absence(panel, cfg), cfg, dict(cfg.persistent_flags))


def absence_rates(df: DataFrame, cfg: Config, persistent: dict[str, str] | None = None) -> DataFrame:
    """Six rates and a persistent-absence flag on the (rounded) overall rate.

    ``persistent`` adds flags on other rates, ``{flag: rate column}``.
    """
    df = df.withColumn("illness_appts_annual", F.col("illness_annual") + F.col("appts_annual"))
    df = rates(df, ANNUAL_RATES, "sessionspossible_annual")
    flags = {"pa10": "abs_overall_rate", **(persistent or {})}
    df = df.withColumns({n: F.col(r) >= cfg.persistent_at for n, r in flags.items()})
    return df.select("pmr", "year", "sessionspossible_annual", *ANNUAL_RATES, *flags)


def termly_rates(panel: DataFrame, cfg: Config, stem: str = "overall") -> DataFrame:
    """One absence rate per term instead of per year."""
    terms = list(ABSENCE_TERMS)
    measures = [f"{s}_{t}" for s in ("sessionspossible", stem) for t in terms]
    df = collapse_sum(panel, ["pmr", "year"], measures)
    summer = [m for m in measures if m.rsplit("_", 1)[1] in cfg.year11_zeroed_terms]
    df = zero_where(df, summer, F.col("year") == 11)
    out = [rate(f"{stem}_{t}", f"sessionspossible_{t}").alias(f"{stem}_rate_{t}") for t in terms]
    return df.select("pmr", "year", *out)


def exams(tables: Tables, cfg: Config, spine: DataFrame) -> DataFrame:
    """Best exam results per pupil over the cohorts' exam years."""
    columns = {
        "pmr": "^ks4_pupilmatchingrefanonymous", "academicyear": "^ks4_acadyr", "att8": "^ks4_att8",
        "glevel2em_ptq_ee": "^ks4_glevel2em_ptq_ee", "ebacc_94": "^ks4_ebacc_94",
    }
    names = discover(tables, f"^{cfg.exam_table}")
    rows = union_family(tables, names, columns).drop("source_table")
    rows = rows.withColumn("academicyear", parse_acad_year("academicyear"))
    rows = rows.filter(academic_years(range(cfg.first_y7 + 3, cfg.last_y7 + 5)))
    rows = restrict_to(rows, spine, "pmr")
    return ever(rows, "pmr", ["att8", "glevel2em_ptq_ee", "ebacc_94"], cfg.strict_nulls)
