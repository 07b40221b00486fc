"""Everything back onto the spine: one wide, analysis-ready row per person."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkcohort.config import Config
from linkcohort.functions import any_true, count_true, month_date, september
from linkcohort.operators import attach, dcast, eligibility, exists_summary, highest
from linkcohort.plans.care import ATTENDED, attendance_summary, highest_social_care, waiting_time
from linkcohort.plans.phenotypes import PRESENTATIONS
from linkcohort.plans.school import ANNUAL_RATES

SEN_LABELS = ("Support", "S/EHCP", "Specialist provision")  # lowest first
NOT_ENROLLED_YEARS = range(8, 12)
PANEL_YEARS = range(7, 12)
ABSENCE_VALUES = [*ANNUAL_RATES, "pa10", "sessionspossible_annual"]


def sen_summary(ever_rows: DataFrame) -> DataFrame:
    """fsm_ever_primary and highest_sen_primary per pupil."""
    levels = [
        (SEN_LABELS[0], F.col("senprovision") == "support"),
        (SEN_LABELS[1], F.col("senprovision") == "sehcp"),
        (SEN_LABELS[2], F.col("specialist_school")),
    ]
    fsm = exists_summary(ever_rows, "pmr", {"fsm_ever_primary": F.col("fsm_ever_primary") == 1})
    return fsm.join(highest(ever_rows, "pmr", levels, "highest_sen_primary", "None"), "pmr")


def phenotype_summary(codes: DataFrame, cfg: Config) -> DataFrame:
    """Any code of each group, of the persons with a code between the dates.

    The dates are conditions within the aggregate: as a filter they would be pushed
    down, and the episodes read and made distinct again for them.
    """
    groups = [cfg.chronic_label, *PRESENTATIONS.values()]
    dated = F.lit(True)
    if cfg.phenotype_from is not None:
        dated &= F.col("epistart") >= F.lit(cfg.phenotype_from)
    if cfg.phenotype_to is not None:
        dated &= F.col("epistart") < F.lit(cfg.phenotype_to)
    out = exists_summary(codes, "tpid", {f"chc_{g}": (F.col("phen_group") == g) & dated for g in groups} | {"_dated": dated})
    return out.filter("_dated").drop("_dated")


def contact_summary(contacts: DataFrame, cfg: Config) -> DataFrame:
    """Any and first contact; attendance and waiting time where the configuration asks for them, of all contacts."""
    seen = F.col("attended").isin(*ATTENDED) if cfg.attended_only else F.lit(True)
    out = contacts.groupBy("tpid").agg(F.bool_or(seen).alias("ever_attended_cpc"), F.min(F.when(seen, F.col("apptdate"))).alias("date_first_cpc"))
    if cfg.attendance:
        out = out.join(attendance_summary(contacts).drop("date_first_attended"), "tpid")
    if cfg.waiting_times:
        out = out.join(waiting_time(contacts), "tpid")
    return out.withColumn("ever_attended_cpc", F.coalesce("ever_attended_cpc", F.lit(False)))


def enrolment_summary(rows: DataFrame) -> DataFrame:
    """Whether a pupil is in a spring census or alternative provision, by school year."""
    there = F.col("census").isin("Spring", "AP")
    return exists_summary(rows, "pmr", {f"_in_y{y}": there & (F.col("year") == y) for y in NOT_ENROLLED_YEARS})


def exclusion_summary(rows: DataFrame, cfg: Config) -> DataFrame:
    kinds = {n: F.col("exclusion_category").isin(list(values)) for n, values in cfg.exclusion_kinds.items()}
    return exists_summary(rows, "pmr", {f"excluded_y{y}": F.col("year") == y for y in PANEL_YEARS} | kinds)


@dataclass(frozen=True)
class Summary:
    """A module's result as the combined dataset takes it: one row per id, and what stands for an id without a row."""

    on: str
    rows: DataFrame
    fill: Mapping[str, object] = field(default_factory=dict)


def summaries(parts: Mapping[str, DataFrame], cfg: Config) -> dict[str, Summary]:
    """The parts one row per person, in the order in which they are joined."""
    conditions = [cfg.chronic_label, *PRESENTATIONS.values()]
    makers: dict[str, Callable[[DataFrame], Summary]] = {
        "birth_records": lambda df: Summary("tpid", df),
        "hospital_demographics": lambda df: Summary("tpid", df),
        "phen_codes": lambda df: Summary("tpid", phenotype_summary(df, cfg), {f"chc_{g}": False for g in conditions}),
        "contacts": lambda df: Summary("tpid", contact_summary(df, cfg), {"ever_attended_cpc": False}),
        "demographics_modals": lambda df: Summary("pmr", df),
        "demographics_y7": lambda df: Summary("pmr", df),
        "demographics_ever": lambda df: Summary("pmr", sen_summary(df), {"fsm_ever_primary": False, "highest_sen_primary": "None"}),
        "enrolments": lambda df: Summary("pmr", enrolment_summary(df), {f"_in_y{y}": False for y in NOT_ENROLLED_YEARS}),
        "exclusions": lambda df: Summary(
            "pmr", exclusion_summary(df, cfg), {f"excluded_y{y}": False for y in PANEL_YEARS} | dict.fromkeys(cfg.exclusion_kinds, False)
        ),
        "absence": lambda df: Summary("pmr", dcast(df, ["pmr"], "year", PANEL_YEARS, [*ABSENCE_VALUES, *cfg.persistent_flags])),
        "exams": lambda df: Summary("pmr", df),
        "social_care": lambda df: Summary("pmr", df, {c: False for c in ("ever_cin", "ever_cpp", "ever_cla")}),
    }
    if cfg.inception != "school":  # the spine has them
        makers.pop("birth_records")
    return {name: make(parts[name]) for name, make in makers.items() if name in parts}


def combine(spine: DataFrame, parts: Mapping[str, DataFrame], cfg: Config) -> DataFrame:
    """Join the modules' results onto the spine and derive the flags across them.

    ``parts``: demographics_modals, demographics_y7, demographics_ever,
    birth_records (school inception), hospital_demographics, phen_codes, enrolments, exclusions,
    absence, exams, contacts, social_care. A part left out leaves its columns out.
    """
    return combine_summaries(spine, summaries(parts, cfg), cfg)


def combine_summaries(spine: DataFrame, of: Mapping[str, Summary], cfg: Config) -> DataFrame:
    """Hospital-keyed summaries are joined first, then pupil-keyed ones, each set on one exchange of the spine."""
    have, out = set(of), spine
    for on in ("tpid", "pmr"):
        own = [x for x in of.values() if x.on == on]
        fill = {c: v for x in own for c, v in x.fill.items()}
        out = attach(out, on, *[x.rows for x in own], fill=fill, null_safe=cfg.compat.null_safe_links)

    derived = {}
    if "demographics_modals" in have and cfg.inception == "school":
        derived["dob_approx"] = month_date("yearofbirth", "monthofbirth")
    if "demographics_ever" in have:
        derived["ever_sen_primary"] = F.col("highest_sen_primary") != "None"
    if "phen_codes" in have:
        derived["chc_any"] = any_true([f"chc_{g}" for g in [cfg.chronic_label, *PRESENTATIONS.values()]])
    if "enrolments" in have:
        absent = {f"not_enrolled_y{y}": ~F.col(f"_in_y{y}") for y in NOT_ENROLLED_YEARS}
        derived |= absent | {
            "ever_not_enrolled": any_true(absent.values()), "not_enrolled_n_yr": count_true(absent.values()),
        }
    if "exclusions" in have:
        derived["ever_excluded"] = any_true([f"excluded_y{y}" for y in PANEL_YEARS])
    if "absence" in have:
        derived |= {f"ever_{n}": any_true([f"{n}_{y}" for y in PANEL_YEARS]) for n in ("pa10", *cfg.persistent_flags)}
    if "social_care" in have:
        derived["highest_csc"] = highest_social_care()
    out = out.withColumns(derived).drop(*[f"_in_y{y}" for y in NOT_ENROLLED_YEARS])
    if "dob_approx" in out.columns:
        other_id = "tpid" if cfg.inception == "school" else "pmr"
        out = eligibility(out, other_id, "dob_approx", september(min(cfg.birth_cohorts) - 1), september(max(cfg.birth_cohorts)))
    return out
