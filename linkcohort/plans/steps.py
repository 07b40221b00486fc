"""The steps of a study: what each reads, how it is made, and what must hold of its rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame

from linkcohort.config import Config
from linkcohort.plans import births, care, demographics, phenotypes, school, spines
from linkcohort.plans.census import CensusStep, census_step

if TYPE_CHECKING:
    from linkcohort.plans.study import Study

SPINE, FINAL = "1_cohort_spine", "2_cohort_spine_complete"
CENSUS, CODES = "census", "hospital_codes"
Family = tuple[str, "Iterable[int] | None"]


@dataclass(frozen=True)
class Step:
    """``build`` gets the study and the steps it ``reads``, by name.

    A step is made where each of its table ``families`` has a table, its codelists
    and CSV extracts are given, and the configuration wants it. ``rules`` are SQL
    conditions that its rows should meet; the report counts those that do not.
    """

    name: str
    build: Callable[[Study, Mapping[str, DataFrame]], DataFrame | None]
    families: Callable[[Config], list[Family]] = lambda c: []
    lists: tuple[str, ...] = ()
    csv: tuple[str, ...] = ()
    any_csv: tuple[str, ...] = ()  # one of them, the first that is there
    reads: tuple[str, ...] = (SPINE,)
    wanted: Callable[[Config], bool] = lambda c: True
    rules: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    part: bool = True  # of the combined dataset


def _spine(study: Study, _: Mapping[str, DataFrame]) -> DataFrame:
    tables, cfg, lists = study.tables, study.config, study.codelists
    if cfg.inception == "birth":
        return births.birth_spine(tables, cfg, lists["births"], lists["multiple_still_births"])
    if cfg.inception == "event":
        return spines.event_spine(tables, cfg, lists["inception"])
    return spines.school_spine(tables, cfg)


def _census(study: Study, done: Mapping[str, DataFrame]) -> DataFrame | None:
    return census_step(study.tables, study.config, done[SPINE])


def _from_census(make: Callable[..., DataFrame], register: bool = False):
    def build(study: Study, done: Mapping[str, DataFrame]) -> DataFrame:
        more = (study.register,) if register else ()
        return make(CensusStep(study.tables, done[CENSUS]), study.config, done[SPINE], *more)

    return build


def _from_tables(make: Callable[..., DataFrame], *lists: str):
    def build(study: Study, done: Mapping[str, DataFrame]) -> DataFrame:
        return make(study.tables, study.config, done[SPINE], *[study.codelists[n] for n in lists])

    return build


def _hospital_codes(study: Study, done: Mapping[str, DataFrame]) -> DataFrame:
    episodes = phenotypes.primary_school_episodes(study.tables, study.config, done[SPINE])
    return phenotypes.long_codes(episodes, study.codelists["emergency_admissions"])


def _phenotypes(study: Study, done: Mapping[str, DataFrame]) -> DataFrame:
    return phenotypes.phenotype_codes(done[CODES], study.config, *[study.codelists[n] for n in PHENOTYPE_LISTS])


def _social_care(study: Study, done: Mapping[str, DataFrame]) -> DataFrame:
    cin = study.csv["cin"] if "cin" in study.csv else care.current_referrals(study.csv["referrals"])
    return care.social_care(cin, study.csv["cla"], study.config, done[SPINE])


def _referral_periods(study: Study, done: Mapping[str, DataFrame]) -> DataFrame:
    return care.referral_periods(study.csv["referrals"], study.config, done[SPINE])


def _contacts(study: Study, done: Mapping[str, DataFrame]) -> DataFrame:
    return care.outpatient_contacts(study.tables, study.config, done[SPINE], referred=study.config.waiting_times)


PHENOTYPE_LISTS = ("chronic", "presentations", "presentations_medical", "emergency_admissions")
BIRTH_LISTS = ("births", "multiple_still_births")
READS_CENSUS = (SPINE, CENSUS)

STEPS: dict[str, Step] = {s.name: s for s in (
    Step(SPINE, _spine, reads=(), rules={"an id is known": "coalesce(pmr, tpid) IS NOT NULL"}, part=False),
    # harmonised and cut to the spine once; all census modules read that
    Step(CENSUS, _census, partition_by=("source_table",), part=False),
    Step("demographics_modals", _from_census(demographics.modal_demographics), reads=READS_CENSUS, rules={"month of the year": "monthofbirth BETWEEN 1 AND 12"}),
    Step("demographics_y7", _from_census(demographics.year7_demographics), reads=READS_CENSUS, rules={"decile": "idaci_decile_y7 BETWEEN 1 AND 10"}),
    Step("demographics_ever", _from_census(demographics.ever_demographics, register=True), reads=READS_CENSUS),
    Step("enrolments", _from_census(school.enrolments), reads=READS_CENSUS),
    Step(
        "exclusions", _from_tables(school.exclusions), lambda c: [(c.exclusion_tables, c.secondary_years)],
        rules={"sessions not negative": "sessions >= 0"},
    ),
    Step(
        "absence", _from_tables(school.absence), lambda c: [(c.absence_tables, c.secondary_years)],
        rules={"overall within possible": "abs_overall_rate <= 100", "parts within overall": "greatest(abs_auth_rate, abs_unauth_rate) <= abs_overall_rate"},
    ),
    Step("exams", _from_tables(school.exams), lambda c: [(f"^{c.exam_table}", None)]),
    Step("contacts", _contacts, lambda c: [(c.outpatient_tables, c.hospital_years)]),
    Step(
        "birth_records", _from_tables(births.birth_characteristics, *BIRTH_LISTS), lambda c: [(c.episode_tables, c.birth_years)], BIRTH_LISTS,
        wanted=lambda c: c.inception == "school",
    ),
    Step(
        "hospital_demographics", _from_tables(demographics.hospital_demographics), lambda c: [(c.episode_tables, c.hospital_years)],
        wanted=lambda c: c.hospital_demographics,
    ),
    # written first: chronic conditions and presentations each read it
    Step(CODES, _hospital_codes, lambda c: [(c.episode_tables, c.hospital_years)], PHENOTYPE_LISTS, part=False),
    Step("phen_codes", _phenotypes, lists=PHENOTYPE_LISTS, reads=(SPINE, CODES)),
    Step("social_care", _social_care, csv=("cla",), any_csv=("cin", "referrals")),
    Step(
        "referral_periods", _referral_periods, csv=("referrals",), part=False,
        rules={"closed after it began": "coalesce(closuredate >= referraldate, true)"},
    ),
)}
