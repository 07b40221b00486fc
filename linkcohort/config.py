"""What a study sets: cohorts, table families, value lists, and policies."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, timedelta

# Raw ethnic group spellings and codes, by major group. Anything
# else, including the explicit "missing" codes, has no group.
ETHNIC_GROUPS: dict[str, list[str]] = {
    "white": [
        "any other white background", "british (white)", "irish (white)", "white", "irish", "whit",
        "white british", "wbri", "wiri", "woth",
    ],
    "black": [
        "african (black or black british)", "any other black background",
        "carribean (black or black british)", "black - african", "black - carribean", "black - other",
        "african", "blac", "caribbean", "bafr", "bcrb", "both",
    ],
    "mixed": [
        "any other mixed background", "white and asian (mixed)", "white and black african (mixed)",
        "white and black carribean (mixed)", "mixd", "white and asian", "white and black african",
        "white and black caribbean", "moth", "mwas", "mwba", "mwbc",
    ],
    "asian": [
        "any other asian background", "bangladeshi (asian or asian british)",
        "indian (asian or asian british)", "pakistani (asian or asian british)", "bangladeshi", "indian",
        "pakistani", "asia", "aban", "aind", "aoth", "apkn",
    ],
    "other": [
        "any other ethnic group", "chinese (other ethnic group)", "chinese", "aoeg", "chin",
        "gypsy / romany", "traveller of irish heritage", "chne", "ooth", "wirt", "wrom",
    ],
}

# Ethnic categories of hospital records, letters of the present coding and digits of the one before.
HOSPITAL_ETHNICITY: dict[str, list[str]] = {
    "white": ["A", "B", "C", "0"],
    "black": ["M", "N", "P", "1", "2", "3"],
    "mixed": ["D", "E", "F", "G"],
    "asian": ["H", "J", "K", "L", "4", "5", "6"],
    "other": ["R", "S", "7", "8"],
}

# First-language codes.
LANGUAGE_GROUPS = {"English": ["1_ENG", "ENG", "ENB"], "Not English": ["2_OTH", "OTH", "OTB"]}

# Special educational needs provision codes ("N" means none).
SEN_LEVELS = {"support": ["A", "P", "K"], "sehcp": ["E", "e", "S"]}

# Small-area deprivation labels, decile 1 the most deprived.
IMD_DECILES = {
    1: ["Most deprived 10%"],
    2: ["More deprived 10-20%"],
    3: ["More deprived 20-30%"],
    4: ["More deprived 30-40%"],
    5: ["More deprived 40-50%"],
    6: ["Less deprived 40-50%"],
    7: ["Less deprived 30-40%"],
    8: ["Less deprived 20-30%"],
    9: ["Less deprived 10-20%"],
    10: ["Least deprived 10%"],
}

# Hospital codes that mark a birth episode or exclude one.
BIRTH_STARTAGE = (7001, 7002)  # under 1 day; 1 to 6 days
BIRTH_EPITYPE = (3, 6)
BIRTH_CLASSPAT = 5
BIRTH_ADMIMETH = ("82", "83", "2C")
BIRTH_NEOCARE = (0, 1, 2, 3)
STILLBORN_DISMETH = 5
STILLBORN_BIRSTAT = (2, 3, 4)

# Outpatient specialties counted as pain services.
PAIN_SPECIALTIES = ("191", "241")

# Regexes that find a canonical column among lower-cased names.
CENSUS_COLUMNS: dict[str, str] = {
    "pmr": "pupilmatchingrefanonymous",
    "ageatstart": "^ageatstartofacademicyear",
    "ncyearactual": "ncyearactual",
    "academicyear": "^academicyear",
    "gender": "gender",
    "ethnicgroup": "ethnicgroup",
    "languagegroup": "languagegroup|firstlanguage",
    "yearofbirth": "yearofbirth",
    "monthofbirth": "monthofbirth",
    "fsmeligible": "fsmeligible",
    "idaci_decile": "idaci_",
    "senprovision": "senprovision_",
    "urn": "^urn",
}
AP_COLUMNS: dict[str, str] = {
    "pmr": "^ap_pupilmatchingrefanonymous",
    "academicyear": "^ap_acadyr",
    "ageatstart": "^ap_age_start",
    "gender": "^ap_gender",
    "ethnicgroup": "^ap_ethnicgroup",
    "yearofbirth": "^ap_yearofbirth",
    "monthofbirth": "^ap_monthofbirth",
    "fsmeligible": "^ap_fsmeligible",
    "senprovision": "^ap_senprovision",
}
PRU_COLUMNS: dict[str, str] = {
    "pmr": "^pru_pupilmatchingrefanonymous",
    "academicyear": "^pru_academicyear",
    "ncyearactual": "^pru_ncyearactual",
    "ageatstart": "^pru_ageatstart",
    "gender": "^pru_gender",
    "ethnicgroup": "^pru_ethnicgroup",
    "languagegroup": "^pru_languagegroup",
    "yearofbirth": "^pru_yearofbirth",
    "monthofbirth": "^pru_monthofbirth",
    "fsmeligible": "^pru_fsmeligible",
    "senprovision": "^pru_senprovision",
}
CENSUS_TYPES: dict[str, str] = {
    "pmr": "string", "ageatstart": "string", "ncyearactual": "string", "academicyear": "string",
    "gender": "string", "ethnicgroup": "string", "languagegroup": "string", "yearofbirth": "int",
    "monthofbirth": "int", "fsmeligible": "int", "idaci_decile": "int", "senprovision": "string",
    "urn": "string",
}
ABSENCE_STEMS: dict[str, str] = {
    "sessionspossible": "sessionspossible",
    "authorised": "^authorisedabsence",
    "unauthorised": "^unauthorisedabsence",
    "overall": "^overallabsence",
    "illness": "termlyreasoni",
    "appts": "termlyreasonm",
}
ABSENCE_TERMS: dict[str, str] = {"aut": "_autumn", "spr": "_spring", "sum": "_summer(_|$)", "sum6": "_summer6th"}


@dataclass(frozen=True)
class Compat:
    """Literal behaviours of the original scripts that default to a sounder form."""

    birth_window_or: bool = False       # birth window keeps rows meeting either bound
    skip_omits_year7: bool = False      # vintages without ethnicity, and referral units, leave out year 7
    pru_as_ap: bool = False             # referral-unit rows carry the alternative-provision label
    keep_first_on_conflict: bool = False  # maternal age and deprivation keep the first value
    link_fan_out: bool = False          # several hospital ids per pupil give several spine rows
    first_by_table: bool = False        # first record by table name rather than by year
    null_safe_links: bool = False       # a missing id matches a missing id


ALL_COMPAT = Compat(*[True] * 7)


@dataclass(frozen=True)
class Config:
    birth_cohorts: tuple[int, ...] = (2003, 2004, 2005)
    inception: str = "school"  # or "birth", or "event": the first hospital episode with a listed diagnosis
    event_from: date | None = None  # index events lie in [from, to)
    event_to: date | None = None
    event_clear_days: int = 365  # with no such event in so many days before

    census_tables: str = "Autumn|Spring|Summer"
    census_exclude: str = "Schools|Disability"
    no_ethnicity: str = r"Autumn_Census_201[2-7]|Summer_Census_201[1-7]"
    ap_table: str = "AP_Census"
    pru_table: str = "PRU_Census"
    bridge_table: str = "bridging"
    episode_tables: str = "APC"
    outpatient_tables: str = "^(HES_)?OP_"
    exclusion_tables: str = "Exclusions"
    absence_tables: str = "Absence"
    exam_table: str = "KS4Pupil"

    ties: str = "smallest"
    seed: int = 0
    strict_nulls: bool = False
    spell_mode: str = "merge"
    max_sessions: int = 420
    persistent_at: float = 10.0
    year11_zeroed_terms: tuple[str, ...] = ("sum", "sum6")
    window_end_inclusive: bool = False
    specialties: tuple[str, ...] = PAIN_SPECIALTIES
    chronic_label: str = "chronic"
    hospital_demographics: bool = False  # sex, ethnic group and deprivation from hospital episodes as well
    attended_only: bool = False  # contacts that took place
    attendance: bool = False  # numbers of attended, cancelled and missed contacts as well
    waiting_times: bool = False  # days from referral to the first attended contact as well; extracts need reqdate
    phenotype_from: date | None = None  # condition flags count codes of episodes that start in [from, to)
    phenotype_to: date | None = None
    exclusion_kinds: Mapping[str, tuple[str, ...]] = field(default_factory=dict)  # further flag: its categories
    persistent_flags: Mapping[str, str] = field(default_factory=dict)  # further persistent-absence flag: its rate
    ethnic_groups: Mapping[str, list[str]] = field(default_factory=lambda: ETHNIC_GROUPS)
    compat: Compat = Compat()

    @property
    def year7_cohorts(self) -> tuple[int, ...]:
        return tuple(y + 12 for y in self.birth_cohorts)

    @property
    def first_y7(self) -> int:
        return min(self.year7_cohorts)

    @property
    def last_y7(self) -> int:
        return max(self.year7_cohorts)

    @property
    def primary_years(self) -> range:
        """Census years from reception to year 7 of any cohort."""
        return range(self.first_y7 - 7, self.last_y7 + 1)

    @property
    def hospital_years(self) -> range:
        """Financial years that cover every cohort's primary school years."""
        return range(self.first_y7 - 7, self.last_y7)

    @property
    def birth_years(self) -> range:
        return range(min(self.birth_cohorts) - 1, max(self.birth_cohorts) + 1)

    @property
    def event_years(self) -> range | None:
        """Financial years that hold the index events and the days looked back over; all, if either end is open."""
        if self.event_from is None or self.event_to is None:
            return None
        first = self.event_from - timedelta(days=self.event_clear_days)
        return range(first.year - (first.month < 4), self.event_to.year + 1)

    @property
    def secondary_years(self) -> range:
        """Academic years from year 7 of the first cohort to year 11 of the last."""
        return range(self.first_y7, self.last_y7 + 5)
