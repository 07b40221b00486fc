"""Pupil demographics: modal values, values at year 7, and "ever" values."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkcohort.config import HOSPITAL_ETHNICITY, IMD_DECILES, LANGUAGE_GROUPS, SEN_LEVELS, Config
from linkcohort.functions import nullify, parse_date, recode
from linkcohort.operators import ever, first_per, flag_by_lookup, modal, restrict_to
from linkcohort.functions.values import flag_by_pattern
from linkcohort.plans.census import READING_YEARS, academic_years, ap_rows, census_rows, pru_rows
from linkcohort.sources import Tables, census_term, census_year, discover, union_all, union_family, year_group

MODAL_RAW = ["pmr", "gender", "ethnicgroup", "languagegroup", "yearofbirth", "monthofbirth"]
MODALS = ["female", "ethnicgroup", "languagegroup", "yearofbirth", "monthofbirth"]
HOSPITAL_MODALS = ["hospital_female", "hospital_ethnicgroup", "hospital_imd_decile"]


def clean_demographics(df: DataFrame, cfg: Config, *also: str) -> DataFrame:
    """female 1/0, five ethnic groups, English or not; birth year and month as they are."""
    gender = nullify("gender", ["0", "9"])
    return df.select(
        "pmr",
        F.when(gender.isNotNull(), gender.isin("F", "2").cast("int")).alias("female"),
        recode("ethnicgroup", cfg.ethnic_groups, normalise=True).alias("ethnicgroup"),
        recode("languagegroup", LANGUAGE_GROUPS).alias("languagegroup"),
        "yearofbirth",
        "monthofbirth",
        *also,
    )


def modal_demographics(tables: Tables, cfg: Config, spine: DataFrame) -> DataFrame:
    """Each pupil's most frequent sex, ethnic group, language, birth year and month."""
    omit7 = cfg.compat.skip_omits_year7
    no_ethnicity = re.compile(cfg.no_ethnicity)

    def where(name: str):
        years = READING_YEARS[:-1] if omit7 and no_ethnicity.search(name) else READING_YEARS
        return years, year_group(years, "<=", 11)

    census = census_rows(
        tables, cfg, cfg.primary_years, MODAL_RAW, where,
        lambda name: ["ethnicgroup"],  # some vintages have none
    )
    ap = ap_rows(
        tables, cfg, [*(c for c in MODAL_RAW if c != "languagegroup"), "academicyear"],
        (F.col("academicyear") <= cfg.last_y7) & (F.col("ageatstart").try_cast("int") <= 11),
    )
    pru = pru_rows(
        tables, cfg, [*MODAL_RAW, "academicyear"], year_group(READING_YEARS[:-1] if omit7 else READING_YEARS, "<=", 11)
    )
    parts = [census.withColumn("_seen", F.concat(census_year("source_table"), _term_rank("source_table")))]
    parts += [p.withColumn("_seen", F.concat("academicyear", F.lit("4"))) for p in (ap, pru) if p is not None]
    rows = restrict_to(union_all([p.select(*[c for c in p.columns if c in MODAL_RAW], "_seen") for p in parts]), spine, "pmr")
    rows = clean_demographics(rows, cfg, "_seen")
    return modal(rows, "pmr", MODALS, cfg.ties, ["_seen"], cfg.seed)


def _term_rank(table: str):
    """Order of the censuses within an academic year, as text."""
    return F.element_at(F.create_map(*[F.lit(x) for x in ("autumn", "1", "spring", "2", "summer", "3")]), census_term(table))


def year7_demographics(tables: Tables, cfg: Config, spine: DataFrame) -> DataFrame:
    """Free school meals at any point of year 7, and the modal deprivation decile."""
    rows = census_rows(
        tables, cfg, cfg.year7_cohorts, ["pmr", "fsmeligible", "idaci_decile"], year_group([7], "==", 11)
    ).drop("source_table")
    ap = ap_rows(
        tables, cfg, ["pmr", "fsmeligible"],
        academic_years(cfg.year7_cohorts) & (F.col("ageatstart").try_cast("int") == 11),
    )
    if ap is not None:
        rows = union_all([rows, first_per(ap, "pmr", [F.col("fsmeligible").desc_nulls_last()])])
    rows = restrict_to(rows, spine, "pmr").distinct()
    fsm = ever(rows, "pmr", ["fsmeligible"], cfg.strict_nulls).withColumnRenamed("fsmeligible", "fsmeligible_y7")
    ties = "smallest" if cfg.ties == "last" else cfg.ties  # distinct rows of one year have no last
    decile = modal(rows, "pmr", ["idaci_decile"], ties, seed=cfg.seed)
    return fsm.join(decile.withColumnRenamed("idaci_decile", "idaci_decile_y7"), "pmr")


def ever_demographics(
    tables: Tables, cfg: Config, spine: DataFrame, register: DataFrame | None = None
) -> DataFrame:
    """Distinct (pmr, fsm_ever_primary, senprovision, specialist_school) worth keeping.

    With a school ``register`` (urn, type1, type2), census rows at a specialist
    school count as such, see :func:`flag_specialist`.
    """
    keep = ["pmr", "fsmeligible", "senprovision"]
    age_year = year_group(READING_YEARS[:-1], "<", 11)
    school = ["urn"] if register is not None else []
    parts: list[DataFrame] = [census_rows(tables, cfg, cfg.primary_years[:-1], [*keep, *school], age_year, lambda name: school)]
    ap = ap_rows(
        tables, cfg, keep,
        (F.col("academicyear") <= cfg.first_y7 - 1) & (F.col("ageatstart").try_cast("int") < 11),
    )
    pru = pru_rows(tables, cfg, keep, age_year)
    if ap is not None:
        parts.append(ap.withColumn("source_table", F.lit("AP")))
    if pru is not None:
        parts.append(pru.withColumn("source_table", F.lit("AP" if cfg.compat.pru_as_ap else "PRU")))
    rows = restrict_to(union_all(parts), spine, "pmr")
    special = F.col("source_table").isin("AP", "PRU")
    if register is not None:
        rows = flag_specialist(rows, register)
        special = special | F.col("specialist_school")
    rows = rows.select(
        "pmr",
        "fsmeligible",
        recode("senprovision", {**SEN_LEVELS}).alias("_known"),
        "senprovision",
        F.when(special, F.lit(True)).alias("specialist_school"),
    )
    # codes on neither list stay as they are, apart from "N"
    rows = rows.withColumn("senprovision", F.coalesce("_known", nullify("senprovision", ["N"]))).drop("_known")
    return ever_flags(rows, cfg.strict_nulls)


def ever_flags(rows: DataFrame, strict_nulls: bool = False) -> DataFrame:
    """Reduce pupil rows to the distinct combinations that carry a flag.

    The window runs over distinct code combinations, a handful per pupil.
    """
    rows = rows.distinct()
    w = Window.partitionBy("pmr")
    top = F.max("fsmeligible").over(w)
    if strict_nulls:
        top = F.when(F.count_if(F.col("fsmeligible").isNull()).over(w) == 0, top)
    rows = rows.withColumn("fsm_ever_primary", top)
    rows = rows.filter(
        (F.col("fsm_ever_primary") == 1) | F.col("senprovision").isNotNull() | F.col("specialist_school").isNotNull()
    )
    return rows.select("pmr", "fsm_ever_primary", "senprovision", "specialist_school").distinct()


def flag_specialist(rows: DataFrame, register: DataFrame) -> DataFrame:
    """Mark rows at a specialist school by looking their school up in the register."""
    schools = register.select(F.col("urn").cast("string").alias("urn"), "type1", "type2")
    cond = flag_by_pattern("special|alternative|pupil referral unit", "type1", "type2")
    return flag_by_lookup(rows, schools, "urn", cond, "specialist_school")


def hospital_modal_demographics(df: DataFrame, cols: Sequence[str], cfg: Config, order_by: Sequence[str] = ("epistart",)) -> DataFrame:
    """Modal sex, ethnic group or deprivation from hospital rows, per tpid."""
    return modal(df.filter(F.col("tpid").isNotNull()), "tpid", cols, cfg.ties, order_by, cfg.seed)


def hospital_demographics(tables: Tables, cfg: Config, spine: DataFrame) -> DataFrame:
    """Each member's most frequent sex, ethnic group and deprivation decile in the hospital extracts of the cohorts' primary school years.

    These are the same years' extracts for everyone, not the person's own school years. Rows that repeat the values of an episode start count once; a column that a
    year's extract lacks is missing there.
    """
    columns = {
        "tpid": "^token_?person_?id$", "epistart": "^epistart$", "sex": "^sex$", "ethnos": "^ethnos$", "imd": "^imd04_decile$",
    }
    names = discover(tables, cfg.episode_tables, cfg.hospital_years)
    optional = ["sex", "ethnos", "imd"]
    rows = union_family(tables, names, columns, dict.fromkeys(columns, "string"), optional, F.col("tpid").isNotNull())
    sex = nullify("sex", ["0", "9"])
    rows = restrict_to(rows, spine, "tpid").select(
        "tpid",
        parse_date("epistart").alias("epistart"),
        F.when(sex.isNotNull(), (sex == "2").cast("int")).alias("hospital_female"),
        recode("ethnos", HOSPITAL_ETHNICITY).alias("hospital_ethnicgroup"),
        recode("imd", IMD_DECILES).alias("hospital_imd_decile"),
    )
    return hospital_modal_demographics(rows.distinct(), HOSPITAL_MODALS, cfg)
