"""Birth episodes, the characteristics recorded at birth, and the birth-inception spine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.config import (
    BIRTH_ADMIMETH, BIRTH_CLASSPAT, BIRTH_EPITYPE, BIRTH_NEOCARE, BIRTH_STARTAGE, IMD_DECILES,
    STILLBORN_BIRSTAT, STILLBORN_DISMETH, Config,
)
from linkcohort.functions import (
    academic_year, any_true, dob_approx, inception_year, nullify, nullify_outside, parse_date, recode, september,
)
from linkcohort.operators import any_codes, link, pack_codes, repair_dates, resolve, with_year7, within_window
from linkcohort.sources import Tables, discover, numbered, open_table, union_family

DIAG = numbered("diag", 20)
OPERTN = numbered("opertn", 24)

EPISODE_DATES = ["epistart", "epiend", "admidate", "disdate"]
BIRTH_FIELDS = {
    "epikey": "string", "startage": "int", "epitype": "int", "classpat": "int", "neocare": "int",
    "hrgnhs": "string", "admimeth": "string", "numbaby": "int", "dismeth": "int", "birstat_1": "int",
    "matage": "int", "birordr_1": "int", "gestat_1": "int", "birweit_1": "int",
}


def episode_rows(tables: Tables, cfg: Config, years, fields: dict[str, str], codes: Sequence[str]) -> DataFrame:
    """Hospital episodes of the given financial years, their codes packed into ``codes``.

    Rows without a person are dropped.
    """
    types = {"tpid": "string", **{d: "string" for d in EPISODE_DATES}, **fields, **{c: "string" for c in codes}}
    columns = {c: f"^{c}$" for c in types} | {"tpid": "^token_?person_?id$"}
    names = discover(tables, cfg.episode_tables, years)
    rows = union_family(tables, names, columns, types, where=F.col("tpid").isNotNull())
    return rows.select("tpid", *EPISODE_DATES, *fields, pack_codes(codes).alias("codes"))


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def mark_births(df: DataFrame, births: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Episodes with any birth marker, and what speaks against a live singleton birth.

    ``barred``: a stillbirth, termination or multiple-birth code, which excludes
    the person; ``single``: no administrative marker of the same, which would
    exclude the episode alone.
    """
    df = df.filter(F.col("startage").isin(*BIRTH_STARTAGE))
    listed = exclusions.filter((F.col("field") == "diag") & ((F.col("group") == "stillbirth") | (F.length("code") == 4)))
    lists = {"_birth": (births.filter(F.col("field") == "diag"), (3,)), "barred": (listed, (3, 4))}
    df = any_codes(df, "codes", lists, ["tpid", "epikey"])
    hrg = births.filter(F.col("field") == "hrg").select(F.col("code").alias("hrgnhs")).distinct()
    df = df.join(hrg.withColumn("_hrg", F.lit(True)), "hrgnhs", "left")
    markers = [
        F.col("_birth"),
        F.col("_hrg"),
        F.col("epitype").isin(*BIRTH_EPITYPE),
        F.col("classpat") == BIRTH_CLASSPAT,
        F.col("admimeth").isin(*BIRTH_ADMIMETH),
        F.col("neocare").isin(*BIRTH_NEOCARE),
    ]
    df = df.filter(any_true([_flag(m) for m in markers])).drop("_birth", "_hrg")
    not_single = [
        F.col("birordr_1") > 1,
        F.col("dismeth") == STILLBORN_DISMETH,
        F.col("birstat_1").isin(*STILLBORN_BIRSTAT),
        F.col("numbaby") > 1,
    ]
    return df.withColumn("single", ~any_true([_flag(m) for m in not_single]))


def birth_episodes(df: DataFrame, births: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Episodes that record a live singleton birth.

    To reduce them to one row per person, aggregate :func:`mark_births` instead,
    which needs no second look at the people excluded.
    """
    marked = mark_births(df, births, exclusions)
    barred = marked.filter("barred").select("tpid")
    return marked.filter("single").join(barred, "tpid", "left_anti").drop("barred", "single")


def plausible(df: DataFrame) -> DataFrame:
    """Gestation, birth weight and mother's age, NULL where unknown or implausible."""
    return df.withColumns({
        "gestat": nullify_outside(nullify("gestat_1", [99]), 22, 45),
        "birweit": nullify_outside(nullify("birweit_1", [9999]), 200),
        "matage": nullify_outside("matage", 10, 60),
    })


def birth_characteristics(
    tables: Tables, cfg: Config, spine: DataFrame, births: DataFrame, exclusions: DataFrame
) -> DataFrame:
    """tpid, gestat, birweit, matage, imd_decile of spine members, one row each."""
    fields = {**BIRTH_FIELDS, "imd04_decile": "string"}
    df = episode_rows(tables, cfg, cfg.birth_years, fields, DIAG)
    df = with_year7(df, spine, "tpid")
    lo, hi = september(F.col("y7_year") - 13), september(F.col("y7_year") - 12)
    df = within_window(df, parse_date("epistart"), lo, hi, "or" if cfg.compat.birth_window_or else "and")
    df = plausible(mark_births(repair_dates(df), births, exclusions))
    df = df.withColumn("imd_decile", recode("imd04_decile", IMD_DECILES))
    cols = ["gestat", "birweit", "matage", "imd_decile"]
    policy = dict.fromkeys(cols, "null")
    if cfg.compat.keep_first_on_conflict:
        policy |= {"matage": "first", "imd_decile": "first"}
    return resolve(df, "tpid", cols, policy, ["epistart", "epikey"], F.col("single"), F.col("barred"))


def birth_spine(
    tables: Tables, cfg: Config, births: DataFrame, exclusions: DataFrame, bridge: DataFrame | None = None
) -> DataFrame:
    """Spine of everyone born in the cohort window, with their pupil id if linked.

    People whose birth records contradict one another are dropped.
    """
    df = episode_rows(tables, cfg, cfg.birth_years, {**BIRTH_FIELDS, "mydob": "string"}, DIAG)
    lo, hi = september(min(cfg.birth_cohorts) - 1), september(max(cfg.birth_cohorts))
    df = within_window(df, parse_date("epistart"), lo, hi)
    df = plausible(mark_births(repair_dates(df), births, exclusions))
    df = df.withColumn("dob_approx", dob_approx("mydob"))
    cols = ["dob_approx", "gestat", "birweit", "matage"]
    spine = resolve(df, "tpid", cols, "drop", where=F.col("single"), unless=F.col("barred"))
    spine = spine.withColumn("academic_yob", academic_year("dob_approx"))
    bridge = open_table(tables, cfg.bridge_table) if bridge is None else bridge
    unique = ["tpid"] if cfg.compat.link_fan_out else ["tpid", "pmr"]
    spine = link(spine, bridge, "tpid", "pmr", unique)
    return spine.withColumn("y7_year", inception_year("academic_yob"))
