"""Phenotypes from hospital codes: chronic conditions and stress-related presentations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.config import Config
from linkcohort.functions.dates import end_of_august, september
from linkcohort.operators import (
    join_spells, los_nights, match_codes, prefixes, repair_dates, unpack_codes, with_year7, within_window,
)
from linkcohort.plans.births import DIAG, OPERTN, episode_rows
from linkcohort.sources import Tables

# Presentation groups as listed and as reported, lowest precedence first.
PRESENTATIONS = {
    "potentially_psych": "psych",
    "internalising": "internalising",
    "externalising": "externalising",
    "thought_disorder": "thought_dis",
    "selfharm": "selfharm",
}
MEDICAL = "medical"
NOT_COUNTED = "selfharm_xz_codes"  # flag2 value ignored for externalising and self-harm
METHODS = 1_000
OUT = ["tpid", "y7_year", "code", "group", "epistart", "phen_group"]


def primary_school_episodes(tables: Tables, cfg: Config, spine: DataFrame) -> DataFrame:
    """Episodes of spells that start in a member's primary school years, with length of stay."""
    df = episode_rows(tables, cfg, cfg.hospital_years, {"admimeth": "string", "startage": "int"}, [*DIAG, *OPERTN])
    # the cohort's year 7 comes with the restriction to it, so episodes meet the spine once
    df = join_spells(repair_dates(with_year7(df, spine, "tpid")), "tpid", cfg.spell_mode)
    lo, hi = september(F.col("y7_year") - 7), end_of_august(F.col("y7_year") - 1)
    df = within_window(df, "spell_start", lo, F.date_add(hi, 1) if cfg.window_end_inclusive else hi)
    return df.withColumn("spell_los_nights", los_nights())


def long_codes(df: DataFrame, emergency: DataFrame | None = None) -> DataFrame:
    """One row per code of each episode, cut to four characters.

    With the list of emergency admission methods, episodes are marked ``urgent``
    before their codes are expanded.
    """
    ids = ["tpid", "y7_year", "epistart", "spell_start", "admimeth", "startage", "spell_los_nights"]
    if emergency is not None:
        df, ids = mark_urgent(df, emergency), [*ids, "urgent"]
    return unpack_codes(df, ids, "codes", {"diag": len(DIAG), "opertn": len(OPERTN)})


def mark_urgent(df: DataFrame, emergency: DataFrame) -> DataFrame:
    """``urgent``: whether the admission method is on the list.

    Methods are few, and a few hold nearly all rows, so dealing the rows out by
    them would be uneven: a list of up to ``METHODS`` is a condition on the rows, and
    only a longer one is joined.
    """
    methods = [r.code for r in emergency.select("code").distinct().limit(METHODS + 1).collect()]
    if len(methods) <= METHODS:
        listed = F.coalesce(F.col("admimeth").isin(methods), F.lit(False)) if methods else F.lit(False)
        # made by a generator, so that a filter on it stays here: pushed down to the extracts, it
        # would have them read, made distinct and joined again for the urgent rows alone
        return df.select("*", F.inline(F.array(F.struct(listed.alias("urgent")))))
    urgent = emergency.select(F.col("code").alias("admimeth")).distinct().withColumn("_urgent", F.lit(True))
    return df.join(urgent, "admimeth", "left").withColumn("urgent", F.coalesce("_urgent", F.lit(False))).drop("_urgent")


def chronic_conditions(long: DataFrame, codes: DataFrame, label: str = "chronic") -> DataFrame:
    """Diagnoses on the chronic-condition list, less those whose entry needs more.

    Entries flagged LOS3 count from three nights, AGE10 from ten years of age
    (ages coded in days count as 0).
    """
    hit = match_codes(long.filter(F.col("code_type") == "diag"), codes, ["flag", "group"])
    age = F.when(F.col("startage") >= 7001, 0).otherwise(F.col("startage"))
    short = (F.col("flag") == "LOS3") & (F.col("spell_los_nights") < 3)
    young = (F.col("flag") == "AGE10") & (age < 10)
    keep = ~F.coalesce(short, F.lit(False)) & ~F.coalesce(young, F.lit(False))
    return hit.filter(keep).withColumn("phen_group", F.lit(label)).select(*OUT)


def presentation_entries(codes: DataFrame, medical: DataFrame) -> DataFrame:
    """All listed codes by type and compared length, with what they stand for.

    Diagnoses are compared by their first 3 or 4 characters according to the
    entry, operations by all (at most 4) characters.
    """
    ignored = F.col("group").isin("externalising", "selfharm") & (F.col("flag2") == NOT_COUNTED)
    groups = codes.filter(~ignored & F.col("group").isin(*PRESENTATIONS)).select(
        F.lit("diag").alias("_type"), "code", F.col("group").alias("_tag")
    )
    kind = F.when(F.col("code_type") == "icd10", "diag").when(F.col("code_type") == "opcs4", "opertn")
    exempt = medical.select(kind.alias("_type"), "code", F.lit(MEDICAL).alias("_tag"))
    rows = groups.unionByName(exempt).filter(F.col("_type").isNotNull())
    rows = rows.withColumn("_k", F.when(F.col("_type") == "opertn", 4).otherwise(F.length("code")))
    return rows.groupBy("_type", "_k", "code").agg(F.collect_set("_tag").alias("_tags"))


def presentations(long: DataFrame, codes: DataFrame, medical: DataFrame, emergency: DataFrame) -> DataFrame:
    """Every diagnosis of the emergency episodes that present with one of five groups.

    Counts the first diagnosis only, any position for self-harm. The potentially
    psychosomatic group is void where the same (person, episode start) carries a
    medical or surgical code. An episode gets its highest-precedence group.

    Only rows that match a list reach the episode aggregate.
    """
    long = long if "urgent" in long.columns else mark_urgent(long, emergency)
    diag = long.filter(F.col("urgent") & (F.col("code_type") == "diag"))
    episodes = presenting_episodes(long, codes, medical)
    return diag.join(episodes, ["tpid", "epistart"]).withColumn("phen_group", F.col("group")).select(*OUT)


def presenting_episodes(long: DataFrame, codes: DataFrame, medical: DataFrame) -> DataFrame:
    """tpid, epistart, group of the episodes that present with a group; ``long`` has ``urgent``."""
    rows = long.filter(F.col("urgent") | (F.col("code_type") == "opertn"))

    # each row's compared prefixes, looked up in one join
    entries = presentation_entries(codes, medical).filter(F.col("_k").isin(3, 4)).select(F.col("_type").alias("_t"), F.col("code").alias("_c"), "_tags")
    compared = F.when(F.col("code_type") == "diag", prefixes("code", (3, 4))).otherwise(F.array(F.substring("code", 1, 4)))
    looked = rows.select("tpid", "epistart", "code_no", "code_type", F.explode(compared).alias("_prefix"))
    marked = looked.join(entries, (F.col("code_type") == F.col("_t")) & (F.col("_prefix") == F.col("_c"))).select("tpid", "epistart", "code_no", "_tags")

    def tagged(name: str) -> Column:
        return F.array_contains("_tags", name)

    first = F.col("code_no") == 1
    flags = {out: tagged(name) & (F.lit(True) if out == "selfharm" else first) for name, out in PRESENTATIONS.items()}
    episodes = marked.groupBy("tpid", "epistart").agg(
        F.bool_or(tagged(MEDICAL)).alias("_med"), *[F.bool_or(c).alias(n) for n, c in flags.items()]
    )
    episodes = episodes.withColumn("psych", F.col("psych") & ~F.col("_med"))
    group = F.lit(None).cast("string")
    for n in flags:  # later groups take precedence
        group = F.when(F.col(n), F.lit(n)).otherwise(group)
    return episodes.select("tpid", "epistart", group.alias("group")).filter(F.col("group").isNotNull())


def phenotype_codes(
    long: DataFrame, cfg: Config, chronic: DataFrame, presenting: DataFrame, medical: DataFrame, emergency: DataFrame
) -> DataFrame:
    """Long table of phenotype codes: chronic conditions and presentations together."""
    return chronic_conditions(long, chronic, cfg.chronic_label).unionByName(
        presentations(long, presenting, medical, emergency)
    )


def phenotype_episodes(
    long: DataFrame, cfg: Config, chronic: DataFrame, presenting: DataFrame, medical: DataFrame, emergency: DataFrame
) -> DataFrame:
    """tpid, epistart, phen_group of all phenotype codes, for whoever asks which groups a person has.

    An episode presents by a diagnosis of its own, so :func:`presentations` has at least
    one row of it; its diagnoses need not be expanded and joined once more to know that.
    """
    long = long if "urgent" in long.columns else mark_urgent(long, emergency)
    found = presenting_episodes(long, presenting, medical).filter("tpid IS NOT NULL AND epistart IS NOT NULL")
    own = chronic_conditions(long, chronic, cfg.chronic_label).select("tpid", "epistart", "phen_group")
    return own.unionByName(found.withColumnRenamed("group", "phen_group"))
