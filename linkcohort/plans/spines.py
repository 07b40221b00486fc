"""Spines by school year and by event: everyone seen in year 7 of a cohort's year, or with a first listed diagnosis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkcohort.config import Config
from linkcohort.functions import academic_year, dob_approx, inception_year
from linkcohort.operators import SEPARATOR, add_new_members, first_clear_event, link, match_codes, repair_dates
from linkcohort.plans.births import DIAG, episode_rows
from linkcohort.plans.census import academic_years, ap_rows, census_rows
from linkcohort.sources import Tables, census_year, open_table, year_group


def school_spine(tables: Tables, cfg: Config, bridge: DataFrame | None = None) -> DataFrame:
    """pmr, y7_year, tpid: one row per pupil in year 7, or 11 years old and ungraded.

    The year is that of the pupil's earliest such census. Pupils seen only in
    alternative provision are added, then the hospital id through the bridge.
    """
    rows = census_rows(tables, cfg, cfg.year7_cohorts, ["pmr"], year_group([7], "==", 11))
    rows = rows.filter(F.col("pmr").isNotNull()).withColumn("y7_year", census_year("source_table"))
    if cfg.compat.first_by_table:
        spine = rows.groupBy("pmr").agg(F.min_by("y7_year", "source_table").alias("y7_year"))
    else:
        spine = rows.groupBy("pmr").agg(F.min("y7_year").alias("y7_year"))
    ap = ap_rows(
        tables, cfg, ["pmr", "academicyear"],
        academic_years(cfg.year7_cohorts) & (F.col("ageatstart").try_cast("int") == 11) & F.col("pmr").isNotNull(),
    )
    if ap is not None:
        spine = add_new_members(spine, ap.withColumnRenamed("academicyear", "y7_year"), "pmr", ["y7_year"])
    bridge = open_table(tables, cfg.bridge_table) if bridge is None else bridge
    return link(spine, bridge, "pmr", "tpid", ["tpid"] if cfg.compat.link_fan_out else ["tpid", "pmr"])


def event_spine(tables: Tables, cfg: Config, codes: DataFrame, bridge: DataFrame | None = None) -> DataFrame:
    """tpid, index_date, dob_approx, academic_yob, pmr, y7_year of everyone with an index event.

    An event is the start of a hospital episode with a listed diagnosis, compared by
    3 or 4 characters; the index event is the first in [``event_from``, ``event_to``)
    without another one in the ``event_clear_days`` days before. The date of birth is
    that of the person's listed episodes, NULL where they give several or none;
    modules of school years then have nothing for the person.
    """
    rows = repair_dates(episode_rows(tables, cfg, cfg.event_years, {"mydob": "string"}, DIAG))
    rows = rows.select("tpid", F.col("epistart").alias("date"), dob_approx("mydob").alias("dob"), F.explode(F.array_distinct(F.split("codes", SEPARATOR))).alias("code"))
    hits = match_codes(rows, codes, [], lengths=(3, 4)).groupBy("tpid", "date").agg(F.min("dob").alias("least"), F.max("dob").alias("most"))
    lo, hi = (None if d is None else F.lit(d) for d in (cfg.event_from, cfg.event_to))
    index = first_clear_event(hits, "tpid", "date", cfg.event_clear_days, lo, hi)
    births = hits.groupBy("tpid").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    spine = index.join(births, "tpid").select("tpid", "index_date", F.when(F.col("least") == F.col("most"), F.col("least")).alias("dob_approx"))
    spine = spine.withColumn("academic_yob", academic_year("dob_approx"))
    bridge = open_table(tables, cfg.bridge_table) if bridge is None else bridge
    spine = link(spine, bridge, "tpid", "pmr", ["tpid"] if cfg.compat.link_fan_out else ["tpid", "pmr"])
    return spine.withColumn("y7_year", inception_year("academic_yob"))
