"""Outpatient contacts and children's social care."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkcohort.config import Config
from linkcohort.functions import parse_date, waiting_days
from linkcohort.operators import collapse_intervals, exists_summary, first_per, within_school_window
from linkcohort.sources import Tables, discover, union_family

# Outpatient attendance codes. 5 and 6 were seen (on time, late);
# 2 and 4 were cancelled; 3 and 7 did not attend.
ATTENDED = ("5", "6")
CANCELLED = ("2", "4")
NOT_ATTENDED = ("3", "7")
FIRST_APPOINTMENT = ("1", "3")  # face to face or by telephone


def outpatient_contacts(tables: Tables, cfg: Config, spine: DataFrame, referred: bool = False) -> DataFrame:
    """Distinct appointments of the chosen specialties in primary school years.

    ``referred`` adds the date of the referral request, ``reqdate``.
    """
    columns = {
        "tpid": "^token_?person_?id$", "apptdate": "^apptdate$", "firstatt": "^firstatt$",
        "attended": "^attended$", "tretspef": "^tretspef$", **({"reqdate": "^reqdate$"} if referred else {}),
    }
    names = discover(tables, cfg.outpatient_tables, cfg.hospital_years)
    rows = union_family(
        tables, names, columns, dict.fromkeys(columns, "string"), where=F.col("tretspef").isin(*cfg.specialties)
    ).drop("source_table")
    rows = rows.withColumns({c: parse_date(c) for c in ("apptdate", "reqdate") if c in columns}).distinct()
    return within_school_window(rows, spine, "tpid", "apptdate", end_inclusive=cfg.window_end_inclusive)


def attendance_summary(rows: DataFrame) -> DataFrame:
    """Per person: attended, cancelled and missed appointments, first and follow-up."""
    seen = F.col("attended").isin(*ATTENDED)
    new = F.col("firstatt").isin(*FIRST_APPOINTMENT)
    return rows.groupBy("tpid").agg(
        F.count_if(seen).alias("n_attended"),
        F.count_if(F.col("attended").isin(*CANCELLED)).alias("n_cancelled"),
        F.count_if(F.col("attended").isin(*NOT_ATTENDED)).alias("n_missed"),
        F.count_if(new).alias("n_first"),
        F.count_if(~new).alias("n_follow_up"),
        F.min(F.when(seen, F.col("apptdate"))).alias("date_first_attended"),
    )


def waiting_time(rows: DataFrame, referred: str = "reqdate") -> DataFrame:
    """Days from the referral of each person's first attended appointment to that appointment.

    Of two appointments of a day, the earlier referral counts. Someone who attended
    none has their first referral and no waiting time.
    """
    seen = F.when(F.col("attended").isin(*ATTENDED) & F.col("apptdate").isNotNull(), F.struct("apptdate", referred))
    g = rows.groupBy("tpid").agg(F.min(seen).alias("_first"), F.min(referred).alias("_any"))
    g = g.select(
        "tpid", F.when(F.col("_first").isNull(), F.col("_any")).otherwise(F.col(f"_first.{referred}")).alias(referred),
        F.col("_first.apptdate").alias("date_first_attended"),
    )
    return g.withColumn("waiting_days", waiting_days(referred, "date_first_attended"))


def latest_referrals(cin: DataFrame, keys: list[str], snapshot: str, ties: list[str]) -> DataFrame:
    """One row per referral: yearly snapshots repeat it, the last one is kept.

    Of several rows of one snapshot, the first by the columns ``ties``.
    """
    return first_per(cin, keys, [F.col(snapshot).desc(), *ties])


def current_referrals(referrals: DataFrame) -> DataFrame:
    """Yearly snapshots (pmr, referral_id, snapshot, referraldate, closuredate, need_episode, cpp) as each referral last was.

    Of several rows of one snapshot, the latest closed or still open one counts,
    then the one with more protection.
    """
    open_end = F.coalesce(F.col("closuredate"), F.lit("9999-12-31").cast("date"))
    ties = [open_end.desc(), F.col("cpp").desc(), F.col("need_episode").desc(), F.col("referraldate").asc()]
    return latest_referrals(referrals, ["pmr", "referral_id"], "snapshot", ties)


def referral_periods(referrals: DataFrame, cfg: Config, spine: DataFrame) -> DataFrame:
    """pmr, referraldate, closuredate, n_referrals: each pupil's overlapping referrals as one period, NULL where still open.

    Referrals that begin in primary school years.
    """
    rows = within_school_window(current_referrals(referrals), spine, "pmr", "referraldate", end_inclusive=cfg.window_end_inclusive)
    return collapse_intervals(rows, "pmr", "referraldate", "closuredate", count="n_referrals")


def social_care(cin: DataFrame, cla: DataFrame, cfg: Config, spine: DataFrame) -> DataFrame:
    """ever_cin, ever_cpp, ever_cla in primary school years, for pupils with any record.

    Both sources are stacked so that one aggregate settles all three flags.
    """
    both = cin.select(
        "pmr", F.col("referraldate").alias("date"), F.col("need_episode"), F.col("cpp"), F.lit(False).alias("cla")
    ).unionByName(
        cla.select(
            "pmr", F.col("date_episode_started").alias("date"), F.lit(False).alias("need_episode"),
            F.lit(False).alias("cpp"), F.lit(True).alias("cla"),
        )
    )
    rows = within_school_window(both, spine, "pmr", "date", end_inclusive=cfg.window_end_inclusive)
    return exists_summary(rows, "pmr", {"ever_cin": F.col("need_episode"), "ever_cpp": F.col("cpp"), "ever_cla": F.col("cla")})


def highest_social_care(none: str = "None"):
    """The highest of the three flags as a label; NULL if the flags are."""
    return (
        F.when(F.col("ever_cla"), "CLA").when(F.col("ever_cpp"), "CPP").when(F.col("ever_cin"), "CiN")
        .when(F.col("ever_cin").isNotNull(), none)
    )
