"""Whole studies, and files and views as their sources."""

import tempfile
import uuid
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import functions as F

from linkcohort.config import Config
from linkcohort.plans import care, demographics, school
from linkcohort.plans.combine import combine
from linkcohort.plans.compare import compare_demographics
from linkcohort.plans.study import Study
from linkcohort.sources import codelist, read_codelist, read_csv_module, shared_dir, write_table
from workload import Data, case
from workload import school as m
from workload import shape as s


def folder(d: Data) -> str:
    """A new folder in the session's shared one; in local mode, where it names none, in a temporary one."""
    local = d.spark.sparkContext.master.split("[")[0] == "local"
    return f"{shared_dir(d.spark, tempfile.mkdtemp(prefix='run-') if local else None)}/{uuid.uuid4().hex}"


FROM_CENSUS = f"""WITH {s.CENSUS}, {s.AP}, {s.PRU}, {s.BRIDGE},
seen AS (SELECT pmr, min(cy) AS y7_year FROM census WHERE cy BETWEEN 1996 AND 1998 AND (nc = '7' OR (nc = 'X' AND age = 11)) GROUP BY 1),
extra AS (SELECT pmr, CAST(min(ay) AS INTEGER) AS y7_year FROM ap WHERE ay BETWEEN 1996 AND 1998 AND age = 11 AND pmr NOT IN (SELECT pmr FROM seen) GROUP BY 1),
people AS (SELECT * FROM seen UNION ALL SELECT * FROM extra),
by_token AS (SELECT tpid, min(pmr) AS pmr FROM bridge WHERE tpid IS NOT NULL AND pmr IN (SELECT pmr FROM people) GROUP BY 1),
one AS (SELECT pmr, min(tpid) AS tpid FROM by_token GROUP BY 1),
spine AS (SELECT p.pmr, p.y7_year, one.tpid FROM people p LEFT JOIN one ON one.pmr = p.pmr)"""


@case(m.COMBINED.replace(m.SCHOOL, FROM_CENSUS))
def q_study_school(d: Data):
    """A whole run of a school cohort: spine, modules and combined dataset, each written and read back."""
    tables = {
        **s.census_tables(d), **s.exclusion_tables(d), **s.absence_tables(d), **s.exam_tables(d),
        **s.outpatient_tables(d), **s.episode_tables(d),
    }
    names = ("chronic", "presentations", "presentations_medical", "emergency_admissions")
    cin, cla = s.social_care_frames(d)
    lists = dict(zip(names, s.phenotype_lists(d)))
    return Study(d.spark, tables, lists, s.CONFIG, {"cin": cin, "cla": cla}, root=folder(d)).run()


@case(f"""
WITH {s.birth_sql(m.WINDOW)}, {s.BRIDGE},
people AS (SELECT tpid, min(dob_approx) AS dob_approx, min(gestat) AS gestat, min(birweit) AS birweit, min(matage) AS matage FROM born GROUP BY 1
  HAVING count(DISTINCT dob_approx) <= 1 AND count(DISTINCT gestat) <= 1 AND count(DISTINCT birweit) <= 1 AND count(DISTINCT matage) <= 1),
by_token AS (SELECT tpid, min(pmr) AS pmr FROM bridge WHERE tpid IN (SELECT tpid FROM people) GROUP BY 1),
one AS (SELECT pmr, min(tpid) AS tpid FROM by_token GROUP BY 1),
wide AS (SELECT p.*, CAST(year(dob_approx) + CASE WHEN month(dob_approx) >= 9 THEN 1 ELSE 0 END AS INTEGER) AS academic_yob, one.pmr,
  dob_approx >= DATE '1995-09-01' AND dob_approx < DATE '1998-09-01' AS born_in_year FROM people p LEFT JOIN one ON one.tpid = p.tpid)
SELECT *, academic_yob + 12 AS y7_year, pmr IS NOT NULL AND born_in_year AS eligible FROM wide
""")
def q_study_birth(d: Data):
    """A whole run of a birth cohort; modules without tables are skipped."""
    lists = dict(zip(("births", "multiple_still_births"), s.birth_lists(d)))
    return Study(d.spark, s.birth_tables(d), lists, s.BIRTH_CONFIG, root=folder(d)).run()


def few_tables(d: Data) -> dict:
    """What a school study without hospital data has."""
    return {**s.census_tables(d), **s.exclusion_tables(d), **s.absence_tables(d), **s.exam_tables(d)}


# The combined dataset without hospital data, social care and, where it was forgotten, absence.
_FEW = m.COMBINED.replace(m.SCHOOL, FROM_CENSUS)
_HOSPITAL_COLUMNS = "c LIKE 'chc%' OR c LIKE '%cpc' OR c LIKE 'ever_c__' OR c = 'highest_csc'"
_ABSENCE_COLUMNS = "c LIKE 'abs%' OR c LIKE '%pa10%' OR c LIKE 'sessions%'"
FEW_SQL = f"SELECT COLUMNS(lambda c: NOT ({_HOSPITAL_COLUMNS})) FROM ({_FEW})"


@case(f"SELECT COLUMNS(lambda c: NOT ({_HOSPITAL_COLUMNS} OR {_ABSENCE_COLUMNS})) FROM ({_FEW})")
def q_study_blocks(d: Data):
    """Blocks called one by one, by three runs in one folder: the last goes on after a module was forgotten."""
    root, tables = folder(d), few_tables(d)

    def study() -> Study:
        return Study(d.spark, tables, {}, s.CONFIG, root=root, name="blocks")

    study().run_modules(only=["exams", "absence"])
    second = study()
    second.run_modules()
    second.run_combine()
    second.forget("absence")
    return study().run_combine()


@case(FEW_SQL)
def q_study_by_person(d: Data):
    """Modules' results laid out by person, joined without a shuffle, read by another run."""
    root, tables = folder(d), few_tables(d)
    Study(d.spark, tables, {}, s.CONFIG, root=root, name="laid_out", buckets=8).run()
    return Study(d.spark, tables, {}, s.CONFIG, root=root, name="laid_out", buckets=8).run()


@case(f"""
WITH {FROM_CENSUS.removeprefix("WITH ")}, {s.EXCLUSIONS}, {s.ABSENCE_SQL}, {s.EXAMS},
wide AS ({FEW_SQL})
SELECT '1_cohort_spine' AS step, 'rows' AS measure, '' AS item, count(*) AS n FROM spine
UNION ALL SELECT '1_cohort_spine', 'linked', '', count(*) FROM spine WHERE tpid IS NOT NULL
UNION ALL SELECT '1_cohort_spine', 'missing', 'tpid', count(*) FROM spine WHERE tpid IS NULL
UNION ALL SELECT 'exclusions', 'rows', '', count(*) FROM excl
UNION ALL SELECT 'exclusions', 'broken', 'sessions not negative', count(*) FILTER (WHERE sessions < 0) FROM excl
UNION ALL SELECT 'absence', 'rows', '', count(*) FROM absence
UNION ALL SELECT 'absence', 'broken', 'overall within possible', count(*) FILTER (WHERE abs_overall_rate > 100) FROM absence
UNION ALL SELECT 'absence', 'broken', 'parts within overall', count(*) FILTER (WHERE greatest(abs_auth_rate, abs_unauth_rate) > abs_overall_rate) FROM absence
UNION ALL SELECT 'exams', 'missing', 'ebacc_94', count(*) FILTER (WHERE ebacc_94 IS NULL) FROM exams
UNION ALL SELECT '2_cohort_spine_complete', 'rows', '', count(*) FROM wide
UNION ALL SELECT '2_cohort_spine_complete', 'missing', 'att8', count(*) FILTER (WHERE att8 IS NULL) FROM wide
UNION ALL SELECT '2_cohort_spine_complete', 'missing', 'abs_overall_rate_9', count(*) FILTER (WHERE abs_overall_rate_9 IS NULL) FROM wide
""")
def q_study_report(d: Data):
    """What was counted while the steps of a run were written."""
    study = Study(d.spark, few_tables(d), {}, s.CONFIG, root=folder(d))
    study.run()
    of_step = {
        "1_cohort_spine": ["rows", "linked", "tpid"], "exclusions": ["rows", "sessions not negative"],
        "absence": ["rows", "overall within possible", "parts within overall"], "exams": ["ebacc_94"], "2_cohort_spine_complete": ["rows", "att8", "abs_overall_rate_9"],
    }
    shown = [(F.col("step") == step) & (F.when(F.col("item") == "", F.col("measure")).otherwise(F.col("item"))).isin(names) for step, names in of_step.items()]
    return study.report().filter(reduce(lambda a, b: a | b, shown))


EVENT_CONFIG = Config(birth_cohorts=(1996, 1997, 1998), inception="event", event_from=date(1996, 1, 1), event_to=date(1998, 1, 1), event_clear_days=200)


@case(f"""
WITH raw AS (SELECT *, 'T' || l_partkey AS tpid FROM lineitem WHERE year(l_shipdate) BETWEEN 1995 AND 1998), {s._dates_sql('CAST(l_shipdate AS DATE)')}, {s.BRIDGE},
hits AS (SELECT tpid, epistart AS day,
    make_date(1995 + l_partkey % 4, 1 + l_partkey % 12 + CASE WHEN l_orderkey % 53 = 0 AND l_partkey % 12 < 11 THEN 1 ELSE 0 END, 15) AS dob
  FROM fixed WHERE {s.pick_sql(s.BIRTH_CODES, 'l_orderkey')} IN ('J450', 'P071')),
days AS (SELECT DISTINCT tpid, day FROM hits), seen AS (SELECT *, lag(day) OVER (PARTITION BY tpid ORDER BY day) AS before FROM days),
idx AS (SELECT tpid, min(day) AS index_date FROM seen WHERE day >= DATE '1996-01-01' AND day < DATE '1998-01-01' AND (before IS NULL OR day - before > 200) GROUP BY 1),
born AS (SELECT tpid, CASE WHEN min(dob) = max(dob) THEN min(dob) END AS dob_approx FROM hits GROUP BY 1),
by_token AS (SELECT tpid, min(pmr) AS pmr FROM bridge WHERE tpid IN (SELECT tpid FROM idx) GROUP BY 1),
one AS (SELECT pmr, min(tpid) AS tpid FROM by_token GROUP BY 1),
wide AS (SELECT i.tpid, i.index_date, b.dob_approx, CAST(year(dob_approx) + CASE WHEN month(dob_approx) >= 9 THEN 1 ELSE 0 END AS INTEGER) AS academic_yob, one.pmr,
  dob_approx >= DATE '1995-09-01' AND dob_approx < DATE '1998-09-01' AS born_in_year FROM idx i JOIN born b ON b.tpid = i.tpid LEFT JOIN one ON one.tpid = i.tpid)
SELECT *, academic_yob + 12 AS y7_year, pmr IS NOT NULL AND born_in_year AS eligible FROM wide
""")
def q_study_event(d: Data):
    """A whole run of a cohort that begins with a first diagnosis after 200 days without one."""
    inception = codelist(d.spark, [("J45",), ("P07.1",), ("J45.0",)], ["code"])
    return Study(d.spark, s.birth_tables(d), {"inception": inception}, EVENT_CONFIG, root=folder(d)).run()


_REFERRALS = f"""latest AS (SELECT 'P' || o_custkey AS pmr, CAST(o_orderdate AS DATE) - {s.SHIFT} AS opened,
  CASE WHEN o_orderkey % 19 > 0 THEN CAST(o_orderdate AS DATE) - {s.SHIFT} + CAST(o_orderkey % 300 AS INTEGER) + CASE WHEN o_orderkey % 3 = 0 THEN 30 ELSE 0 END END AS closed,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus = 'F' ELSE FALSE END AS cin, o_orderkey % 3 = 0 AND o_orderpriority = '1-URGENT' AS cpp FROM orders)"""


def referrals(d: Data):
    """Each referral in one yearly snapshot, or in two, of which the second says more."""
    opened, key = F.date_sub(F.col("o_orderdate").cast("date"), s.SHIFT), F.col("o_orderkey")
    later = d.orders.withColumn("again", F.explode(F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    second = F.col("again") == 1
    return later.select(
        F.concat(F.lit("P"), F.col("o_custkey")).alias("pmr"), key.alias("referral_id"), (F.year("o_orderdate") + F.col("again")).alias("snapshot"), opened.alias("referraldate"),
        F.when(key % 19 > 0, F.date_add(opened, (key % 300 + F.col("again") * 30).cast("int"))).alias("closuredate"),
        (second & (F.col("o_orderstatus") == "F")).alias("need_episode"), (second & (F.col("o_orderpriority") == "1-URGENT")).alias("cpp"),
    )


@case(f"""
{FROM_CENSUS}, {_REFERRALS},
care_rows AS (SELECT pmr, opened AS day, cin, cpp, FALSE AS cla FROM latest
  UNION ALL SELECT 'P' || l_partkey, CAST(l_shipdate AS DATE) - {s.SHIFT}, FALSE, FALSE, TRUE FROM lineitem),
care AS (SELECT s.pmr, bool_or(cin) AS ever_cin, bool_or(cpp) AS ever_cpp, bool_or(cla) AS ever_cla FROM care_rows r JOIN spine s ON s.pmr = r.pmr
  WHERE day >= make_date(CAST(s.y7_year AS BIGINT) - 7, 9, 1) AND day < make_date(CAST(s.y7_year AS BIGINT) - 1, 8, 31) GROUP BY 1)
SELECT sp.pmr, sp.y7_year, sp.tpid, {', '.join(f"coalesce({c}, FALSE) AS {c}" for c in ("ever_cin", "ever_cpp", "ever_cla"))},
  CASE WHEN ever_cla THEN 'CLA' WHEN ever_cpp THEN 'CPP' WHEN ever_cin THEN 'CiN' ELSE 'None' END AS highest_csc
FROM spine sp LEFT JOIN care ON care.pmr = sp.pmr
""")
def q_study_referrals(d: Data):
    """A study that is given the raw snapshots of referrals; its other modules are left out."""
    _, cla = s.social_care_frames(d)
    study = Study(d.spark, s.census_tables(d), {}, s.CONFIG, {"referrals": referrals(d), "cla": cla}, root=folder(d))
    return study.run(skip=["demographics_modals", "demographics_y7", "demographics_ever", "enrolments"])


@case(f"""
WITH {s.SPINE}, {_REFERRALS},
own AS (SELECT s.pmr, opened, greatest(coalesce(closed, DATE '9999-12-31'), opened) AS til FROM latest l JOIN spine s ON s.pmr = l.pmr
  WHERE opened >= make_date(CAST(s.y7_year AS BIGINT) - 7, 9, 1) AND opened < make_date(CAST(s.y7_year AS BIGINT) - 1, 8, 31)),
w AS (SELECT *, CASE WHEN opened <= max(til) OVER (PARTITION BY pmr ORDER BY opened, til ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM own),
p AS (SELECT *, sum(opens) OVER (PARTITION BY pmr ORDER BY opened, til ROWS UNBOUNDED PRECEDING) AS k FROM w)
SELECT pmr, min(opened) AS referraldate, nullif(max(til), DATE '9999-12-31') AS closuredate, count(*) AS n_referrals FROM p GROUP BY pmr, k
""")
def q_referral_periods(d: Data):
    return care.referral_periods(referrals(d), s.CONFIG, s.spine(d))


@case(f"""
WITH {s.SPINE}, {s.CONTACTS}, t AS (SELECT tpid, bool_or(attended IN ('5', '6')) AS seen, min(apptdate) FILTER (WHERE attended IN ('5', '6')) AS first_seen,
    count(*) FILTER (WHERE attended IN ('5', '6')) AS n_attended, count(*) FILTER (WHERE attended IN ('2', '4')) AS n_cancelled,
    count(*) FILTER (WHERE attended IN ('3', '7')) AS n_missed, count(*) FILTER (WHERE firstatt IN ('1', '3')) AS n_first, count(*) FILTER (WHERE firstatt NOT IN ('1', '3')) AS n_follow_up,
    min(apptdate - CAST(substr(tpid, 2) AS INTEGER) % 40) AS any_request, min(apptdate) FILTER (WHERE attended IN ('5', '6')) - CAST(substr(tpid, 2) AS INTEGER) % 40 AS request
  FROM contacts GROUP BY tpid)
SELECT sp.pmr, sp.y7_year, sp.tpid, CASE WHEN sp.tpid IS NOT NULL THEN coalesce(seen, FALSE) END AS ever_attended_cpc, first_seen AS date_first_cpc,
  n_attended, n_cancelled, n_missed, n_first, n_follow_up, CASE WHEN seen THEN request ELSE any_request END AS reqdate, first_seen AS date_first_attended,
  CAST(first_seen - request AS INTEGER) AS waiting_days
FROM spine sp LEFT JOIN t ON t.tpid = sp.tpid
""")
def q_combine_contacts(d: Data):
    """Attendance and waiting times of contacts in the combined dataset."""
    wait = F.substring(F.col("TOKEN_PERSON_ID"), 2, 20).cast("int") % 40
    tables = {n: df.withColumn("REQDATE", F.date_sub(F.col("APPTDATE").cast("date"), wait).cast("string")) for n, df in s.outpatient_tables(d).items()}
    cfg, spine = replace(s.CONFIG, attendance=True, waiting_times=True, attended_only=True), s.spine(d)
    return combine(spine, {"contacts": care.outpatient_contacts(tables, cfg, spine, referred=True)}, cfg)


@case(f"""
WITH {s.SPINE}, {s.CENSUS}, {s.AP}, {s.PRU}, {m.MODALS}, {m.HOSPITAL_MODAL},
b AS (SELECT CAST(md.female AS VARCHAR) AS f1, CAST(ho.hospital_female AS VARCHAR) AS f2, md.ethnicgroup AS e1, ho.hospital_ethnicgroup AS e2
  FROM spine sp JOIN modals md ON md.pmr = sp.pmr JOIN hospital ho ON ho.tpid = sp.tpid)
SELECT 'female' AS variable, f1 AS value_a, f2 AS value_b, count(*) AS n FROM b GROUP BY 1, 2, 3
UNION ALL SELECT 'ethnicgroup', e1, e2, count(*) FROM b GROUP BY 1, 2, 3
""")
def q_compare_demographics(d: Data):
    """Sex and ethnic group in both sources."""
    spine = s.spine(d)
    school_side = demographics.modal_demographics(s.census_tables(d), s.CONFIG, spine)
    return compare_demographics(spine, school_side, demographics.hospital_demographics(s.episode_tables(d), s.CONFIG, spine))


@case("""SELECT 'B' || p_partkey AS code, p_type AS "group", CASE WHEN p_size > 25 THEN 'x' ELSE '' END AS flag FROM part""")
def q_codelist_file(d: Data):
    path = folder(d)
    rows = d.part.select(F.concat(F.lit("B."), "p_partkey").alias("Code"), F.col("p_type").alias("Group"), F.when(F.col("p_size") > 25, "x").alias("Flag"))
    write_table(rows, path, "csv")
    return read_codelist(d.spark, path)


@case("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus = 'F' AS finished, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders")
def q_csv_module(d: Data):
    path = folder(d)
    rows = d.orders.select(
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("O_ORDERPRIORITY"), (F.col("o_orderstatus") == "F").alias("Finished"), "o_custkey",
        F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderkey",
    )
    write_table(rows, path, "csv", "gzip")
    return read_csv_module(d.spark, path, "o_orderkey long, o_orderdate date, finished boolean, o_orderpriority string")


FORMATS = [("parquet", "gzip"), ("parquet", "none"), ("orc", None), ("json", None), ("csv", "gzip")]


@case(" UNION ALL ".join(f"SELECT '{f}-{c}' AS written, o_orderkey, o_orderstatus FROM orders" for f, c in FORMATS))
def q_saved_formats(d: Data):
    rows, out = d.orders.select("o_orderkey", "o_orderstatus"), []
    for fmt, compression in FORMATS:
        write_table(rows, path := folder(d), fmt, compression)
        reader = d.spark.read.schema("o_orderkey long, o_orderstatus string").option("header", True)
        out.append(reader.format(fmt).load(path).select(F.lit(f"{fmt}-{compression}").alias("written"), "o_orderkey", "o_orderstatus"))
    both = out[0]
    for df in out[1:]:
        both = both.unionByName(df)
    return both


@case(f"WITH {s.SPINE}, {s.EXCLUSIONS} SELECT * FROM excl")
def q_exclusions_views(d: Data):
    """The family found among the session's views."""
    tables = s.exclusion_tables(d)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        return school.exclusions(d.spark, s.CONFIG, s.spine(d))
    finally:
        for name in tables:
            d.spark.catalog.dropTempView(name)
