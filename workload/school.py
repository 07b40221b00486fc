"""The study modules on the given tables in school and hospital shape."""

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from linkcohort.config import ETHNIC_GROUPS
from linkcohort.operators import exists_summary, flags_by_group
from linkcohort.plans import births, care, demographics, phenotypes, school, spines
from linkcohort.plans.census import census_rows
from linkcohort.plans.combine import combine
from linkcohort.sources import census_term, census_year, year_group
from workload import Data, case
from workload import shape as s

# Sources ---------------------------------------------------------------------


@case(f"""
WITH {s.CENSUS} SELECT pmr, eth AS ethnicgroup, fsm AS fsmeligible, cy AS census_year,
  CASE cy {' '.join(f"WHEN {y} THEN '{t.lower()}'" for y, t in s.TERMS.items())} END AS census_term FROM census
""")
def q_union_family(d: Data):
    rows = census_rows(
        s.census_tables(d), s.CONFIG, s.TERMS, ["pmr", "ethnicgroup", "fsmeligible"], None,
        lambda name: ["ethnicgroup"] if name[-4:] in ("1997", "1998") else [],
    )
    return rows.withColumns({"census_year": census_year("source_table"), "census_term": census_term("source_table")}).drop("source_table")


@case(f"WITH {s.CENSUS} SELECT pmr, nc AS ncyearactual, cy AS census_year FROM census WHERE nc IN ('R', '1', '2') OR (nc = 'X' AND age <= 7)")
def q_year_group(d: Data):
    where = year_group(["R", 1, 2], "<=", 7)
    rows = census_rows(s.census_tables(d), s.CONFIG, s.TERMS, ["pmr", "ncyearactual"], where)
    return rows.withColumn("census_year", census_year("source_table")).drop("source_table")


# Spines ----------------------------------------------------------------------


@case(f"""
WITH {s.CENSUS}, {s.AP}, {s.BRIDGE},
seen AS (SELECT pmr, min(cy) AS y7_year FROM census WHERE cy BETWEEN 1996 AND 1998 AND (nc = '7' OR (nc = 'X' AND age = 11)) GROUP BY 1),
extra AS (SELECT pmr, CAST(min(ay) AS INTEGER) AS y7_year FROM ap WHERE ay BETWEEN 1996 AND 1998 AND age = 11 AND pmr NOT IN (SELECT pmr FROM seen) GROUP BY 1),
people AS (SELECT * FROM seen UNION ALL SELECT * FROM extra),
by_token AS (SELECT tpid, min(pmr) AS pmr FROM bridge WHERE tpid IS NOT NULL AND pmr IN (SELECT pmr FROM people) GROUP BY 1),
one AS (SELECT pmr, min(tpid) AS tpid FROM by_token GROUP BY 1)
SELECT p.pmr, p.y7_year, one.tpid FROM people p LEFT JOIN one ON one.pmr = p.pmr
""")
def q_school_spine(d: Data):
    return spines.school_spine(s.census_tables(d), s.CONFIG)


WINDOW = "WHERE l_shipdate >= DATE '1995-09-01' AND l_shipdate < DATE '1998-09-01'"


@case(f"""
WITH {s.birth_sql(WINDOW)}, {s.BRIDGE},
people AS (SELECT tpid, min(dob_approx) AS dob_approx, min(gestat) AS gestat, min(birweit) AS birweit, min(matage) AS matage FROM born GROUP BY 1
  HAVING count(DISTINCT dob_approx) <= 1 AND count(DISTINCT gestat) <= 1 AND count(DISTINCT birweit) <= 1 AND count(DISTINCT matage) <= 1),
by_token AS (SELECT tpid, min(pmr) AS pmr FROM bridge WHERE tpid IN (SELECT tpid FROM people) GROUP BY 1),
one AS (SELECT pmr, min(tpid) AS tpid FROM by_token GROUP BY 1)
SELECT p.*, CAST(year(dob_approx) + CASE WHEN month(dob_approx) >= 9 THEN 1 ELSE 0 END AS INTEGER) AS academic_yob, one.pmr,
  CAST(year(dob_approx) + CASE WHEN month(dob_approx) >= 9 THEN 1 ELSE 0 END + 12 AS INTEGER) AS y7_year
FROM people p LEFT JOIN one ON one.tpid = p.tpid
""")
def q_birth_spine(d: Data):
    return births.birth_spine(s.birth_tables(d), s.BIRTH_CONFIG, *s.birth_lists(d))


# person-level windows: spine of parts, born 1995 to 1997 by their key
def _patients(d: Data):
    key = F.col("p_partkey")
    return d.part.select(F.concat(F.lit("T"), key).alias("tpid"), (2008 + key % 3).cast("int").alias("y7_year"))


BIRTH_WINDOW = """WHERE l_shipdate >= make_date(1995 + l_partkey % 3, 9, 1) AND l_shipdate < make_date(1996 + l_partkey % 3, 9, 1)
  AND l_partkey IN (SELECT p_partkey FROM part)"""


def _characteristics_sql(window: str) -> str:
    single = ", ".join(f"CASE WHEN count(DISTINCT {c}) <= 1 THEN min({c}) END AS {c}" for c in ("gestat", "birweit", "matage", "imd_decile"))
    return f"WITH {s.birth_sql(window)} SELECT tpid, {single} FROM born GROUP BY 1"


@case(_characteristics_sql(BIRTH_WINDOW))
def q_birth_characteristics(d: Data):
    return births.birth_characteristics(s.birth_tables(d), s.BIRTH_CONFIG, _patients(d), *s.birth_lists(d))


OR_WINDOW = "WHERE year(l_shipdate) BETWEEN 1995 AND 1998 AND l_partkey IN (SELECT p_partkey FROM part)"
KEPT = ", ".join(f"CASE WHEN count(DISTINCT {c}) <= 1 THEN min({c}) ELSE max({c}) FILTER (WHERE rn = 1) END AS {c}" for c in ("matage", "imd_decile"))


@case(f"""
WITH {s.birth_sql(OR_WINDOW)}, n AS (SELECT *, row_number() OVER (PARTITION BY tpid ORDER BY epistart, epikey, matage NULLS FIRST, imd_decile NULLS FIRST) AS rn FROM born)
SELECT tpid, CASE WHEN count(DISTINCT gestat) <= 1 THEN min(gestat) END AS gestat, CASE WHEN count(DISTINCT birweit) <= 1 THEN min(birweit) END AS birweit,
  {KEPT} FROM n GROUP BY 1
""")
def q_birth_characteristics_compat(d: Data):
    """Birth window as first written (either bound), first value kept on conflict."""
    cfg = replace(s.BIRTH_CONFIG, compat=replace(s.BIRTH_CONFIG.compat, birth_window_or=True, keep_first_on_conflict=True))
    return births.birth_characteristics(s.birth_tables(d), cfg, _patients(d), *s.birth_lists(d))


@case(f"WITH {s.birth_sql('')} SELECT tpid, epistart, epikey, gestat, birweit, matage FROM born")
def q_birth_episodes(d: Data):
    cfg = replace(s.BIRTH_CONFIG, birth_cohorts=tuple(range(1996, 2002)))
    rows = births.episode_rows(s.birth_tables(d), cfg, cfg.birth_years, births.BIRTH_FIELDS, births.DIAG)
    kept = births.plausible(births.birth_episodes(births.repair_dates(rows), *s.birth_lists(d)))
    return kept.select("tpid", "epistart", "epikey", "gestat", "birweit", "matage")


# Demographics ----------------------------------------------------------------


def mode_of(rows: str, key: str, v: str) -> str:
    return f"""(SELECT {key}, {v} FROM (SELECT {key}, {v}, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {v}) AS rn
      FROM {rows} WHERE {v} IS NOT NULL GROUP BY 1, 2) WHERE rn = 1)"""


ETH = " ".join(f"WHEN trim(lower(eth)) IN ({', '.join(repr(v) for v in raw)}) THEN '{g}'" for g, raw in ETHNIC_GROUPS.items())
IN7 = "(nc IN ('R', '1', '2', '3', '4', '5', '6', '7') OR (nc = 'X' AND age <= 11))"
IN6 = "(nc IN ('R', '1', '2', '3', '4', '5', '6') OR (nc = 'X' AND age < 11))"
MODALS = f"""demo AS (SELECT pmr, CASE WHEN gender IN ('F', '2') THEN 1 WHEN gender NOT IN ('0', '9') THEN 0 END AS female, CASE {ETH} END AS ethnicgroup,
    CASE WHEN lang IN ('1_ENG', 'ENG', 'ENB') THEN 'English' WHEN lang IN ('2_OTH', 'OTH', 'OTB') THEN 'Not English' END AS languagegroup,
    yob AS yearofbirth, mob AS monthofbirth FROM (
  SELECT pmr, gender, eth, lang, yob, mob FROM census WHERE cy <= 1998 AND {IN7}
  UNION ALL SELECT pmr, gender, eth, NULL, yob, mob FROM ap WHERE ay <= 1998 AND age <= 11
  UNION ALL SELECT pmr, gender, eth, lang, yob, mob FROM pru WHERE {IN7}) WHERE pmr IN (SELECT pmr FROM spine)),
modals AS (SELECT k.pmr, female, ethnicgroup, languagegroup, yearofbirth, monthofbirth FROM (SELECT DISTINCT pmr FROM demo) k
  {' '.join(f'LEFT JOIN {mode_of("demo", "pmr", v)} m{i} ON m{i}.pmr = k.pmr' for i, v in enumerate(["female", "ethnicgroup", "languagegroup", "yearofbirth", "monthofbirth"]))})"""

SCHOOL = f"WITH {s.SPINE}, {s.CENSUS}, {s.AP}, {s.PRU}"


@case(f"{SCHOOL}, {MODALS} SELECT * FROM modals")
def q_modal_demographics(d: Data):
    return demographics.modal_demographics(s.census_tables(d), s.CONFIG, s.spine(d))


@case(f"""{SCHOOL}, {MODALS.replace("cy <= 1998 AND " + IN7, "cy <= 1998 AND (" + IN7 + " AND NOT (nc = '7' AND cy IN (1997, 1998)))").replace("FROM pru WHERE " + IN7, "FROM pru WHERE " + IN7 + " AND nc <> '7'")}
SELECT * FROM modals""")
def q_modal_demographics_compat(d: Data):
    """Vintages without ethnicity and referral units leave out year 7, as first written."""
    cfg = replace(s.CONFIG, compat=replace(s.CONFIG.compat, skip_omits_year7=True))
    return demographics.modal_demographics(s.census_tables(d), cfg, s.spine(d))


Y7 = f"""y7rows AS (SELECT DISTINCT pmr, fsm, idaci FROM (
    SELECT pmr, fsm, idaci FROM census WHERE cy BETWEEN 1996 AND 1998 AND (nc = '7' OR (nc = 'X' AND age = 11))
    UNION ALL SELECT pmr, fsm, NULL FROM ap WHERE ay BETWEEN 1996 AND 1998 AND age = 11) WHERE pmr IN (SELECT pmr FROM spine)),
y7 AS (SELECT f.pmr, f.fsmeligible_y7, m.idaci AS idaci_decile_y7 FROM (SELECT pmr, max(fsm) AS fsmeligible_y7 FROM y7rows GROUP BY 1) f
  LEFT JOIN {mode_of('y7rows', 'pmr', 'idaci')} m ON m.pmr = f.pmr)"""


@case(f"{SCHOOL}, {Y7} SELECT * FROM y7")
def q_year7_demographics(d: Data):
    return demographics.year7_demographics(s.census_tables(d), s.CONFIG, s.spine(d))


def ever_sql(top: str) -> str:
    return f"""everrows AS (SELECT pmr, fsm, CASE WHEN sen IN ('A', 'P', 'K') THEN 'support' WHEN sen IN ('E', 'e', 'S') THEN 'sehcp' END AS sen, special FROM (
    SELECT pmr, fsm, sen, NULL AS special FROM census WHERE cy <= 1997 AND {IN6}
    UNION ALL SELECT pmr, fsm, sen, TRUE FROM ap WHERE ay <= 1995 AND age < 11
    UNION ALL SELECT pmr, fsm, sen, TRUE FROM pru WHERE {IN6}) WHERE pmr IN (SELECT pmr FROM spine)),
ever AS (SELECT DISTINCT r.pmr, t.fsm_ever_primary, sen AS senprovision, special AS specialist_school FROM everrows r
  JOIN (SELECT pmr, {top} AS fsm_ever_primary FROM everrows GROUP BY 1) t ON t.pmr = r.pmr
  WHERE fsm_ever_primary = 1 OR sen IS NOT NULL OR special IS NOT NULL)"""


EVER = ever_sql("max(fsm)")


@case(f"{SCHOOL}, {EVER} SELECT * FROM ever")
def q_ever_demographics(d: Data):
    return demographics.ever_demographics(s.census_tables(d), s.CONFIG, s.spine(d))


@case(f"{SCHOOL}, {ever_sql('CASE WHEN count(*) = count(fsm) THEN max(fsm) END')} SELECT * FROM ever")
def q_ever_demographics_strict(d: Data):
    return demographics.ever_demographics(s.census_tables(d), replace(s.CONFIG, strict_nulls=True), s.spine(d))


REGISTERED = EVER.replace("NULL AS special FROM census", f"""CASE WHEN urn IN (SELECT urn FROM register WHERE {' OR '.join(
    f"coalesce({c}, '') ILIKE '%{w}%'" for c in ('type1', 'type2') for w in ('special', 'alternative', 'pupil referral unit'))}) THEN TRUE END AS special FROM census""")


@case(f"{SCHOOL}, {s.REGISTER}, {REGISTERED} SELECT * FROM ever")
def q_ever_demographics_register(d: Data):
    """Specialist schools found in a school register as well."""
    return demographics.ever_demographics(s.census_tables(d), s.CONFIG, s.spine(d), s.register(d))


# Phenotypes ------------------------------------------------------------------

HOSPITAL = f"WITH {s.SPINE}, {s.LONG}"


def _long(d: Data):
    return phenotypes.long_codes(phenotypes.primary_school_episodes(s.episode_tables(d), s.CONFIG, s.spine(d)))


@case(f"""{HOSPITAL}, {s.CHRONIC_SQL} SELECT tpid, y7_year, code, grp AS "group", epistart, phen_group FROM chronic""")
def q_phenotype(d: Data):
    return phenotypes.chronic_conditions(_long(d), s.phenotype_lists(d)[0], s.CONFIG.chronic_label)


@case(f"""{HOSPITAL}, {s.PRESENTING_SQL} SELECT tpid, y7_year, code, grp AS "group", epistart, phen_group FROM presenting""")
def q_presentations(d: Data):
    _, codes, medical, emergency = s.phenotype_lists(d)
    return phenotypes.presentations(_long(d), codes, medical, emergency)


@case(f"""
{HOSPITAL}, {s.CHRONIC_SQL}, f AS (SELECT tpid, {', '.join(f"coalesce(bool_or(grp = '{g}' AND epistart >= DATE '1992-01-01' AND epistart < DATE '1994-01-01'), FALSE) AS chc_{g}"
  for g in ('metabolic', 'respiratory', 'asthma', 'mental'))} FROM chronic GROUP BY 1)
SELECT s.pmr, s.tpid, {', '.join(f"CASE WHEN s.tpid IS NOT NULL THEN coalesce(chc_{g}, FALSE) END AS chc_{g}" for g in ('metabolic', 'respiratory', 'asthma', 'mental'))}
FROM spine s LEFT JOIN f ON f.tpid = s.tpid
""")
def q_phenotype_flags(d: Data):
    """One flag per condition group, counting a range of dates only."""
    codes = phenotypes.chronic_conditions(_long(d), s.phenotype_lists(d)[0], s.CONFIG.chronic_label)
    dated = (F.col("epistart") >= F.lit("1992-01-01").cast("date")) & (F.col("epistart") < F.lit("1994-01-01").cast("date"))
    return flags_by_group(
        s.spine(d).select("pmr", "tpid"), codes, "tpid", "group", ["metabolic", "respiratory", "asthma", "mental"], "chc_", dated
    )


# Panels ----------------------------------------------------------------------

ENROL = f"""enrol AS (SELECT e.*, s.y7_year, CAST(e.academicyear - (s.y7_year - 7) AS INTEGER) AS year FROM (
    SELECT DISTINCT pmr, cy AS academicyear, CASE cy {' '.join(f"WHEN {y} THEN '{t}'" for y, t in s.TERMS.items())} END AS census FROM census WHERE cy BETWEEN 1997 AND 2002
    UNION ALL SELECT DISTINCT pmr, CAST(ay AS INTEGER), 'AP' FROM ap WHERE ay BETWEEN 1997 AND 2002) e
  JOIN spine s ON s.pmr = e.pmr WHERE e.academicyear - (s.y7_year - 7) BETWEEN 8 AND 11)"""


@case(f"{SCHOOL}, {ENROL} SELECT * FROM enrol")
def q_enrolments(d: Data):
    return school.enrolments(s.census_tables(d), s.CONFIG, s.spine(d))


@case(f"WITH {s.SPINE}, {s.EXCLUSIONS} SELECT * FROM excl")
def q_exclusions(d: Data):
    return school.exclusions(s.exclusion_tables(d), s.CONFIG, s.spine(d))


@case(f"""
WITH {s.SPINE}, {s.EXCLUSIONS} SELECT pmr, bool_or(exclusion_category IN ('FIXD', 'LNCH')) AS ever_fixed_term, bool_or(exclusion_category = 'PERM') AS ever_permanent
FROM excl GROUP BY 1
""")
def q_exclusion_kinds(d: Data):
    rows = school.exclusions(s.exclusion_tables(d), s.CONFIG, s.spine(d))
    return exists_summary(rows, "pmr", school.exclusion_kinds(["FIXD", "LNCH"], ["PERM"]))


@case(f"""
WITH {s.SPINE}, {s.ABSENCE_SQL} SELECT *, abs_illness_rate >= 10 AS pa10_illness, abs_illness_appts_rate >= 10 AS pa10_health FROM absence
""")
def q_absence_other_flags(d: Data):
    """Persistent absence for reasons other than the overall rate."""
    panel = school.school_year_panel(school.absence_rows(s.absence_tables(d), s.CONFIG), s.spine(d), "pmr", "academicyear", 7, 11)
    flags = {"pa10_illness": "abs_illness_rate", "pa10_health": "abs_illness_appts_rate"}
    return school.absence_rates(school.annual_absence(panel, s.CONFIG), s.CONFIG, flags)


@case(f"WITH {s.SPINE}, {s.ABSENCE_SQL} SELECT * FROM absence")
def q_absence(d: Data):
    return school.absence(s.absence_tables(d), s.CONFIG, s.spine(d))


TERM_SQL = ", ".join(
    f"CASE WHEN year = 11 AND {i} >= 2 THEN NULL ELSE round(CAST(sum(ov{i}) AS DOUBLE) / nullif(sum(po{i}), 0) * 100, 1) END AS overall_rate_{t}"
    for i, t in enumerate(["aut", "spr", "sum", "sum6"])
)
TERM_RAW = ", ".join(
    f"{'CASE WHEN o_orderkey % 4 <> 0 THEN ' if i == 3 else ''}{e} {'ELSE 0 END' if i == 3 else ''} AS {c}{i}"
    for i in range(4) for c, e in (("ov", f"(o_orderkey + {i}) % 8"), ("po", f"(o_orderkey + {i}) % 30 + 20"))
)


@case(f"""
WITH {s.SPINE}, t AS (SELECT s.pmr, CAST(year(o_orderdate) - (s.y7_year - 7) AS INTEGER) AS year, {TERM_RAW}
  FROM orders JOIN spine s ON s.pmr = 'P' || o_custkey WHERE year(o_orderdate) BETWEEN 1996 AND 2001)
SELECT pmr, year, {TERM_SQL} FROM t WHERE year BETWEEN 7 AND 11 GROUP BY 1, 2
""")
def q_absence_termly(d: Data):
    panel = school.school_year_panel(school.absence_rows(s.absence_tables(d), s.CONFIG), s.spine(d), "pmr", "academicyear", 7, 11)
    return school.termly_rates(panel, s.CONFIG)


@case(f"WITH {s.SPINE}, {s.EXAMS} SELECT * FROM exams")
def q_exams(d: Data):
    return school.exams(s.exam_tables(d), s.CONFIG, s.spine(d))


@case(f"WITH {s.SPINE}, {s.CONTACTS} SELECT * FROM contacts")
def q_outpatient(d: Data):
    return care.outpatient_contacts(s.outpatient_tables(d), s.CONFIG, s.spine(d))


@case(f"""
WITH {s.SPINE}, {s.CONTACTS} SELECT tpid, count(*) FILTER (WHERE attended IN ('5', '6')) AS n_attended, count(*) FILTER (WHERE attended IN ('2', '4')) AS n_cancelled,
  count(*) FILTER (WHERE attended IN ('3', '7')) AS n_missed, count(*) FILTER (WHERE firstatt IN ('1', '3')) AS n_first,
  count(*) FILTER (WHERE firstatt NOT IN ('1', '3')) AS n_follow_up, min(apptdate) FILTER (WHERE attended IN ('5', '6')) AS date_first_attended
FROM contacts GROUP BY 1
""")
def q_attendance(d: Data):
    return care.attendance_summary(care.outpatient_contacts(s.outpatient_tables(d), s.CONFIG, s.spine(d)))


@case("""
WITH a AS (SELECT 'T' || o_custkey AS tpid, CAST(o_orderdate AS DATE) AS d, CAST(l_shipdate AS DATE) AS ship, l_returnflag = 'A' AS seen
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
f AS (SELECT tpid, min(ship) AS ship FROM a WHERE seen GROUP BY 1),
g AS (SELECT a.tpid, a.ship, min(a.d) AS d FROM a JOIN f ON f.tpid = a.tpid AND f.ship = a.ship WHERE a.seen GROUP BY 1, 2),
n AS (SELECT tpid, min(d) AS d FROM a GROUP BY 1)
SELECT n.tpid, coalesce(g.d, n.d) AS reqdate, g.ship AS date_first_attended, CAST(g.ship - g.d AS INTEGER) AS waiting_days FROM n LEFT JOIN g ON g.tpid = n.tpid
""")
def q_waiting_time(d: Data):
    rows = d.orders.join(d.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("T"), F.col("o_custkey")).alias("tpid"), F.col("o_orderdate").cast("date").alias("reqdate"),
        F.col("l_shipdate").cast("date").alias("apptdate"), F.when(F.col("l_returnflag") == "A", "5").otherwise("3").alias("attended"),
    )
    return care.waiting_time(rows)


@case("""
SELECT l_partkey AS referral, l_suppkey AS child, CAST(year(l_shipdate) AS INTEGER) AS snapshot, count(*) AS n_lines FROM lineitem l
WHERE year(l_shipdate) = (SELECT max(year(x.l_shipdate)) FROM lineitem x WHERE x.l_partkey = l.l_partkey AND x.l_suppkey = l.l_suppkey) GROUP BY 1, 2, 3
""")
def q_latest_referrals(d: Data):
    yearly = d.lineitem.groupBy(
        F.col("l_partkey").alias("referral"), F.col("l_suppkey").alias("child"), F.year("l_shipdate").alias("snapshot")
    ).agg(F.count(F.lit(1)).alias("n_lines"))
    return care.latest_referrals(yearly, ["referral", "child"], "snapshot", ["n_lines"])


@case(f"WITH {s.SPINE}, {s.SOCIAL} SELECT * FROM care")
def q_social_care(d: Data):
    return care.social_care(*s.social_care_frames(d), s.CONFIG, s.spine(d))


@case(f"""
WITH t AS (SELECT 'T' || l_partkey AS tpid, l_returnflag, l_linestatus FROM lineitem)
SELECT k.tpid, a.l_returnflag, b.l_linestatus FROM (SELECT DISTINCT tpid FROM t) k
LEFT JOIN {mode_of('t', 'tpid', 'l_returnflag')} a ON a.tpid = k.tpid LEFT JOIN {mode_of('t', 'tpid', 'l_linestatus')} b ON b.tpid = k.tpid
""")
def q_hospital_modals(d: Data):
    rows = d.lineitem.withColumn("tpid", F.concat(F.lit("T"), F.col("l_partkey")))
    return demographics.hospital_modal_demographics(rows, ["l_returnflag", "l_linestatus"], s.CONFIG)


HOSPITAL_MODAL = f"""{s.HOSPITAL_SQL}, hospital AS (SELECT k.tpid, hospital_female, hospital_ethnicgroup, hospital_imd_decile FROM (SELECT DISTINCT tpid FROM hospital_rows) k
  {' '.join(f'LEFT JOIN {mode_of("hospital_rows", "tpid", v)} m{i} ON m{i}.tpid = k.tpid' for i, v in enumerate(demographics.HOSPITAL_MODALS))})"""


@case(f"WITH {s.SPINE}, {HOSPITAL_MODAL} SELECT * FROM hospital")
def q_hospital_demographics(d: Data):
    return demographics.hospital_demographics(s.episode_tables(d), s.CONFIG, s.spine(d))


# Everything on the spine -----------------------------------------------------


def parts(d: Data) -> dict:
    cfg, spine = s.CONFIG, s.spine(d)
    census = s.census_tables(d)
    return {
        "demographics_modals": demographics.modal_demographics(census, cfg, spine),
        "demographics_y7": demographics.year7_demographics(census, cfg, spine),
        "demographics_ever": demographics.ever_demographics(census, cfg, spine),
        "phen_codes": phenotypes.phenotype_episodes(_long(d), cfg, *s.phenotype_lists(d)),
        "enrolments": school.enrolments(census, cfg, spine),
        "exclusions": school.exclusions(s.exclusion_tables(d), cfg, spine),
        "absence": school.absence(s.absence_tables(d), cfg, spine),
        "exams": school.exams(s.exam_tables(d), cfg, spine),
        "contacts": care.outpatient_contacts(s.outpatient_tables(d), cfg, spine),
        "social_care": care.social_care(*s.social_care_frames(d), cfg, spine),
    }


GROUPS = ["chronic", "psych", "internalising", "externalising", "thought_dis", "selfharm"]
PER_YEAR = [*s.RATES, "pa10", "sessionspossible_annual"]


def _has(alias: str, expr: str, name: str, id_col: str) -> str:
    return f"CASE WHEN sp.{id_col} IS NOT NULL THEN coalesce({alias}.{expr}, FALSE) END AS {name}"


WIDE = [
    "sp.pmr, sp.y7_year, sp.tpid, md.female, md.ethnicgroup, md.languagegroup, md.yearofbirth, md.monthofbirth, y.fsmeligible_y7, y.idaci_decile_y7",
    "CASE WHEN md.yearofbirth IS NOT NULL THEN make_date(CAST(md.yearofbirth AS BIGINT), CAST(md.monthofbirth AS BIGINT), 15) END AS dob_approx",
    *[_has("ph", f"chc_{g}", f"chc_{g}", "tpid") for g in GROUPS], _has("ct", "seen", "ever_attended_cpc", "tpid"), "ct.date_first_cpc",
    _has("ev", "fsm", "fsm_ever_primary", "pmr"), "CASE coalesce(ev.sen, 0) WHEN 3 THEN 'Specialist provision' WHEN 2 THEN 'S/EHCP' WHEN 1 THEN 'Support' ELSE 'None' END AS highest_sen_primary",
    "coalesce(ev.sen, 0) > 0 AS ever_sen_primary",
    *[f"NOT coalesce(en.y{y}, FALSE) AS not_enrolled_y{y}" for y in range(8, 12)], *[f"coalesce(ex.y{y}, FALSE) AS excluded_y{y}" for y in range(7, 12)],
    *[f"ab.{v}_{y}" for v in PER_YEAR for y in range(7, 12)], "xm.att8, xm.glevel2em_ptq_ee, xm.ebacc_94",
    *[f"coalesce(cr.{c}, FALSE) AS {c}" for c in ("ever_cin", "ever_cpp", "ever_cla")],
]
LATER = [
    f"({' OR '.join(f'chc_{g}' for g in GROUPS)}) AS chc_any", "(not_enrolled_y8 OR not_enrolled_y9 OR not_enrolled_y10 OR not_enrolled_y11) AS ever_not_enrolled",
    "CAST(not_enrolled_y8 AS INTEGER) + CAST(not_enrolled_y9 AS INTEGER) + CAST(not_enrolled_y10 AS INTEGER) + CAST(not_enrolled_y11 AS INTEGER) AS not_enrolled_n_yr",
    "(excluded_y7 OR excluded_y8 OR excluded_y9 OR excluded_y10 OR excluded_y11) AS ever_excluded", "(pa10_7 OR pa10_8 OR pa10_9 OR pa10_10 OR pa10_11) AS ever_pa10",
    "CASE WHEN ever_cla THEN 'CLA' WHEN ever_cpp THEN 'CPP' WHEN ever_cin THEN 'CiN' ELSE 'None' END AS highest_csc",
    "dob_approx >= DATE '1983-09-01' AND dob_approx < DATE '1986-09-01' AS born_in_year",
    "tpid IS NOT NULL AND (dob_approx >= DATE '1983-09-01' AND dob_approx < DATE '1986-09-01') AS eligible",
]
COMBINED = f"""
{SCHOOL}, {MODALS}, {Y7}, {EVER}, {ENROL}, {s.EXCLUSIONS}, {s.ABSENCE_SQL}, {s.EXAMS}, {s.CONTACTS}, {s.SOCIAL}, {s.LONG}, {s.CHRONIC_SQL}, {s.PRESENTING_SQL},
ph AS (SELECT tpid, {', '.join(f"bool_or(phen_group = '{g}') AS chc_{g}" for g in GROUPS)} FROM (SELECT * FROM chronic UNION ALL SELECT * FROM presenting) GROUP BY 1),
ct AS (SELECT tpid, TRUE AS seen, min(apptdate) AS date_first_cpc FROM contacts GROUP BY 1),
ev AS (SELECT pmr, bool_or(fsm_ever_primary = 1) AS fsm, max(CASE WHEN specialist_school THEN 3 WHEN senprovision = 'sehcp' THEN 2 WHEN senprovision = 'support' THEN 1 ELSE 0 END) AS sen FROM ever GROUP BY 1),
en AS (SELECT pmr, {', '.join(f"bool_or(year = {y} AND census IN ('Spring', 'AP')) AS y{y}" for y in range(8, 12))} FROM enrol GROUP BY 1),
ex AS (SELECT pmr, {', '.join(f"bool_or(year = {y}) AS y{y}" for y in range(7, 12))} FROM excl GROUP BY 1),
ab AS (SELECT pmr, {', '.join(f"max({v}) FILTER (WHERE year = {y}) AS {v}_{y}" for v in PER_YEAR for y in range(7, 12))} FROM absence GROUP BY 1),
wide AS (SELECT {', '.join(WIDE)} FROM spine sp LEFT JOIN modals md ON md.pmr = sp.pmr LEFT JOIN y7 y ON y.pmr = sp.pmr LEFT JOIN ph ON ph.tpid = sp.tpid
  LEFT JOIN ct ON ct.tpid = sp.tpid LEFT JOIN ev ON ev.pmr = sp.pmr LEFT JOIN en ON en.pmr = sp.pmr LEFT JOIN ex ON ex.pmr = sp.pmr LEFT JOIN ab ON ab.pmr = sp.pmr
  LEFT JOIN exams xm ON xm.pmr = sp.pmr LEFT JOIN care cr ON cr.pmr = sp.pmr)
SELECT *, {', '.join(LATER)} FROM wide
"""


@case(COMBINED)
def q_combine(d: Data):
    return combine(s.spine(d), parts(d), s.CONFIG)


@case(f"""
{_characteristics_sql(BIRTH_WINDOW).replace(" SELECT tpid, ", ", c AS (SELECT tpid, ", 1)})
SELECT 'P' || p_partkey AS pmr, 'T' || p_partkey AS tpid, CAST(2008 + p_partkey % 3 AS INTEGER) AS y7_year, gestat, birweit, matage, imd_decile
FROM part LEFT JOIN c ON c.tpid = 'T' || p_partkey
""")
def q_combine_births(d: Data):
    """What was recorded at birth, on a school-inception spine."""
    cfg = replace(s.BIRTH_CONFIG, inception="school")
    spine = _patients(d).withColumn("pmr", F.concat(F.lit("P"), F.substring("tpid", 2, 20)))
    return combine(spine, {"birth_records": births.birth_characteristics(s.birth_tables(d), cfg, spine, *s.birth_lists(d))}, cfg)


OPTIONS = replace(
    s.CONFIG, hospital_demographics=True, attended_only=True, phenotype_from=date(1992, 1, 1), phenotype_to=date(1994, 1, 1),
    exclusion_kinds={"ever_fixed_term": ("FIXD", "LNCH"), "ever_permanent": ("PERM",)},
    persistent_flags={"pa10_illness": "abs_illness_rate", "pa10_health": "abs_illness_appts_rate"},
)
OPTIONS_SQL = COMBINED
for was, now in (
    (SCHOOL, f"{SCHOOL}, {s.REGISTER}, {HOSPITAL_MODAL}"), (EVER, REGISTERED),
    ("UNION ALL SELECT * FROM presenting) GROUP", "UNION ALL SELECT * FROM presenting) WHERE epistart >= DATE '1992-01-01' AND epistart < DATE '1994-01-01' GROUP"),
    ("AS date_first_cpc FROM contacts", "AS date_first_cpc FROM contacts WHERE attended IN ('5', '6')"),
    (" FROM excl GROUP BY 1", ", bool_or(exclusion_category IN ('FIXD', 'LNCH')) AS fixed, bool_or(exclusion_category = 'PERM') AS perm FROM excl GROUP BY 1"),
    (" FROM absence GROUP BY 1", "".join(
        f", bool_or({rate} >= 10) FILTER (WHERE year = {y}) AS {flag}_{y}" for flag, rate in OPTIONS.persistent_flags.items() for y in range(7, 12)) + " FROM absence GROUP BY 1"),
    (" FROM spine sp LEFT JOIN modals", ", ho.hospital_female, ho.hospital_ethnicgroup, ho.hospital_imd_decile, coalesce(ex.fixed, FALSE) AS ever_fixed_term, coalesce(ex.perm, FALSE) AS ever_permanent, "
     + ", ".join(f"ab.{flag}_{y}" for flag in OPTIONS.persistent_flags for y in range(7, 12)) + " FROM spine sp LEFT JOIN hospital ho ON ho.tpid = sp.tpid LEFT JOIN modals"),
    (" FROM wide\n", ", " + ", ".join(f"({' OR '.join(f'{flag}_{y}' for y in range(7, 12))}) AS ever_{flag}" for flag in OPTIONS.persistent_flags) + " FROM wide\n"),
):
    assert OPTIONS_SQL.count(was) == 1, was
    OPTIONS_SQL = OPTIONS_SQL.replace(was, now)


@case(OPTIONS_SQL)
def q_combine_options(d: Data):
    """The wide dataset with every optional part."""
    cfg, spine = OPTIONS, s.spine(d)
    more = {
        "demographics_ever": demographics.ever_demographics(s.census_tables(d), cfg, spine, s.register(d)),
        "hospital_demographics": demographics.hospital_demographics(s.episode_tables(d), cfg, spine),
        "absence": school.absence(s.absence_tables(d), cfg, spine),
    }
    return combine(spine, parts(d) | more, cfg)
