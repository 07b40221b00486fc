"""The given tables in the shape of school and hospital extracts.

Customers stand for pupils, orders for census and event rows of a year, order
lines for hospital episodes of a part taken as a patient. Each yearly extract is a
filter on the source's date, its columns carrying the year as real ones do.
Every source comes with the SQL for the same rows in one piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.config import Config
from linkcohort.plans.births import DIAG, OPERTN
from linkcohort.sources import codelist
from workload import Data

CONFIG = Config(birth_cohorts=(1984, 1985, 1986), no_ethnicity="Autumn_Census_1997|Summer_Census_1998")
BIRTH_CONFIG = Config(birth_cohorts=(1996, 1997, 1998), inception="birth")
TERMS = {1995: "Autumn", 1996: "Spring", 1997: "Autumn", 1998: "Summer", 1999: "Spring", 2000: "Autumn", 2001: "Spring"}
SHIFT = 2192  # days by which order and shipping dates precede the school years


def of_year(df: DataFrame, date: str, year: int) -> DataFrame:
    lo, hi = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    return df.filter((F.col(date) >= lo) & (F.col(date) < hi))


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int") + 1)


def pick_sql(values: list[str], index: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[1 + ({index}) % {len(values)}]"


def spine(d: Data) -> DataFrame:
    key = F.col("c_custkey")
    return d.customer.select(
        F.concat(F.lit("P"), key).alias("pmr"), (1996 + key % 3).cast("int").alias("y7_year"),
        F.when(F.col("c_nationkey") != 3, F.concat(F.lit("T"), key)).alias("tpid"),
    )


SPINE = """spine AS (SELECT 'P' || c_custkey AS pmr, CAST(1996 + c_custkey % 3 AS INTEGER) AS y7_year,
  CASE WHEN c_nationkey <> 3 THEN 'T' || c_custkey END AS tpid FROM customer)"""

ETHNICITY = [" WBRI ", "Black - African", "MWAS", "REFU", "Chinese"]
GENDER, LANGUAGE = ["F", "M", "1", "2", "0", "9"], ["1_ENG", "OTH", "ZZZ"]
SEN = ["A", "P", "K", "E", "e", "S", "N", "N", "N"]


def okey() -> Column:
    return F.col("o_orderkey")


def yearly(rows: DataFrame, date: str, year: int, suffix: str = "", without: tuple[str, ...] = ()) -> DataFrame:
    """One year's extract of a source, its columns renamed the way that year names them."""
    df = of_year(rows, date, year).drop(date, *without)
    return df.toDF(*[f"{c}{suffix}" for c in df.columns])


def _school_year(date: str) -> Column:
    return F.concat_ws("/", F.year(date) - 1, F.year(date))


def _census(d: Data) -> dict[str, DataFrame]:
    nc = okey() % 9
    rows = d.orders.select(
        F.concat(F.lit("P"), F.col("o_custkey")).alias("PupilMatchingRefAnonymous"),
        (4 + okey() % 10).cast("string").alias("AgeAtStartOfAcademicYear"),
        (okey() % 12).alias("MonthPartOfAgeAtStartOfAcademicYear"),
        F.when(nc == 0, "R").when(nc == 8, "X").otherwise(nc.cast("string")).alias("NCyearActual"),
        _school_year("o_orderdate").alias("AcademicYear"),
        pick(GENDER, okey()).alias("Gender"),
        pick(ETHNICITY, F.floor(okey() / 3)).alias("EthnicGroupMajor"),
        pick(LANGUAGE, F.floor(okey() / 4)).alias("LanguageGroupMajor"),
        (1984 + okey() % 2 + F.col("o_custkey") % 2).cast("int").alias("YearOfBirth"),
        (1 + F.col("o_custkey") % 12).cast("int").alias("MonthOfBirth"),
        F.when(F.col("o_totalprice") > 400000, 1).when(F.col("o_totalprice") > 50000, 0).alias("FSMeligible"),
        (1 + okey() % 10).cast("int").alias("IDACI_Decile"),
        pick(SEN, F.floor(okey() / 2)).alias("SENprovision"),
        (okey() % 97).cast("string").alias("URN"),
        "o_orderdate",
    )
    return {
        f"{t}_Census_{y}": yearly(
            rows, "o_orderdate", y, f"_{t[:3].upper()}{y % 100:02d}", ("EthnicGroupMajor",) if y in (1997, 1998) else ()
        )
        for y, t in TERMS.items()
    }


CENSUS = f"""census AS (SELECT 'P' || o_custkey AS pmr, CAST(year(o_orderdate) AS INTEGER) AS cy, 4 + o_orderkey % 10 AS age,
  CASE o_orderkey % 9 WHEN 0 THEN 'R' WHEN 8 THEN 'X' ELSE CAST(o_orderkey % 9 AS VARCHAR) END AS nc,
  {pick_sql(GENDER, 'o_orderkey')} AS gender,
  CASE WHEN year(o_orderdate) NOT IN (1997, 1998) THEN {pick_sql(ETHNICITY, 'o_orderkey // 3')} END AS eth,
  {pick_sql(LANGUAGE, 'o_orderkey // 4')} AS lang, CAST(1984 + o_orderkey % 2 + o_custkey % 2 AS INTEGER) AS yob,
  CAST(1 + o_custkey % 12 AS INTEGER) AS mob,
  CASE WHEN o_totalprice > 400000 THEN 1 WHEN o_totalprice > 50000 THEN 0 END AS fsm,
  CAST(1 + o_orderkey % 10 AS INTEGER) AS idaci, {pick_sql(SEN, 'o_orderkey // 2')} AS sen,
  CAST(o_orderkey % 97 AS VARCHAR) AS urn FROM orders)"""

SCHOOL_TYPES = ["Community school", "Foundation Special School", "Academy", "Other", "Free School Alternative Provision", "Nursery"]


def register(d: Data) -> DataFrame:
    key = F.col("s_suppkey")
    return d.supplier.select(
        key.alias("urn"), pick(SCHOOL_TYPES, key).alias("type1"), F.when(F.col("s_nationkey") == 7, "Pupil Referral Units").alias("type2"),
    )


REGISTER = f"""register AS (SELECT CAST(s_suppkey AS VARCHAR) AS urn, {pick_sql(SCHOOL_TYPES, 's_suppkey')} AS type1,
  CASE WHEN s_nationkey = 7 THEN 'Pupil Referral Units' END AS type2 FROM supplier)"""


def _ap(d: Data) -> DataFrame:
    key = F.col("c_custkey")
    year = 1990 + key % 12
    return d.customer.select(
        F.concat(F.lit("P"), key).alias("AP_PupilMatchingRefAnonymous"), F.concat_ws("/", year - 1, year).alias("AP_ACADYR"),
        (5 + F.col("c_nationkey") % 10).alias("AP_Age_Start"), pick(GENDER, key).alias("AP_Gender"),
        pick(ETHNICITY, F.floor(key / 2)).alias("AP_EthnicGroupMajor"), (1984 + key % 3).cast("int").alias("AP_YearOfBirth"),
        (1 + key % 12).cast("int").alias("AP_MonthOfBirth"), F.when(F.col("c_acctbal") > 5000, 1).otherwise(0).alias("AP_FSMeligible"),
        pick(SEN, key).alias("AP_SENProvision"),
    )


AP = f"""ap AS (SELECT 'P' || c_custkey AS pmr, 1990 + c_custkey % 12 AS ay, 5 + c_nationkey % 10 AS age, {pick_sql(GENDER, 'c_custkey')} AS gender,
  {pick_sql(ETHNICITY, 'c_custkey // 2')} AS eth, CAST(1984 + c_custkey % 3 AS INTEGER) AS yob, CAST(1 + c_custkey % 12 AS INTEGER) AS mob,
  CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS fsm, {pick_sql(SEN, 'c_custkey')} AS sen FROM customer)"""


def _pru(d: Data) -> DataFrame:
    key, nc = F.col("c_custkey"), F.col("c_nationkey") % 9
    return d.customer.select(
        F.concat(F.lit("P"), key).alias("PRU_PupilMatchingRefAnonymous"), F.when(key % 2 == 0, "1996/1997").otherwise("1997/1998").alias("PRU_AcademicYear"),
        F.when(nc == 0, "R").when(nc == 8, "X").otherwise(nc.cast("string")).alias("PRU_NCyearActual"),
        (5 + key % 10).alias("PRU_AgeAtStartOfAcademicYear"), pick(GENDER, key).alias("PRU_Gender"),
        pick(ETHNICITY, key).alias("PRU_EthnicGroupMajor"), pick(LANGUAGE, key).alias("PRU_LanguageGroupMajor"),
        (1984 + key % 3).cast("int").alias("PRU_YearOfBirth"), (1 + key % 12).cast("int").alias("PRU_MonthOfBirth"),
        F.when(F.col("c_acctbal") > 8000, 1).otherwise(0).alias("PRU_FSMeligible"), pick(SEN, F.floor(key / 2)).alias("PRU_SENprovision"),
    )


PRU = f"""pru AS (SELECT 'P' || c_custkey AS pmr, CASE c_nationkey % 9 WHEN 0 THEN 'R' WHEN 8 THEN 'X' ELSE CAST(c_nationkey % 9 AS VARCHAR) END AS nc,
  5 + c_custkey % 10 AS age, {pick_sql(GENDER, 'c_custkey')} AS gender, {pick_sql(ETHNICITY, 'c_custkey')} AS eth,
  {pick_sql(LANGUAGE, 'c_custkey')} AS lang, CAST(1984 + c_custkey % 3 AS INTEGER) AS yob, CAST(1 + c_custkey % 12 AS INTEGER) AS mob,
  CASE WHEN c_acctbal > 8000 THEN 1 ELSE 0 END AS fsm, {pick_sql(SEN, 'c_custkey // 2')} AS sen FROM customer)"""


def _bridge(d: Data) -> DataFrame:
    token = F.when(okey() % 11 != 0, F.concat(F.lit("T"), F.col("o_custkey") - okey() % 2))
    return d.orders.select(F.concat(F.lit("P"), F.col("o_custkey")).alias("pmr"), token.alias("tpid"))


BRIDGE = """bridge AS (SELECT 'P' || o_custkey AS pmr, CASE WHEN o_orderkey % 11 <> 0 THEN 'T' || (o_custkey - o_orderkey % 2) END AS tpid FROM orders)"""


def census_tables(d: Data) -> dict[str, DataFrame]:
    ap, pru = _ap(d), _pru(d)
    early = F.col("AP_ACADYR") < "1995"
    return _census(d) | {
        "AP_Census_1990_to_1995": ap.filter(early), "AP_Census_1996_to_2001": ap.filter(~early),
        **{f"PRU_Census_{y}": pru.filter(F.col("PRU_AcademicYear") == f"{y - 1}/{y}") for y in (1997, 1998)}, "bridging": _bridge(d),
    }


def exclusion_tables(d: Data) -> dict[str, DataFrame]:
    status = F.col("o_orderstatus")
    rows = d.orders.select(
        F.concat(F.lit("P"), F.col("o_custkey")).alias("PupilMatchingRefAnonymous"),
        _school_year("o_orderdate").alias("AcademicYear"),
        F.when(status == "F", "PERM").when(status == "O", "FIXD").otherwise("LNCH").alias("Category"),
        (okey() % 10).cast("int").alias("Sessions"),
        F.col("o_orderdate").cast("date").alias("StartDate"),
        "o_orderdate",
    )
    return {f"Exclusions_{y}": yearly(rows, "o_orderdate", y, f"_ex{y % 100:02d}") for y in TERMS}


EXCLUSIONS = """excl AS (SELECT e.*, s.y7_year, CAST(e.academicyear - (s.y7_year - 7) AS INTEGER) AS year FROM (
    SELECT DISTINCT 'P' || o_custkey AS pmr, CAST(year(o_orderdate) AS INTEGER) AS academicyear,
      CASE o_orderstatus WHEN 'F' THEN 'PERM' WHEN 'O' THEN 'FIXD' ELSE 'LNCH' END AS exclusion_category,
      CAST(o_orderkey % 10 AS INTEGER) AS sessions, CAST(o_orderdate AS DATE) AS startdate
    FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2001) e
  JOIN spine s ON s.pmr = e.pmr WHERE e.academicyear - (s.y7_year - 7) BETWEEN 7 AND 11)"""

# numerator columns of each term, as (raw name, modulus)
ABSENCE = {"SessionsPossible": 30, "AuthorisedAbsence": 5, "UnauthorisedAbsence": 3, "OverallAbsence": 8, "TermlyReasonI": 3, "TermlyReasonM": 2}
ABSENCE_TERMS = ["Autumn", "Spring", "Summer", "Summer6th"]


def absence_tables(d: Data) -> dict[str, DataFrame]:
    cols = [F.concat(F.lit("P"), F.col("o_custkey")).alias("PupilMatchingRefAnonymous"), _school_year("o_orderdate").alias("AcademicYear")]
    for stem, m in ABSENCE.items():
        for i, term in enumerate(ABSENCE_TERMS):
            value = f"CAST((o_orderkey + {i}) % {m} + {20 if m == 30 else 0} AS INT)"
            value = f"CASE WHEN o_orderkey % 4 <> 0 THEN {value} END" if i == 3 else value
            cols.append(F.expr(f"{value} AS {stem}_{term}"))
    rows = d.orders.select(*cols, "o_orderdate")
    return {f"Absence_{y}": yearly(rows, "o_orderdate", y, f"_ab{y % 100:02d}") for y in TERMS}


def _absence_sum(m: int) -> str:
    def term(i: int) -> str:
        v = f"(o_orderkey + {i}) % {m}" + (" + 20" if m == 30 else "")
        v = f"CASE WHEN o_orderkey % 4 <> 0 THEN {v} ELSE 0 END" if i == 3 else v
        return f"CASE WHEN ay - (s.y7_year - 7) = 11 THEN 0 ELSE {v} END" if i >= 2 else v

    return " + ".join(f"({term(i)})" for i in range(4))


RATES = {
    "abs_auth_rate": "au", "abs_unauth_rate": "un", "abs_overall_rate": "ov", "abs_illness_rate": "il",
    "abs_appts_rate": "ap", "abs_illness_appts_rate": "il + ap",
}
ABSENCE_SQL = f"""absum AS (SELECT s.pmr, CAST(ay - (s.y7_year - 7) AS INTEGER) AS year,
    {', '.join(f'sum({_absence_sum(m)}) AS {c}' for c, m in zip(['pos', 'au', 'un', 'ov', 'il', 'ap'], ABSENCE.values()))}
  FROM (SELECT *, 'P' || o_custkey AS pmr, year(o_orderdate) AS ay FROM orders) o JOIN spine s ON s.pmr = o.pmr
  WHERE ay BETWEEN 1996 AND 2001 AND ay - (s.y7_year - 7) BETWEEN 7 AND 11 GROUP BY 1, 2),
absence AS (SELECT pmr, year, CAST(pos AS BIGINT) AS sessionspossible_annual,
    {', '.join(f'CASE WHEN pos > 0 THEN round(CAST({e} AS DOUBLE) / pos * 100, 1) END AS {c}' for c, e in RATES.items())},
    CASE WHEN pos > 0 THEN round(CAST(ov AS DOUBLE) / pos * 100, 1) >= 10 END AS pa10 FROM absum WHERE pos <= 420)"""


def exam_tables(d: Data) -> dict[str, DataFrame]:
    year = F.year("o_orderdate")
    rows = d.orders.withColumn("late", year >= 2000).select(
        "late",
        F.concat(F.lit("P"), F.col("o_custkey")).alias("KS4_PupilMatchingRefAnonymous"), F.concat_ws("/", year - 1, year).alias("KS4_ACADYR"),
        F.round(F.col("o_totalprice") / 10000, 1).alias("KS4_ATT8"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("KS4_GLEVEL2EM_PTQ_EE"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") != "5-LOW", 0).alias("KS4_EBACC_94"),
    )
    return {"KS4Pupil_1995_to_1999": rows.filter("NOT late").drop("late"), "KS4Pupil_2000_to_2001": rows.filter("late").drop("late")}


EXAMS = """exams AS (SELECT 'P' || o_custkey AS pmr, max(round(o_totalprice / 10000, 1)) AS att8,
    max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS glevel2em_ptq_ee,
    max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 WHEN o_orderpriority <> '5-LOW' THEN 0 END) AS ebacc_94
  FROM orders WHERE year(o_orderdate) BETWEEN 1999 AND 2002 AND 'P' || o_custkey IN (SELECT pmr FROM spine) GROUP BY 1)"""

SPECIALTY, ATTENDED, FIRSTATT = ["191", "241", "100", "300"], ["5", "6", "2", "3", "4", "7"], ["1", "2", "3", "4"]


def outpatient_tables(d: Data) -> dict[str, DataFrame]:
    rows = d.orders.select(
        F.concat(F.lit("T"), F.col("o_custkey")).alias("TOKEN_PERSON_ID"),
        F.date_sub(F.col("o_orderdate").cast("date"), SHIFT).cast("string").alias("APPTDATE"),
        pick(FIRSTATT, okey()).alias("FIRSTATT"), pick(ATTENDED, okey()).alias("ATTENDED"), pick(SPECIALTY, okey()).alias("TRETSPEF"),
        "o_orderdate",
    )
    return {f"HES_OP_{y - 6}": yearly(rows, "o_orderdate", y) for y in TERMS}


CONTACTS = f"""contacts AS (SELECT c.*, s.y7_year FROM (SELECT DISTINCT 'T' || o_custkey AS tpid, CAST(o_orderdate AS DATE) - {SHIFT} AS apptdate,
    {pick_sql(FIRSTATT, 'o_orderkey')} AS firstatt, {pick_sql(ATTENDED, 'o_orderkey')} AS attended, {pick_sql(SPECIALTY, 'o_orderkey')} AS tretspef
    FROM orders) c JOIN spine s ON s.tpid = c.tpid
  WHERE tretspef IN ('191', '241') AND apptdate >= make_date(CAST(s.y7_year AS BIGINT) - 7, 9, 1) AND apptdate < make_date(CAST(s.y7_year AS BIGINT) - 1, 8, 31))"""


def social_care_frames(d: Data) -> tuple[DataFrame, DataFrame]:
    cin = d.orders.select(
        F.concat(F.lit("P"), F.col("o_custkey")).alias("pmr"), F.date_sub(F.col("o_orderdate").cast("date"), SHIFT).alias("referraldate"),
        (F.col("o_orderstatus") == "F").alias("need_episode"), (F.col("o_orderpriority") == "1-URGENT").alias("cpp"),
    )
    cla = d.lineitem.select(
        F.concat(F.lit("P"), F.col("l_partkey")).alias("pmr"),
        F.date_sub(F.col("l_shipdate").cast("date"), SHIFT).alias("date_episode_started"),
    )
    return cin, cla


SOCIAL = f"""care_rows AS (SELECT 'P' || o_custkey AS pmr, CAST(o_orderdate AS DATE) - {SHIFT} AS day, o_orderstatus = 'F' AS cin, o_orderpriority = '1-URGENT' AS cpp, FALSE AS cla FROM orders
  UNION ALL SELECT 'P' || l_partkey, CAST(l_shipdate AS DATE) - {SHIFT}, FALSE, FALSE, TRUE FROM lineitem),
care AS (SELECT s.pmr, bool_or(cin) AS ever_cin, bool_or(cpp) AS ever_cpp, bool_or(cla) AS ever_cla FROM care_rows r JOIN spine s ON s.pmr = r.pmr
  WHERE day >= make_date(CAST(s.y7_year AS BIGINT) - 7, 9, 1) AND day < make_date(CAST(s.y7_year AS BIGINT) - 1, 8, 31) GROUP BY 1)"""

# Hospital episodes -----------------------------------------------------------

CODES = ["J450", "J451", "F329", "X600", "E109", "R104", "F200", "F913", "K35", ""]
OPS, ADMIMETH = ["", "A123", "B45", ""], ["21", "22", "11", "2A", "82"]
SEX, ETHNOS = ["1", "2", "2", "9"], ["A", "C", "4", "M", "R", "Z", "G"]
IMD = ["Most deprived 10%", "More deprived 20-30%", "Less deprived 40-50%", "Least deprived 10%", "Unknown"]
IMD_SQL = "CASE {0} WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 6 WHEN 3 THEN 10 END"


def line(name: str) -> Column:
    return F.col(f"l_{name}")


def _episode_dates(day: Column) -> dict[str, Column]:
    q = F.col("l_quantity").cast("int")
    return {
        "EPISTART": day.cast("string"),
        "EPIEND": F.when((F.col("l_tax") == 0.07) & (F.col("l_discount") == 0), "1801-01-01").otherwise(F.date_add(day, q % 9 - 1).cast("string")),
        "ADMIDATE": F.when((F.col("l_tax") == 0.08) & (F.col("l_discount") == 0), "").otherwise(F.date_sub(day, line("linenumber") % 3).cast("string")),
        "DISDATE": F.when(line("linenumber") != 7, F.date_add(day, q * 3 % 70 - 2).cast("string")),
    }


def _dates_sql(day: str) -> str:
    """CTEs raw -> fixed; raw carries tpid, day and the columns of lineitem."""
    return f"""dated AS (SELECT *, {day} AS epistart0,
    CASE WHEN NOT (l_tax = 0.07 AND l_discount = 0) THEN {day} + CAST(l_quantity AS INTEGER) % 9 - 1 END AS epiend0,
    CASE WHEN NOT (l_tax = 0.08 AND l_discount = 0) THEN {day} - l_linenumber % 3 END AS admi0,
    CASE WHEN l_linenumber <> 7 THEN {day} + CAST(l_quantity AS INTEGER) * 3 % 70 - 2 END AS dis0 FROM raw),
full_dates AS (SELECT * REPLACE (coalesce(dis0, epiend0) AS dis0) FROM dated WHERE epiend0 IS NOT NULL AND admi0 IS NOT NULL),
turned AS (SELECT * REPLACE (CASE WHEN admi0 > dis0 THEN epiend0 ELSE epistart0 END AS epistart0, CASE WHEN admi0 > dis0 THEN epistart0 ELSE epiend0 END AS epiend0,
    CASE WHEN admi0 > dis0 THEN dis0 ELSE admi0 END AS admi0, CASE WHEN admi0 > dis0 THEN admi0 ELSE dis0 END AS dis0) FROM full_dates),
fixed AS (SELECT *, CASE WHEN epistart0 > epiend0 THEN admi0 ELSE epistart0 END AS epistart,
    CASE WHEN epistart0 > epiend0 THEN dis0 ELSE epiend0 END AS epiend, admi0 AS admidate, dis0 AS disdate FROM turned)"""


def _diag3() -> dict[str, Column]:
    return {"DIAG_01": pick(CODES, line("orderkey") + line("linenumber")), "DIAG_02": pick(CODES, line("suppkey")), "DIAG_03": pick(CODES, F.floor(line("orderkey") / 10))}


DIAG3_SQL = f"""{pick_sql(CODES, 'l_orderkey + l_linenumber')} AS d1, {pick_sql(CODES, 'l_suppkey')} AS d2, {pick_sql(CODES, 'l_orderkey // 10')} AS d3"""


def _with_blank_codes(cols: dict[str, Column]) -> list[Column]:
    blanks = [F.expr(f"'' AS {c.upper()}") for c in [*DIAG, *OPERTN] if c.upper() not in cols]
    return [*[c.alias(n) for n, c in cols.items()], *blanks]


def episode_tables(d: Data) -> dict[str, DataFrame]:
    day = F.date_sub(F.col("l_shipdate").cast("date"), SHIFT)
    cols = {
        "TOKEN_PERSON_ID": F.concat(F.lit("T"), line("partkey")), **_episode_dates(day), "ADMIMETH": pick(ADMIMETH, line("suppkey")),
        "STARTAGE": F.when(line("linenumber") == 1, 7001).otherwise((line("suppkey") % 18).cast("int")), **_diag3(), "OPERTN_01": pick(OPS, line("suppkey")),
        "SEX": pick(SEX, line("orderkey")), "ETHNOS": pick(ETHNOS, line("orderkey")), "IMD04_DECILE": pick(IMD, line("suppkey")),
    }
    rows = d.lineitem.select(*_with_blank_codes(cols), "l_shipdate")
    return {f"HES_APC_{y - 6}": yearly(rows, "l_shipdate", y) for y in TERMS}


HOSPITAL_SQL = f"""hospital_rows AS (SELECT DISTINCT 'T' || l_partkey AS tpid, CAST(l_shipdate AS DATE) AS epistart,
    CASE {pick_sql(SEX, 'l_orderkey')} WHEN '2' THEN 1 WHEN '1' THEN 0 END AS hospital_female,
    CASE {pick_sql(ETHNOS, 'l_orderkey')} WHEN 'A' THEN 'white' WHEN 'C' THEN 'white' WHEN '4' THEN 'asian' WHEN 'M' THEN 'black' WHEN 'R' THEN 'other' WHEN 'G' THEN 'mixed' END AS hospital_ethnicgroup,
    {IMD_SQL.format('l_suppkey % 5')} AS hospital_imd_decile
  FROM lineitem WHERE year(l_shipdate) BETWEEN 1995 AND 2001 AND 'T' || l_partkey IN (SELECT tpid FROM spine WHERE tpid IS NOT NULL))"""

CHRONIC = [("E10", "", "metabolic"), ("J45", "LOS3", "respiratory"), ("J45.0", "AGE10", "asthma"), ("F20", "", "mental")]
PRESENTING = [
    ("R10", "potentially_psych", ""), ("F32", "internalising", ""), ("F91.3", "externalising", ""), ("F200", "thought_disorder", ""),
    ("X60", "selfharm", ""), ("K35", "externalising", "selfharm_xz_codes"),
]
MEDICAL = [("K35", "icd10"), ("A12.3", "opcs4")]
EMERGENCY = [("21",), ("22",), ("2A",)]


def phenotype_lists(d: Data) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return (
        codelist(d.spark, CHRONIC, ["code", "flag", "group"]), codelist(d.spark, PRESENTING, ["code", "group", "flag2"]),
        codelist(d.spark, MEDICAL, ["code", "code_type"]), codelist(d.spark, EMERGENCY, ["code"]),
    )


def values_sql(rows: list[tuple], cols: str) -> str:
    body = ", ".join("(" + ", ".join("'" + (v.replace(".", "") if i == 0 else v) + "'" for i, v in enumerate(r)) + ")" for r in rows)
    return f"(VALUES {body}) AS v({cols})"


LONG = f"""raw AS (SELECT *, 'T' || l_partkey AS tpid, {DIAG3_SQL}, {pick_sql(OPS, 'l_suppkey')} AS op1, {pick_sql(ADMIMETH, 'l_suppkey')} AS admimeth,
    CASE WHEN l_linenumber = 1 THEN 7001 ELSE l_suppkey % 18 END AS startage FROM lineitem WHERE 'T' || l_partkey IN (SELECT tpid FROM spine)),
{_dates_sql(f'(CAST(l_shipdate AS DATE) - {SHIFT})')},
e AS (SELECT DISTINCT tpid, epistart, epiend, admidate, disdate, admimeth, startage, d1, d2, d3, op1 FROM fixed),
before AS (SELECT *, max(disdate) OVER (PARTITION BY tpid ORDER BY admidate RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS seen FROM e),
firsts AS (SELECT tpid, admidate, max(CASE WHEN seen >= admidate THEN 0 ELSE 1 END) AS opens FROM before GROUP BY 1, 2),
island AS (SELECT tpid, admidate, sum(opens) OVER (PARTITION BY tpid ORDER BY admidate) AS spell FROM firsts),
bounds AS (SELECT i.tpid, i.spell, min(e.admidate) AS spell_start, greatest(max(e.disdate), max(e.epiend)) AS spell_end
  FROM e JOIN island i ON i.tpid = e.tpid AND i.admidate = e.admidate GROUP BY 1, 2),
hosp AS (SELECT e.*, s.y7_year, b.spell_end - b.spell_start AS nights FROM e JOIN island i ON i.tpid = e.tpid AND i.admidate = e.admidate
  JOIN bounds b ON b.tpid = i.tpid AND b.spell = i.spell JOIN spine s ON s.tpid = e.tpid
  WHERE b.spell_start >= make_date(CAST(s.y7_year AS BIGINT) - 7, 9, 1) AND b.spell_start < make_date(CAST(s.y7_year AS BIGINT) - 1, 8, 31)),
diag AS (SELECT tpid, y7_year, epistart, admimeth, startage, nights, pos, code FROM hosp UNPIVOT (code FOR pos IN (d1, d2, d3)) WHERE code <> '')"""

CHRONIC_SQL = f"""chronic_list AS (SELECT * FROM {values_sql(CHRONIC, 'code, flag, grp')}),
chronic AS (SELECT tpid, y7_year, code, grp, epistart, 'chronic' AS phen_group FROM (
  SELECT d.*, coalesce(c4.grp, c3.grp) AS grp, CASE WHEN c4.code IS NOT NULL THEN c4.flag ELSE c3.flag END AS flag FROM diag d
  LEFT JOIN chronic_list c3 ON c3.code = substr(d.code, 1, 3) LEFT JOIN chronic_list c4 ON c4.code = d.code AND length(c4.code) = 4
  WHERE c3.code IS NOT NULL OR c4.code IS NOT NULL)
  WHERE NOT (flag = 'LOS3' AND nights < 3) AND NOT (flag = 'AGE10' AND CASE WHEN startage >= 7001 THEN 0 ELSE startage END < 10))"""

PRESENTING_SQL = """em AS (SELECT * FROM diag WHERE admimeth IN ('21', '22', '2A')),
ep AS (SELECT tpid, epistart, bool_or(pos = 'd1' AND substr(code, 1, 3) = 'R10') AS psych, bool_or(pos = 'd1' AND substr(code, 1, 3) = 'F32') AS intern,
    bool_or(pos = 'd1' AND code = 'F913') AS extern, bool_or(pos = 'd1' AND code = 'F200') AS thought, bool_or(substr(code, 1, 3) = 'X60') AS harm,
    bool_or(substr(code, 1, 3) = 'K35') AS med FROM em GROUP BY 1, 2),
ops AS (SELECT DISTINCT tpid, epistart FROM hosp WHERE op1 = 'A123'),
grouped AS (SELECT ep.tpid, ep.epistart, CASE WHEN harm THEN 'selfharm' WHEN thought THEN 'thought_dis' WHEN extern THEN 'externalising'
    WHEN intern THEN 'internalising' WHEN psych AND NOT med AND o.tpid IS NULL THEN 'psych' END AS grp
  FROM ep LEFT JOIN ops o ON o.tpid = ep.tpid AND o.epistart = ep.epistart),
presenting AS (SELECT em.tpid, em.y7_year, em.code, g.grp, em.epistart, g.grp AS phen_group FROM em
  JOIN grouped g ON g.tpid = em.tpid AND g.epistart = em.epistart WHERE g.grp IS NOT NULL)"""

# Births ----------------------------------------------------------------------

BIRTHS = [("diag", "Z38"), ("hrg", "N03")]
EXCLUDED = [("diag", "stillbirth", "P95"), ("diag", "stillbirth", "Z37.1"), ("diag", "termination", "O04.1"), ("diag", "multiple_births", "Z38.3")]
BIRTH_CODES = ["Z380", "J450", "P071", "", "A099", "Z381", "P590", ""]


def _rare(n: int, value, other) -> Column:
    return F.when(line("orderkey") % n == 0, value).otherwise(other)


def birth_tables(d: Data) -> dict[str, DataFrame]:
    day = F.col("l_shipdate").cast("date")
    extra = F.when(line("orderkey") % 211 == 0, "P95").when(line("orderkey") % 223 == 0, "Z371").when(line("orderkey") % 227 == 0, "O041").when(line("orderkey") % 229 == 0, "Z383").otherwise("")
    cols = {
        "TOKEN_PERSON_ID": F.concat(F.lit("T"), line("partkey")), **_episode_dates(day),
        "MYDOB": F.concat((1 + line("partkey") % 12 + _rare(53, 1, 0) * F.when(line("partkey") % 12 < 11, 1).otherwise(0)).cast("string"), (1995 + line("partkey") % 4).cast("string")),
        "EPIKEY": F.concat_ws("-", line("orderkey"), line("linenumber"), line("partkey"), line("suppkey"), F.col("l_extendedprice")),
        "ADMIMETH": pick(["21", "82", "11", "2C", "13"], line("orderkey")), "STARTAGE": (7001 + line("suppkey") % 3).cast("int"),
        "EPITYPE": _rare(19, 3, 1), "CLASSPAT": _rare(17, 5, 1), "NEOCARE": _rare(13, 1, 8), "HRGNHS": _rare(23, "N03", "A01"),
        "NUMBABY": pick(["1", "X", "", "1"], line("orderkey")), "DISMETH": _rare(41, 5, 1), "BIRSTAT_1": _rare(43, 2, 1),
        "MATAGE": F.when(line("linenumber") == 2, 99).otherwise((20 + line("partkey") % 20 + _rare(47, 1, 0)).cast("int")),
        "BIRORDR_1": _rare(59, "2", "X"),
        "GESTAT_1": F.when(line("linenumber") == 1, 99).otherwise((30 + line("partkey") % 12 + _rare(37, 1, 0)).cast("int")),
        "BIRWEIT_1": F.when(line("linenumber") == 3, 9999).when(line("linenumber") == 4, 120).otherwise((2000 + 10 * (line("partkey") % 100)).cast("int")),
        "IMD04_DECILE": pick(IMD, line("partkey") + _rare(61, 1, 0)), "DIAG_01": pick(BIRTH_CODES, line("orderkey")), "DIAG_02": extra,
    }
    rows = d.lineitem.select(*_with_blank_codes(cols), "l_shipdate")
    tables = {f"HES_APC_{y}": yearly(rows, "l_shipdate", y) for y in TERMS}
    return tables | {"bridging": _bridge(d)}


def birth_lists(d: Data) -> tuple[DataFrame, DataFrame]:
    return codelist(d.spark, BIRTHS, ["field", "code"]), codelist(d.spark, EXCLUDED, ["field", "group", "code"])


def birth_sql(window: str) -> str:
    """CTEs up to ``born``: live singleton birth episodes with cleaned fields."""
    return f"""raw AS (SELECT *, 'T' || l_partkey AS tpid FROM lineitem {window}),
{_dates_sql('CAST(l_shipdate AS DATE)')},
b AS (SELECT tpid, epistart, l_orderkey % 59 = 0 OR l_orderkey % 41 = 0 OR l_orderkey % 43 = 0 AS odd,
    bool_or(l_orderkey % 211 = 0 OR l_orderkey % 223 = 0 OR l_orderkey % 227 = 0 OR l_orderkey % 229 = 0) OVER (PARTITION BY tpid) AS excluded,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS epikey,
    CASE WHEN l_linenumber <> 1 THEN CAST(30 + l_partkey % 12 + CASE WHEN l_orderkey % 37 = 0 THEN 1 ELSE 0 END AS INTEGER) END AS gestat,
    CASE WHEN l_linenumber NOT IN (3, 4) THEN CAST(2000 + 10 * (l_partkey % 100) AS INTEGER) END AS birweit,
    CASE WHEN l_linenumber <> 2 THEN CAST(20 + l_partkey % 20 + CASE WHEN l_orderkey % 47 = 0 THEN 1 ELSE 0 END AS INTEGER) END AS matage,
    make_date(1995 + l_partkey % 4, 1 + l_partkey % 12 + CASE WHEN l_orderkey % 53 = 0 AND l_partkey % 12 < 11 THEN 1 ELSE 0 END, 15) AS dob_approx,
    {IMD_SQL.format('(l_partkey + CASE WHEN l_orderkey % 61 = 0 THEN 1 ELSE 0 END) % 5')} AS imd_decile
  FROM fixed WHERE l_suppkey % 3 < 2 AND (l_orderkey % 8 IN (0, 5) OR l_orderkey % 229 = 0 OR l_orderkey % 23 = 0 OR l_orderkey % 19 = 0
    OR l_orderkey % 17 = 0 OR l_orderkey % 5 IN (1, 3) OR l_orderkey % 13 = 0)),
born AS (SELECT * FROM b WHERE NOT excluded AND NOT odd)"""
