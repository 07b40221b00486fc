"""Codelist matching on part brands and types."""

from pyspark.sql import functions as F

from linkcohort.operators import any_code, match_codes, melt_codes, pack_codes, unpack_codes
from linkcohort.sources import codelist
from workload import Data, case

# Brand numbers as codes: B12 or B1 stand for every brand whose code starts so.
BRANDS = [("B1", "low", ""), ("B12", "twelve", "x"), ("B2.", "mid", ""), ("B2", "mid2", "y"), ("B25", "top", ""), ("B9", "nine", "x")]
BRAND_SQL = "(VALUES ('B1','low',''),('B12','twelve','x'),('B2','mid',''),('B2','mid2','y'),('B25','top',''),('B9','nine','x')) AS c(code, grp, flag)"


def _brands(d: Data):
    return codelist(d.spark, BRANDS, ["code", "grp", "flag"])


def _coded(d: Data):
    return d.part.select("p_partkey", F.regexp_replace("p_brand", "Brand#", "B").alias("code"))


@case(f"""
WITH c AS (SELECT * FROM {BRAND_SQL}), p AS (SELECT p_partkey, replace(p_brand, 'Brand#', 'B') AS code FROM part),
hit AS (SELECT p_partkey, p.code, max(length(c.code)) AS k FROM p JOIN c ON length(c.code) IN (2, 3) AND starts_with(p.code, c.code) GROUP BY 1, 2)
SELECT h.p_partkey, h.code, c.code AS matched_code, c.grp, c.flag FROM hit h JOIN c ON c.code = substr(h.code, 1, h.k)
""")
def q_match_codes(d: Data):
    return match_codes(_coded(d), _brands(d), ["grp", "flag"], lengths=(2, 3))


LONG_SQL = """
SELECT p_partkey, code_type, CAST(code_no AS INTEGER) AS code_no, substr(code, 1, 4) AS code FROM (
  SELECT p_partkey, 'diag' AS code_type, 1 AS code_no, replace(p_brand, 'Brand#', 'B') AS code FROM part
  UNION ALL SELECT p_partkey, 'diag', 2, CASE WHEN p_size > 25 THEN upper(p_type) ELSE '' END FROM part
  UNION ALL SELECT p_partkey, 'opertn', 1, nullif(p_type, 'PROMO') FROM part) WHERE code <> ''
"""


@case(LONG_SQL)
def q_melt_codes(d: Data):
    wide = d.part.select(
        "p_partkey", F.regexp_replace("p_brand", "Brand#", "B").alias("diag_01"),
        F.when(F.col("p_size") > 25, F.upper("p_type")).otherwise("").alias("diag_02"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("opertn_01"),
    )
    return melt_codes(wide, ["p_partkey"], ["diag_01", "diag_02", "opertn_01"])


@case(LONG_SQL)
def q_packed_codes(d: Data):
    wide = d.part.select(
        "p_partkey", F.regexp_replace("p_brand", "Brand#", "B").alias("diag_01"),
        F.when(F.col("p_size") > 25, F.upper("p_type")).otherwise("").alias("diag_02"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("opertn_01"),
    )
    packed = wide.select("p_partkey", pack_codes(["diag_01", "diag_02", "opertn_01"]).alias("codes"))
    return unpack_codes(packed, ["p_partkey"], "codes", {"diag": 2, "opertn": 1})


ANY_SQL = """
SELECT p_partkey, p_brand IN ('Brand#1','Brand#10','Brand#11','Brand#12','Brand#13','Brand#14','Brand#15','Brand#16','Brand#17','Brand#18','Brand#19',
  'Brand#2','Brand#20','Brand#21','Brand#22','Brand#23','Brand#24','Brand#25','Brand#9')
  OR p_type = 'PROMO' AS listed FROM part
"""


@case(ANY_SQL)
def q_any_code(d: Data):
    wide = d.part.select("p_partkey", F.regexp_replace("p_brand", "Brand#", "B").alias("c_1"), F.substring("p_type", 1, 2).alias("c_2"))
    wide = wide.select("p_partkey", pack_codes(["c_1", "c_2"]).alias("codes"))
    listed = codelist(d.spark, [*[(c,) for c, *_ in BRANDS], ("PR",)], ["code"])
    return any_code(wide, "listed", "codes", listed, ["p_partkey"], lengths=(2, 3)).select("p_partkey", "listed")


@case("""
WITH o AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_partkey % 500, 0) AS person, nullif(l_orderkey % 100, 0) AS episode,
  l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 40) AS hit FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, bool_or(hit) OVER (PARTITION BY person, episode) AS listed FROM o
""")
def q_any_code_joined(d: Data):
    """A list as long as a table, and keys that repeat or are missing."""
    rows = d.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.nullif(F.col("l_partkey") % 500, F.lit(0)).alias("person"),
        F.nullif(F.col("l_orderkey") % 100, F.lit(0)).alias("episode"), F.lpad(F.col("l_partkey").cast("string"), 9, "0").alias("codes"),
    )
    listed = d.part.filter("p_size > 40").select(F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("code"))
    return any_code(rows, "listed", "codes", listed, ["person", "episode"], lengths=(9,)).drop("person", "episode", "codes")
