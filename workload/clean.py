"""Column cleaning, recodes and dates."""

from pyspark.sql import functions as F

from linkcohort.functions import (
    academic_year, any_true, case_update, count_true, dob_approx, flag_by_pattern, inception_year, nullify,
    nullify_outside, offset_dates, parse_acad_year, recode, zero_where,
)
from linkcohort.operators import flag_by_lookup
from workload import Data, case


@case("""
SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'sized' WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'priced' END AS type_group,
  CASE WHEN lower(trim(split_part(p_name, ' ', 1))) IN ('red', 'blue', 'green') THEN 1 WHEN split_part(p_name, ' ', 1) IN ('small', 'large') THEN 2 END AS look
FROM part
""")
def q_recode(d: Data):
    types = {"sized": ["SMALL", "MEDIUM", "LARGE"], "priced": ["ECONOMY", "PROMO"]}
    looks = {1: ["red", "blue", "green"], 2: ["small", "large"]}
    word = F.upper(F.substring_index("p_name", " ", 1))
    return d.part.select(
        "p_partkey", recode("p_type", types).alias("type_group"), recode(word, looks, normalise=True).alias("look")
    )


@case("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_quantity BETWEEN 5 AND 45 THEN l_quantity END AS quantity,
  CASE WHEN l_extendedprice >= 2000 THEN l_extendedprice END AS price,
  nullif(l_returnflag, 'N') AS returnflag, CASE WHEN l_tax NOT IN (0.0, 0.08) THEN l_tax END AS tax
FROM lineitem
""")
def q_nullify(d: Data):
    return d.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        nullify_outside("l_quantity", 5, 45).alias("quantity"), nullify_outside("l_extendedprice", 2000).alias("price"),
        nullify("l_returnflag", ["N"]).alias("returnflag"), nullify("l_tax", [0.0, 0.08]).alias("tax"),
    )


@case("""
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'now' WHEN o_totalprice > 300000 THEN 'big' ELSE o_orderstatus END AS handling
FROM orders
""")
def q_case_update(d: Data):
    updates = [(F.col("o_totalprice") > 300000, "big"), (F.col("o_orderpriority") == "1-URGENT", "now")]
    return d.orders.select("o_orderkey", case_update("o_orderstatus", updates).alias("handling"))


@case("""
SELECT o_orderkey, CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 9 THEN 1 ELSE 0 END AS INTEGER) AS academic_year,
  CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 9 THEN 1 ELSE 0 END + 12 AS INTEGER) AS y7_year,
  CAST(year(o_orderdate) + 1 AS INTEGER) AS parsed_year
FROM orders
""")
def q_acad_year(d: Data):
    text = F.concat_ws("/", F.year("o_orderdate"), F.year("o_orderdate") + 1)
    year = academic_year("o_orderdate")
    return d.orders.select(
        "o_orderkey", year.alias("academic_year"), inception_year(year).alias("y7_year"), parse_acad_year(text).alias("parsed_year")
    )


@case("""
SELECT o_orderkey, make_date(CAST(year(o_orderdate) AS BIGINT), CAST(month(o_orderdate) AS BIGINT), 15) AS dob_approx FROM orders
""")
def q_dob(d: Data):
    raw = F.concat(F.month("o_orderdate").cast("string"), F.year("o_orderdate").cast("string"))
    return d.orders.select("o_orderkey", dob_approx(raw).alias("dob_approx"))


@case("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) + 365 AS day_plus_365_days,
  CAST(o_orderdate AS DATE) + 730 AS day_plus_730_days, pow(CAST(year(o_orderdate) - 1990 AS DOUBLE), 2) AS year_sq
FROM orders WHERE o_orderstatus = 'F'
""")
def q_offset_dates(d: Data):
    rows = d.orders.filter(F.col("o_orderstatus") == "F").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"),
        F.pow((F.year("o_orderdate") - 1990).cast("double"), F.lit(2.0)).alias("year_sq"),
    )
    return offset_dates(rows, "day", range(365, 731, 365))


@case("""
SELECT o_orderkey, o_orderpriority = '1-URGENT' OR nullif(o_orderstatus, 'P') = 'F' OR o_totalprice > 400000 AS any_flag,
  CAST(o_orderpriority = '1-URGENT' AS INTEGER) + CAST(nullif(o_orderstatus, 'P') = 'F' AS INTEGER) + CAST(o_totalprice > 400000 AS INTEGER) AS n_flags
FROM orders
""")
def q_flag_algebra(d: Data):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    flags = [F.col("o_orderpriority") == "1-URGENT", status == "F", F.col("o_totalprice") > 400000]
    return d.orders.select("o_orderkey", any_true(flags).alias("any_flag"), count_true(flags).alias("n_flags"))


@case("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS l_quantity,
  CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice END AS l_extendedprice FROM lineitem
""")
def q_zero_where(d: Data):
    rows = zero_where(d.lineitem, ["l_quantity", "l_extendedprice"], F.col("l_returnflag") == "R")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@case("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN p.p_partkey IS NOT NULL THEN TRUE END AS special
FROM lineitem l LEFT JOIN part p
  ON p.p_partkey = l.l_partkey AND (lower(p.p_type) LIKE '%promo%' OR lower(p.p_type) LIKE '%economy%' OR lower(p.p_name) LIKE '%ring%')
""")
def q_flag_by_lookup(d: Data):
    special = flag_by_pattern("promo|economy", "p_type") | flag_by_pattern("ring", "p_name")
    lookup = d.part.withColumn("l_partkey", F.col("p_partkey"))
    rows = d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return flag_by_lookup(rows, lookup, "l_partkey", special, "special")


@case("""
SELECT l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
""")
def q_sorted(d: Data):
    rows = d.lineitem.select("l_returnflag", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    # the further columns break ties, and let one hot (flag, day) spread over ranges
    return rows.orderBy("l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
