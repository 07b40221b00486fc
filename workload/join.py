"""Joins onto a spine of customers."""

from pyspark.sql import functions as F

from linkcohort.operators import (
    add_new_members, attach, eligibility, exists_summary, fill_from, first_per, flag_exists, flags_by_group, link,
    linkage_report, restrict_to,
)
from linkcohort.functions import any_true, count_true
from workload import Data, case


@case("""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def q_restrict(d: Data):
    ids = d.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return restrict_to(d.orders, ids, "o_custkey").select("o_orderkey", "o_custkey")


@case("""
WITH spine AS (SELECT o_custkey AS person, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
extra AS (SELECT l_suppkey AS person, CAST(min(year(l_shipdate)) AS INTEGER) AS first_year FROM lineitem
          WHERE l_suppkey NOT IN (SELECT person FROM spine) GROUP BY 1)
SELECT * FROM spine UNION ALL SELECT * FROM extra
""")
def q_anti_add(d: Data):
    urgent = d.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    spine = urgent.groupBy(F.col("o_custkey").alias("person")).agg(F.min(F.year("o_orderdate")).alias("first_year"))
    extra = d.lineitem.select(F.col("l_suppkey").alias("person"), F.year("l_shipdate").alias("first_year"))
    return add_new_members(spine, extra, "person", ["first_year"])


FLAG_SQL = """
WITH spine AS (SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN NULL ELSE c_custkey END AS person FROM customer),
f AS (SELECT o_custkey AS person, bool_or(o_orderpriority = '1-URGENT') AS ever_urgent, bool_or(o_orderstatus = 'P') AS ever_pending,
      bool_or(year(o_orderdate) = 1996) AS in_1996, bool_or(year(o_orderdate) = 1997) AS in_1997 FROM orders GROUP BY 1),
j AS (SELECT s.c_custkey, s.person, CASE WHEN s.person IS NOT NULL THEN coalesce(ever_urgent, FALSE) END AS ever_urgent,
      CASE WHEN s.person IS NOT NULL THEN coalesce(ever_pending, FALSE) END AS ever_pending,
      CASE WHEN s.person IS NOT NULL THEN NOT coalesce(in_1996, FALSE) END AS not_in_1996,
      CASE WHEN s.person IS NOT NULL THEN NOT coalesce(in_1997, FALSE) END AS not_in_1997
      FROM spine s LEFT JOIN f ON f.person = s.person)
SELECT c_custkey, ever_urgent, ever_pending, not_in_1996, not_in_1997, not_in_1996 OR not_in_1997 AS ever_missing,
  CAST(not_in_1996 AS INTEGER) + CAST(not_in_1997 AS INTEGER) AS n_missing FROM j
"""


@case(FLAG_SQL)
def q_flags(d: Data):
    spine = d.customer.select("c_custkey", F.when(F.col("c_nationkey") != 3, F.col("c_custkey")).alias("person"))
    orders = d.orders.withColumnRenamed("o_custkey", "person")
    year = F.year("o_orderdate")
    flags = {
        "ever_urgent": F.col("o_orderpriority") == "1-URGENT", "ever_pending": F.col("o_orderstatus") == "P",
        "not_in_1996": year == 1996, "not_in_1997": year == 1997,
    }
    missing = ["not_in_1996", "not_in_1997"]
    out = flag_exists(spine, orders, "person", flags, negate=missing).drop("person")
    return out.withColumns({"ever_missing": any_true(missing), "n_missing": count_true(missing)})


BRIDGE_SQL = """SELECT o_custkey AS pmr, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey - o_orderkey % 2 END AS tpid FROM orders"""


def _bridge(d: Data):
    token = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey") - F.col("o_orderkey") % 2)
    return d.orders.select(F.col("o_custkey").alias("pmr"), token.alias("tpid"))


def _spine(d: Data):
    return d.customer.select(F.col("c_custkey").alias("pmr"), "c_mktsegment")


LINK_SQL = f"""
WITH spine AS (SELECT c_custkey AS pmr, c_mktsegment FROM customer), bridge AS ({BRIDGE_SQL}),
by_token AS (SELECT tpid, min(pmr) AS pmr FROM bridge WHERE tpid IS NOT NULL AND pmr IN (SELECT pmr FROM spine) GROUP BY 1),
one AS (SELECT pmr, min(tpid) AS tpid FROM by_token GROUP BY 1)
"""


@case(LINK_SQL + "SELECT s.pmr, s.c_mktsegment, o.tpid FROM spine s LEFT JOIN one o ON o.pmr = s.pmr")
def q_link(d: Data):
    return link(_spine(d), _bridge(d), "pmr", "tpid")


@case(LINK_SQL + "SELECT s.pmr, s.c_mktsegment, b.tpid FROM spine s LEFT JOIN by_token b ON b.pmr = s.pmr")
def q_link_fan_out(d: Data):
    return link(_spine(d), _bridge(d), "pmr", "tpid", ["tpid"])


@case(LINK_SQL + """
SELECT s.c_mktsegment, count(*) AS n, count(o.tpid) AS n_linked, count(DISTINCT o.tpid) AS n_distinct,
  round(count(o.tpid) * 100.0 / count(*), 1) AS pct_linked
FROM spine s LEFT JOIN one o ON o.pmr = s.pmr GROUP BY 1
""")
def q_linkage_report(d: Data):
    report = linkage_report(link(_spine(d), _bridge(d), "pmr", "tpid"), "tpid", ["c_mktsegment"])
    return report.withColumn("pct_linked", F.col("pct_linked").cast("double"))


@case("""
WITH o AS (SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS largest FROM orders GROUP BY 1),
f AS (SELECT o_custkey, o_orderkey AS first_key FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
      FROM orders WHERE o_orderpriority = '1-URGENT') WHERE rn = 1)
SELECT c.c_custkey, c.c_mktsegment, coalesce(o.n_orders, 0) AS n_orders, o.largest, f.first_key
FROM customer c LEFT JOIN o ON o.o_custkey = c.c_custkey LEFT JOIN f ON f.o_custkey = c.c_custkey
""")
def q_attach(d: Data):
    orders = d.orders.withColumnRenamed("o_custkey", "c_custkey")
    totals = orders.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("largest"))
    urgent = first_per(orders.filter(F.col("o_orderpriority") == "1-URGENT"), "c_custkey", ["o_orderdate", "o_orderkey"])
    urgent = urgent.select("c_custkey", F.col("o_orderkey").alias("first_key"))
    return attach(d.customer.select("c_custkey", "c_mktsegment"), "c_custkey", totals, urgent, fill={"n_orders": 0})


@case("""
WITH e AS (SELECT user_id, bool_or(event_type = 'click') AS ever_click, bool_or(event_type = 'error') AS ever_error,
           bool_or(event_type = 'purchase') AS ever_purchase FROM events WHERE value > 20 GROUP BY 1)
SELECT c.c_custkey AS user_id, coalesce(ever_click, FALSE) AS ever_click, coalesce(ever_error, FALSE) AS ever_error,
  coalesce(ever_purchase, FALSE) AS ever_purchase
FROM customer c LEFT JOIN e ON e.user_id = c.c_custkey
""")
def q_flags_by_group(d: Data):
    spine = d.customer.select(F.col("c_custkey").alias("user_id"))
    return flags_by_group(spine, d.events, "user_id", "event_type", ["click", "error", "purchase"], "ever_", F.col("value") > 20)


@case("""
WITH p AS (SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN NULL ELSE c_custkey END AS tpid, min(CAST(o_orderdate AS DATE)) FILTER (WHERE o_orderstatus = 'F') AS dob
           FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT c_custkey, dob >= DATE '1995-09-01' AND dob < DATE '1996-09-01' AS born_in_year,
  tpid IS NOT NULL AND dob >= DATE '1995-09-01' AND dob < DATE '1996-09-01' AS eligible FROM p
""")
def q_eligibility(d: Data):
    spine = d.customer.select("c_custkey", F.when(F.col("c_nationkey") != 3, F.col("c_custkey")).alias("tpid"))
    done = d.orders.filter(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("c_custkey"))
    people = attach(spine, "c_custkey", done.agg(F.min(F.col("o_orderdate").cast("date")).alias("dob")))
    lo, hi = F.make_date(F.lit(1995), F.lit(9), F.lit(1)), F.make_date(F.lit(1996), F.lit(9), F.lit(1))
    return eligibility(people, "tpid", "dob", lo, hi).select("c_custkey", "born_in_year", "eligible")


@case("""
WITH a AS (SELECT o_custkey AS person, min(o_orderstatus) AS status FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
b AS (SELECT l_suppkey AS person, max(l_linestatus) AS status FROM lineitem GROUP BY 1)
SELECT c.c_custkey AS person, a.status <> b.status AS status_differs, coalesce(a.status, b.status) AS status
FROM customer c LEFT JOIN a ON a.person = c.c_custkey LEFT JOIN b ON b.person = c.c_custkey
""")
def q_fill_from(d: Data):
    urgent = d.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    a = urgent.groupBy(F.col("o_custkey").alias("person")).agg(F.min("o_orderstatus").alias("status"))
    b = d.lineitem.groupBy(F.col("l_suppkey").alias("person")).agg(F.max("l_linestatus").alias("status"))
    people = attach(d.customer.select(F.col("c_custkey").alias("person")), "person", a)
    return fill_from(people, b, "person", ["status"])


@case("""
SELECT o_custkey, coalesce(bool_or(nullif(o_orderstatus, 'P') = 'F' AND o_orderpriority = '1-URGENT'), FALSE) AS permanent,
  coalesce(bool_or(nullif(o_orderstatus, 'P') = 'O'), FALSE) AS fixed_term FROM orders GROUP BY 1
""")
def q_exists_split(d: Data):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    flags = {"permanent": (status == "F") & (F.col("o_orderpriority") == "1-URGENT"), "fixed_term": status == "O"}
    return exists_summary(d.orders, "o_custkey", flags)
