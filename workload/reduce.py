"""Reductions to one row per person (customers and their orders)."""

from pyspark.sql import functions as F

from linkcohort.functions import max_or_null
from linkcohort.operators import (
    any_in_group, bound_state, collapse_intervals, count_state, dense_rank_in, ever, first_clear_event, first_date, first_per, highest, latest,
    merge_bounds, merge_counts, modal, modes_of, number_rows, pooled_modal, resolve, run_id, weighted_modal,
)
from linkcohort.sources import save_step
from workload import Data, case

ORDER = ["o_orderdate", "o_orderkey"]


@case("""
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS first_order, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1
""")
def q_first_per(d: Data):
    first = first_per(d.orders, "o_custkey", ORDER)
    return first.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("first_order"), "o_orderpriority")


@case("""
SELECT o_custkey, o_orderpriority, o_orderstatus
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1
""")
def q_latest(d: Data):
    return latest(d.orders, "o_custkey", ["o_orderpriority", "o_orderstatus"], ORDER)


def _mode_sql(v: str) -> str:
    return f"""
  SELECT o_custkey, {v} FROM (
    SELECT o_custkey, {v}, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, {v}) AS rn
    FROM o WHERE {v} IS NOT NULL GROUP BY o_custkey, {v}) WHERE rn = 1"""


NULLED = "SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, nullif(o_orderpriority, '3-MEDIUM') AS o_orderpriority FROM orders"


@case(f"""
WITH o AS ({NULLED}), p AS ({_mode_sql('o_orderpriority')}), s AS ({_mode_sql('o_orderstatus')})
SELECT k.o_custkey, p.o_orderpriority, s.o_orderstatus
FROM (SELECT DISTINCT o_custkey FROM o) k
LEFT JOIN p ON p.o_custkey = k.o_custkey LEFT JOIN s ON s.o_custkey = k.o_custkey
""")
def q_modal(d: Data):
    return modal(_nulled(d), "o_custkey", ["o_orderpriority", "o_orderstatus"])


def _nulled(d: Data):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("o_orderpriority")
    return d.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", priority)


@case(f"""
WITH o AS ({NULLED}),
counts AS (SELECT o_custkey, o_orderpriority AS v, count(*) AS n FROM o WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2),
top AS (SELECT o_custkey, min(v) AS v, count(*) AS ties FROM counts c
        WHERE n = (SELECT max(n) FROM counts x WHERE x.o_custkey = c.o_custkey) GROUP BY 1),
lasts AS (SELECT o_custkey, o_orderpriority AS v FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM o WHERE o_orderpriority IS NOT NULL) WHERE rn = 1)
SELECT k.o_custkey, CASE WHEN t.ties = 1 THEN t.v ELSE l.v END AS o_orderpriority
FROM (SELECT DISTINCT o_custkey FROM o) k
LEFT JOIN top t ON t.o_custkey = k.o_custkey LEFT JOIN lasts l ON l.o_custkey = k.o_custkey
""")
def q_modal_last(d: Data):
    return modal(_nulled(d), "o_custkey", ["o_orderpriority"], "last", ORDER)


@case(f"""
WITH o AS ({NULLED}), n AS (SELECT o_custkey, o_orderpriority AS v, count(*) AS n FROM o WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, md5(concat_ws('|', o_custkey, v, 100)), v) AS rn FROM n)
SELECT k.o_custkey, r.v AS o_orderpriority FROM (SELECT DISTINCT o_custkey FROM o) k LEFT JOIN r ON r.o_custkey = k.o_custkey AND r.rn = 1
""")
def q_modal_hash(d: Data):
    return modal(_nulled(d), "o_custkey", ["o_orderpriority"], "hash", seed=100)


FLAGGED = """SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
  WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS urgent FROM orders"""


def _flagged(d: Data):
    unknown = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    urgent = F.when(unknown, None).when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)
    return d.orders.select("o_custkey", "o_orderkey", urgent.alias("urgent"))


@case(f"SELECT o_custkey, max(urgent) AS urgent FROM ({FLAGGED}) GROUP BY 1")
def q_ever(d: Data):
    return ever(_flagged(d), "o_custkey", ["urgent"])


@case(f"""
SELECT o_custkey, CASE WHEN count(*) = count(urgent) THEN max(urgent) END AS urgent FROM ({FLAGGED}) GROUP BY 1
""")
def q_ever_strict(d: Data):
    return ever(_flagged(d), "o_custkey", ["urgent"], strict_nulls=True)


@case("""
SELECT o_custkey, CASE max(CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 ELSE 0 END)
  WHEN 3 THEN 'Urgent' WHEN 2 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'None' END AS highest_priority
FROM orders GROUP BY 1
""")
def q_highest(d: Data):
    p = F.col("o_orderpriority")
    levels = [("Medium", p == "3-MEDIUM"), ("High", p == "2-HIGH"), ("Urgent", p == "1-URGENT")]
    return highest(d.orders, "o_custkey", levels, "highest_priority", "None")


YEARLY = "SELECT o_custkey * 10000 + year(o_orderdate) AS person_year, o_orderkey, o_orderstatus, o_orderpriority FROM orders"


def _yearly(d: Data):
    key = (F.col("o_custkey") * 10000 + F.year("o_orderdate")).alias("person_year")
    return d.orders.select(key, "o_orderkey", "o_orderstatus", "o_orderpriority")


@case(f"""
WITH o AS ({YEARLY})
SELECT person_year,
  CASE WHEN count(DISTINCT o_orderstatus) <= 1 THEN min(o_orderstatus) END AS o_orderstatus,
  CASE WHEN count(DISTINCT o_orderpriority) <= 1 THEN min(o_orderpriority) ELSE min_by(o_orderpriority, o_orderkey) END AS o_orderpriority
FROM o GROUP BY 1
""")
def q_resolve(d: Data):
    policy = {"o_orderstatus": "null", "o_orderpriority": "first"}
    return resolve(_yearly(d), "person_year", list(policy), policy, ["o_orderkey"])


@case(f"""
WITH o AS ({YEARLY})
SELECT person_year, min(o_orderstatus) AS o_orderstatus, min(o_orderpriority) AS o_orderpriority FROM o
GROUP BY 1 HAVING count(DISTINCT o_orderstatus) <= 1 AND count(DISTINCT o_orderpriority) <= 1
""")
def q_resolve_drop(d: Data):
    return resolve(_yearly(d), "person_year", ["o_orderstatus", "o_orderpriority"], "drop")


@case("""
SELECT o_orderkey, o_custkey, bool_or(o_orderpriority = '1-URGENT') OVER (PARTITION BY o_custkey) AS any_urgent,
  bool_or(o_totalprice > 450000) OVER (PARTITION BY o_custkey) AS any_large
FROM orders
""")
def q_any_in_group(d: Data):
    flags = {"any_urgent": F.col("o_orderpriority") == "1-URGENT", "any_large": F.col("o_totalprice") > 450000}
    return any_in_group(d.orders, "o_custkey", flags).select("o_orderkey", "o_custkey", "any_urgent", "any_large")


@case("""
SELECT user_id, CAST(min(ts) FILTER (WHERE event_type = 'purchase') AS DATE) AS first_purchase, CAST(min(ts) AS DATE) AS first_seen
FROM events GROUP BY 1
""")
def q_first_contact(d: Data):
    day = d.events.withColumn("day", F.col("ts").cast("date"))
    bought = first_date(day, "user_id", "day", "first_purchase", F.col("event_type") == "purchase")
    return bought.join(first_date(day, "user_id", "day", "first_seen"), "user_id")


@case("""
SELECT o_custkey, max(round(o_totalprice / 10000, 1)) AS att8, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS passed,
  CASE WHEN count(*) = count(nullif(o_orderpriority, '5-LOW')) THEN max(o_orderpriority) END AS grade
FROM orders GROUP BY 1
""")
def q_exam_max(d: Data):
    o = d.orders.withColumns({
        "att8": F.round(F.col("o_totalprice") / 10000, 1),
        "passed": F.when(F.col("o_orderstatus") == "F", 1).otherwise(0),
        "grade": F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
    })
    return ever(o, "o_custkey", ["att8", "passed"]).join(ever(o, "o_custkey", ["grade"], True), "o_custkey")


@case("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS day, l_extendedprice,
  CAST(dense_rank() OVER (PARTITION BY l_suppkey ORDER BY CAST(l_shipdate AS DATE)) AS INTEGER) AS day_n
FROM lineitem
""")
def q_dense_rank(d: Data):
    rows = d.lineitem.withColumn("day", F.col("l_shipdate").cast("date"))
    return dense_rank_in(rows, "l_suppkey", "day", "day_n").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "day", "l_extendedprice", "day_n"
    )


@case("""
SELECT o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS order_n
FROM orders
""")
def q_row_number(d: Data):
    rows = d.orders.withColumn("day", F.col("o_orderdate").cast("date"))
    return number_rows(rows, "o_custkey", "day", "o_orderkey", "order_n").select("o_orderkey", "o_custkey", "order_n")


@case("""
WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderkey * CASE WHEN o_orderkey % 2 = 0 THEN 10000000000000 ELSE -10000000000000 END AS id FROM orders)
SELECT id, o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY day, id) AS INTEGER) AS order_n FROM o
""")
def q_row_number_wide(d: Data):
    """Ids from end to end of the 64-bit numbers; whole decimals where the keys are so large that an id is beyond them."""
    least, most = d.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    fits = max(abs(least or 0), abs(most or 0)) * 10**13 < 2**63
    key = F.col("o_orderkey").cast("long" if fits else "decimal(20,0)")
    sign = F.when(F.col("o_orderkey") % 2 == 0, F.lit(10**13)).otherwise(F.lit(-(10**13)))
    rows = d.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), (key * sign).cast("long" if fits else "decimal(38,0)").alias("id"))
    return number_rows(rows, "o_custkey", "day", "id", "order_n").select("id", "o_custkey", "order_n")


@case("""
WITH days AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, min(o_orderstatus) AS v FROM orders GROUP BY 1, 2),
runs AS (SELECT *, CASE WHEN v = lag(v) OVER (PARTITION BY o_custkey ORDER BY day) THEN 0 ELSE 1 END AS new_run FROM days),
ids AS (SELECT o_custkey, day, CAST(sum(new_run) OVER (PARTITION BY o_custkey ORDER BY day) AS INTEGER) AS run FROM runs)
SELECT o.o_orderkey, o.o_custkey, i.run FROM orders o JOIN ids i ON i.o_custkey = o.o_custkey AND i.day = CAST(o.o_orderdate AS DATE)
""")
def q_run_id(d: Data):
    rows = d.orders.withColumn("day", F.col("o_orderdate").cast("date"))
    return run_id(rows, "o_custkey", "day", "o_orderstatus", "run").select("o_orderkey", "o_custkey", "run")


@case("""
WITH both_sources AS (
  SELECT o_custkey AS person, o_orderstatus AS v FROM orders
  UNION ALL SELECT l_suppkey AS person, l_linestatus AS v FROM lineitem),
counts AS (SELECT person, v, count(*) AS n FROM both_sources GROUP BY 1, 2)
SELECT person, v FROM (SELECT *, row_number() OVER (PARTITION BY person ORDER BY n DESC, v) AS rn FROM counts) WHERE rn = 1
""")
def q_pooled_modal(d: Data):
    a = d.orders.select(F.col("o_custkey").alias("person"), F.col("o_orderstatus").alias("v"))
    b = d.lineitem.select(F.col("l_suppkey").alias("person"), F.col("l_linestatus").alias("v"))
    return pooled_modal([a, b], "person", ["v"])


@case("""
WITH w AS (SELECT o_custkey, o_orderpriority AS v, sum(CAST(year(o_orderdate) AS BIGINT) - 1991) AS s FROM orders WHERE o_orderpriority <> '3-MEDIUM' GROUP BY 1, 2),
t AS (SELECT o_custkey, o_orderstatus AS v, sum(CAST(year(o_orderdate) AS BIGINT) - 1991) AS s FROM orders GROUP BY 1, 2)
SELECT k.o_custkey, a.v AS priority, b.v AS status FROM (SELECT DISTINCT o_custkey FROM orders) k
LEFT JOIN (SELECT o_custkey, v FROM w QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY s DESC, v) = 1) a ON a.o_custkey = k.o_custkey
LEFT JOIN (SELECT o_custkey, v FROM t QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY s DESC, v) = 1) b ON b.o_custkey = k.o_custkey
""")
def q_weighted_modal(d: Data):
    """Later records are better evidence."""
    rows = d.orders.select(
        "o_custkey", F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("priority"), F.col("o_orderstatus").alias("status"), (F.year("o_orderdate") - 1991).alias("weight"),
    )
    return weighted_modal(rows, "o_custkey", ["priority", "status"], "weight")


@case("""
WITH days AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
seen AS (SELECT *, lag(day) OVER (PARTITION BY o_custkey ORDER BY day) AS before FROM days)
SELECT o_custkey, min(day) AS index_date FROM seen
WHERE day >= DATE '1994-01-01' AND day < DATE '1997-01-01' AND (before IS NULL OR day - before > 120) GROUP BY 1
""")
def q_first_clear_event(d: Data):
    rows = d.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return first_clear_event(rows, "o_custkey", "day", 120, F.lit("1994-01-01").cast("date"), F.lit("1997-01-01").cast("date"))


def _early_and_late(d: Data):
    early = F.year("o_orderdate") <= 1996
    return d.orders.filter(early), d.orders.filter(~early)


@case(f"""
SELECT k.o_custkey, a.o_orderpriority, b.o_shippriority FROM (SELECT DISTINCT o_custkey FROM orders) k
LEFT JOIN (SELECT o_custkey, o_orderpriority FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority <> '3-MEDIUM' GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) = 1) a ON a.o_custkey = k.o_custkey
LEFT JOIN (SELECT o_custkey, o_shippriority FROM (SELECT o_custkey, CAST(o_orderkey % 5 AS BIGINT) AS o_shippriority, count(*) AS n FROM orders GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_shippriority) = 1) b ON b.o_custkey = k.o_custkey
""")
def q_refresh_modal(d: Data):
    """Modes of all years from the stored counts of the first and those of the extract that came later."""
    def counts(rows):
        rows = rows.select("o_custkey", F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("o_orderpriority"), (F.col("o_orderkey") % 5).alias("o_shippriority"))
        return count_state(rows, "o_custkey", ["o_orderpriority", "o_shippriority"])

    early, late = _early_and_late(d)
    return modes_of(merge_counts(_stored(d, counts(early)), counts(late)), "o_custkey", {"o_orderpriority": "string", "o_shippriority": "bigint"})


@case("""
SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS day_least, CAST(max(o_orderdate) AS DATE) AS day_greatest, min(o_totalprice) AS o_totalprice_least,
  max(o_totalprice) AS o_totalprice_greatest, bool_or(o_orderpriority = '1-URGENT') AS ever_urgent FROM orders GROUP BY 1
""")
def q_refresh_bounds(d: Data):
    """First and last days, extremes and flags, old years stored, the new merged in."""
    def bounds(rows):
        rows = rows.withColumn("day", F.col("o_orderdate").cast("date"))
        return bound_state(rows, "o_custkey", ["day", "o_totalprice"], {"ever_urgent": F.col("o_orderpriority") == "1-URGENT"})

    early, late = _early_and_late(d)
    return merge_bounds(_stored(d, bounds(early)), bounds(late))


def _stored(d: Data, state):
    from workload.study import folder

    return save_step(state, "state", folder(d))


@case("""
WITH i AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS opened, CASE WHEN o_orderkey % 97 > 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 150 AS INTEGER) - 5 END AS closed FROM orders),
e AS (SELECT o_custkey, opened, greatest(coalesce(closed, DATE '9999-12-31'), opened) AS til FROM i),
w AS (SELECT *, CASE WHEN opened <= max(til) OVER (PARTITION BY o_custkey ORDER BY opened, til ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 3 THEN 0 ELSE 1 END AS opens FROM e),
p AS (SELECT *, sum(opens) OVER (PARTITION BY o_custkey ORDER BY opened, til ROWS UNBOUNDED PRECEDING) AS k FROM w)
SELECT o_custkey, min(opened) AS opened, nullif(max(til), DATE '9999-12-31') AS closed, count(*) AS n FROM p GROUP BY o_custkey, k
""")
def q_collapse_intervals(d: Data):
    rows = d.orders.select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("opened"),
        F.when(F.col("o_orderkey") % 97 > 0, F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 150 - 5).cast("int"))).alias("closed"),
    )
    return collapse_intervals(rows, "o_custkey", "opened", "closed", gap=3)
