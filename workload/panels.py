"""Panels by year, per-person windows, sums and rates."""

from pyspark.sql import functions as F

from linkcohort.functions import zero_where
from linkcohort.operators import (
    annualise, around_event, collapse_sum, dcast, melt, rates, school_year_panel, within_school_window, within_window,
)
from workload import Data, case


def _first_year(d: Data, plus: int = 0):
    return d.orders.groupBy("o_custkey").agg((F.min(F.year("o_orderdate")) + plus).alias("y7_year"))


@case("""
WITH s AS (SELECT o_custkey, min(year(o_orderdate)) AS y7_year FROM orders GROUP BY 1)
SELECT o.o_orderkey, o.o_custkey, CAST(year(o.o_orderdate) - (s.y7_year - 7) AS INTEGER) AS year
FROM orders o JOIN s ON s.o_custkey = o.o_custkey WHERE year(o.o_orderdate) - (s.y7_year - 7) BETWEEN 8 AND 11
""")
def q_school_panel(d: Data):
    rows = d.orders.withColumn("academicyear", F.year("o_orderdate"))
    panel = school_year_panel(rows, _first_year(d), "o_custkey", "academicyear", 8, 11)
    return panel.select("o_orderkey", "o_custkey", "year")


def _window_sql(end: str) -> str:
    return f"""
WITH s AS (SELECT o_custkey, CAST(min(year(o_orderdate)) AS BIGINT) + 2 AS y7 FROM orders GROUP BY 1)
SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS day FROM orders o JOIN s ON s.o_custkey = o.o_custkey
WHERE o.o_orderdate >= make_date(s.y7 - 2, 9, 1) AND o.o_orderdate {end} make_date(s.y7, 8, 31)
"""


def _window(d: Data, inclusive: bool):
    rows = d.orders.withColumn("day", F.col("o_orderdate").cast("date"))
    kept = within_school_window(rows, _first_year(d, 2), "o_custkey", "day", 2, 0, end_inclusive=inclusive)
    return kept.select("o_orderkey", "day")


@case(_window_sql("<"))
def q_window(d: Data):
    return _window(d, False)


@case(_window_sql("<="))
def q_window_inclusive(d: Data):
    return _window(d, True)


@case("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_shipdate >= DATE '1996-09-01' AND l_shipdate < DATE '1998-09-01'
""")
def q_fixed_window(d: Data):
    rows = within_window(d.lineitem, "l_shipdate", F.lit("1996-09-01").cast("timestamp_ntz"), F.lit("1998-09-01").cast("timestamp_ntz"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@case("""
WITH i AS (SELECT user_id, CAST(min(ts) AS DATE) AS bought FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT e.event_id, e.user_id, i.bought FROM events e JOIN i ON i.user_id = e.user_id
WHERE CAST(e.ts AS DATE) BETWEEN i.bought - 2 AND i.bought + 5
""")
def q_around_event(d: Data):
    day = d.events.withColumn("day", F.col("ts").cast("date"))
    index = day.filter(F.col("event_type") == "purchase").groupBy("user_id").agg(F.min("day").alias("bought"))
    return around_event(day, index, "user_id", "day", "bought", 2, 5).select("event_id", "user_id", "bought")


@case("""
SELECT user_id, CAST((day(ts) - 1) // 7 AS INTEGER) AS week, count(*) FILTER (WHERE event_type = 'click') AS clicks,
  count(*) FILTER (WHERE event_type = 'error') AS errors,
  CAST(coalesce(sum(CAST(round(value) AS BIGINT)) FILTER (WHERE event_type = 'purchase'), 0) AS BIGINT) AS spent
FROM events GROUP BY 1, 2
""")
def q_collapse_sum(d: Data):
    kind = F.col("event_type")
    rows = d.events.select(
        "user_id", ((F.dayofmonth("ts") - 1) / 7).cast("int").alias("week"),
        F.when(kind == "click", F.lit(1)).alias("clicks"), F.when(kind == "error", F.lit(1)).alias("errors"),
        F.when(kind == "purchase", F.round("value").cast("long")).alias("spent"),
    )
    return collapse_sum(rows, ["user_id", "week"], ["clicks", "errors", "spent"])


ABSENCE_SQL = """
WITH e AS (SELECT user_id, CAST(7 + (day(ts) - 1) // 7 AS INTEGER) AS year, hour(ts) % 2 AS half, event_type FROM events),
w AS (SELECT user_id, year, sum(CASE WHEN half = 0 THEN 7 ELSE 0 END) AS p_aut, sum(CASE WHEN half = 1 THEN 7 ELSE 0 END) AS p_sum,
      sum(CASE WHEN half = 0 AND event_type = 'error' THEN 3 ELSE 0 END) AS m_aut, sum(CASE WHEN half = 1 AND event_type = 'error' THEN 3 ELSE 0 END) AS m_sum
      FROM e GROUP BY 1, 2),
z AS (SELECT user_id, year, p_aut + CASE WHEN year = 11 THEN 0 ELSE p_sum END AS possible, m_aut + CASE WHEN year = 11 THEN 0 ELSE m_sum END AS missed FROM w)
SELECT user_id, year, CAST(possible AS BIGINT) AS possible_annual, CAST(missed AS BIGINT) AS missed_annual,
  CASE WHEN possible > 0 THEN round(missed / possible * 100, 1) END AS rate,
  CASE WHEN possible > 0 THEN round(missed / possible * 100, 1) >= 10 END AS persistent
FROM z WHERE possible <= 140
"""


@case(ABSENCE_SQL)
def q_absence_rates(d: Data):
    half, err = F.hour("ts") % 2, F.col("event_type") == "error"
    rows = d.events.select(
        "user_id", (F.lit(7) + ((F.dayofmonth("ts") - 1) / 7).cast("int")).alias("year"),
        F.when(half == 0, 7).alias("possible_aut"), F.when(half == 1, 7).alias("possible_sum"),
        F.when(err & (half == 0), 3).alias("missed_aut"), F.when(err & (half == 1), 3).alias("missed_sum"),
    )
    measures = ["possible_aut", "possible_sum", "missed_aut", "missed_sum"]
    w = collapse_sum(rows, ["user_id", "year"], measures)
    w = zero_where(w, ["possible_sum", "missed_sum"], F.col("year") == 11)
    w = annualise(w, ["possible", "missed"], ["aut", "sum"]).filter(F.col("possible_annual") <= 140)
    return rates(w, {"rate": "missed_annual"}, "possible_annual").withColumn("persistent", F.col("rate") >= 10)


@case("""
SELECT user_id, week, kind, n FROM (
  SELECT user_id, CAST((day(ts) - 1) // 7 AS INTEGER) AS week, count(*) FILTER (WHERE event_type = 'click') AS click,
    count(*) FILTER (WHERE event_type = 'view') AS "view", nullif(count(*) FILTER (WHERE event_type = 'error'), 0) AS error
  FROM events GROUP BY 1, 2) UNPIVOT (n FOR kind IN (click, "view", error))
""")
def q_melt(d: Data):
    wide = d.events.groupBy("user_id", ((F.dayofmonth("ts") - 1) / 7).cast("int").alias("week")).agg(
        F.count_if(F.col("event_type") == "click").alias("click"), F.count_if(F.col("event_type") == "view").alias("view"),
        F.nullif(F.count_if(F.col("event_type") == "error"), F.lit(0)).alias("error"),
    )
    return melt(wide, ["user_id", "week"], ["click", "view", "error"], "kind", "n")


@case("""
WITH w AS (SELECT user_id, (day(ts) - 1) // 7 AS week, count(*) AS n, max(value) AS top FROM events GROUP BY 1, 2)
SELECT user_id, max(n) FILTER (WHERE week = 0) AS n_0, max(n) FILTER (WHERE week = 1) AS n_1, max(n) FILTER (WHERE week = 2) AS n_2, max(n) FILTER (WHERE week = 3) AS n_3, max(n) FILTER (WHERE week = 4) AS n_4,
  max(top) FILTER (WHERE week = 0) AS top_0, max(top) FILTER (WHERE week = 1) AS top_1, max(top) FILTER (WHERE week = 2) AS top_2, max(top) FILTER (WHERE week = 3) AS top_3, max(top) FILTER (WHERE week = 4) AS top_4
FROM w GROUP BY 1
""")
def q_dcast(d: Data):
    w = d.events.groupBy("user_id", ((F.dayofmonth("ts") - 1) / 7).cast("int").alias("week")).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("top")
    )
    return dcast(w, ["user_id"], "week", range(5), ["n", "top"])
