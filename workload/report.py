"""Frequency, uniqueness, rule and missingness reports."""

from pyspark.sql import functions as F

from linkcohort.operators import agreement, concordance, linkage_bias, missingness, tabulate, uniqueness, violating, violations
from workload import Data, case


def _nulled(d: Data):
    return d.orders.withColumn("o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("P")))


@case("""
SELECT nullif(o_orderstatus, 'P') AS o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2
""")
def q_tabulate(d: Data):
    return tabulate(_nulled(d), ["o_orderstatus", "o_orderpriority"])


@case("SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_unique FROM orders")
def q_uniqueness(d: Data):
    return uniqueness(d.orders, "o_custkey")


@case("""
SELECT 'ships_after_order' AS rule, count(*) FILTER (WHERE l.l_shipdate < o.o_orderdate) AS n_violations
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
UNION ALL SELECT 'discounted_less_than_taxed', count(*) FILTER (WHERE l.l_discount > l.l_tax) FROM lineitem l
""")
def q_checks(d: Data):
    lines = d.lineitem.join(d.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return violations(lines, {
        "ships_after_order": F.col("l_shipdate") >= F.col("o_orderdate"),
        "discounted_less_than_taxed": F.col("l_discount") <= F.col("l_tax"),
    })


@case("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_discount > l_tax")
def q_violating(d: Data):
    return violating(d.lineitem, F.col("l_discount") <= F.col("l_tax")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@case("""
SELECT 'o_orderstatus' AS "column", count(*) FILTER (WHERE o_orderstatus = 'P') AS n_missing FROM orders
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM orders
""")
def q_missingness(d: Data):
    return missingness(_nulled(d), ["o_orderstatus", "o_orderpriority"])


@case("SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def q_first_rows(d: Data):
    """The first rows in a stated order: a top-k, not a full sort."""
    rows = d.orders.orderBy("o_orderdate", "o_orderkey").limit(100)
    return rows.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))


# Two sources of the same facts, for the customers of two years.
_SIDE = """SELECT o_custkey, max(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END) AS priority, min(o_orderstatus) AS status
  FROM orders WHERE year(o_orderdate) = {} GROUP BY 1"""
_PAIRS = f"""WITH a AS ({_SIDE.format(1995)}), b AS ({_SIDE.format(1996)}),
pairs AS (SELECT v.variable, CASE v.variable WHEN 'priority' THEN a.priority ELSE a.status END AS value_a,
    CASE v.variable WHEN 'priority' THEN b.priority ELSE b.status END AS value_b, count(*) AS n
  FROM a JOIN b ON a.o_custkey = b.o_custkey CROSS JOIN (VALUES ('priority'), ('status')) AS v(variable) GROUP BY 1, 2, 3)"""


def _pairs(d: Data):
    def side(year: int):
        rows = d.orders.filter(F.year("o_orderdate") == year).groupBy("o_custkey")
        return rows.agg(F.max(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))).alias("priority"), F.min("o_orderstatus").alias("status"))

    return concordance(side(1995), side(1996), "o_custkey", ["priority", "status"])


@case(f"{_PAIRS} SELECT * FROM pairs")
def q_concordance(d: Data):
    return _pairs(d)


@case(f"""{_PAIRS},
known AS (SELECT * FROM pairs WHERE value_a IS NOT NULL AND value_b IS NOT NULL),
margins AS (SELECT a.variable, sum(CAST(a.x AS DOUBLE) * b.x) AS chance FROM (SELECT variable, value_a AS v, sum(n) AS x FROM known GROUP BY 1, 2) a
  JOIN (SELECT variable, value_b AS v, sum(n) AS x FROM known GROUP BY 1, 2) b ON a.variable = b.variable AND a.v = b.v GROUP BY 1),
totals AS (SELECT variable, CAST(coalesce(sum(n) FILTER (WHERE value_a IS NOT NULL AND value_b IS NOT NULL), 0) AS BIGINT) AS n_both,
  CAST(coalesce(sum(n) FILTER (WHERE value_a IS NOT NULL AND value_b IS NULL), 0) AS BIGINT) AS n_only_a,
  CAST(coalesce(sum(n) FILTER (WHERE value_a IS NULL AND value_b IS NOT NULL), 0) AS BIGINT) AS n_only_b,
  CAST(coalesce(sum(n) FILTER (WHERE value_a IS NULL AND value_b IS NULL), 0) AS BIGINT) AS n_neither,
  CAST(coalesce(sum(n) FILTER (WHERE value_a = value_b), 0) AS BIGINT) AS n_agree FROM pairs GROUP BY 1)
SELECT t.*, round(n_agree * 100.0 / CAST(n_both AS DOUBLE), 1) AS pct_agree,
  round((CAST(n_agree AS DOUBLE) / n_both - coalesce(chance, 0) / (CAST(n_both AS DOUBLE) * n_both)) / (1 - coalesce(chance, 0) / (CAST(n_both AS DOUBLE) * n_both)), 4) AS kappa
FROM totals t LEFT JOIN margins m ON m.variable = t.variable
""")
def q_agreement(d: Data):
    return agreement(_pairs(d))


@case("""
WITH p AS (SELECT c_custkey, c_acctbal AS balance, c_mktsegment AS segment, CASE WHEN c_custkey % 7 > 0 THEN c_nationkey END AS nation, c_nationkey % 3 = 0 AS linked FROM customer),
numbers AS (SELECT 'balance' AS variable, linked, CAST(balance AS DOUBLE) AS x FROM p UNION ALL SELECT 'nation', linked, CAST(nation AS DOUBLE) FROM p),
m AS (SELECT variable, count(x) FILTER (WHERE linked) AS n_in, count(x) FILTER (WHERE NOT linked) AS n_out, avg(x) FILTER (WHERE linked) AS mean_in,
  avg(x) FILTER (WHERE NOT linked) AS mean_out, var_samp(x) FILTER (WHERE linked) AS v1, var_samp(x) FILTER (WHERE NOT linked) AS v0 FROM numbers GROUP BY 1),
l AS (SELECT segment, count(*) FILTER (WHERE linked) AS n_in, count(*) FILTER (WHERE NOT linked) AS n_out FROM p WHERE segment IS NOT NULL GROUP BY 1),
s AS (SELECT segment, n_in, n_out, CAST(n_in AS DOUBLE) / sum(n_in) OVER () AS mean_in, CAST(n_out AS DOUBLE) / sum(n_out) OVER () AS mean_out FROM l)
SELECT variable, CAST(NULL AS VARCHAR) AS level, n_in, n_out, round(mean_in, 4) AS mean_in, round(mean_out, 4) AS mean_out, round((mean_in - mean_out) / sqrt((v1 + v0) / 2), 4) AS std_diff FROM m
UNION ALL SELECT 'segment', segment, n_in, n_out, round(mean_in, 4), round(mean_out, 4),
  round((mean_in - mean_out) / sqrt((mean_in * (1 - mean_in) + mean_out * (1 - mean_out)) / 2), 4) FROM s
""")
def q_linkage_bias(d: Data):
    """How people who could be linked differ from those who could not."""
    people = d.customer.select(
        F.when(F.col("c_nationkey") % 3 == 0, F.col("c_custkey")).alias("other_id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_custkey") % 7 > 0, F.col("c_nationkey")).alias("nation"),
    )
    return linkage_bias(people, "other_id", ["balance", "nation"], ["segment"])
