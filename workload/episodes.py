"""Episodes from order lines: date repair, spells, length of stay."""

from pyspark.sql import functions as F

from linkcohort.operators import join_spells, los_nights, repair_dates
from workload import Data, case

# An order line is an episode of the customer: admitted on the order date, staying
# up to 230 nights, some lines with dates missing, unknown or the wrong way round.
EPISODE_SQL = """
raw AS (SELECT o.o_custkey AS tpid, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice AS price,
    CAST(o.o_orderdate AS DATE) AS day, CAST(l.l_quantity AS INTEGER) AS q, l.l_returnflag AS rf, l.l_linestatus AS ls
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
dated AS (SELECT *, CASE WHEN rf = 'R' AND l_linenumber = 6 THEN DATE '1801-01-01' ELSE day + l_linenumber END AS epistart,
    CASE WHEN rf = 'A' AND l_linenumber = 5 THEN NULL ELSE day + l_linenumber + q % 11 - 2 END AS epiend,
    CASE WHEN rf = 'N' AND l_linenumber = 4 THEN DATE '1801-01-01' ELSE day END AS admidate,
    CASE WHEN ls = 'F' AND l_linenumber = 3 THEN NULL ELSE day + 5 * q - 20 END AS disdate FROM raw),
known AS (SELECT * REPLACE (nullif(epistart, DATE '1801-01-01') AS epistart, nullif(admidate, DATE '1801-01-01') AS admidate) FROM dated),
full_dates AS (SELECT * REPLACE (coalesce(disdate, epiend) AS disdate) FROM known
  WHERE epistart IS NOT NULL AND epiend IS NOT NULL AND admidate IS NOT NULL),
turned AS (SELECT * REPLACE (CASE WHEN admidate > disdate THEN epiend ELSE epistart END AS epistart,
    CASE WHEN admidate > disdate THEN epistart ELSE epiend END AS epiend,
    CASE WHEN admidate > disdate THEN disdate ELSE admidate END AS admidate,
    CASE WHEN admidate > disdate THEN admidate ELSE disdate END AS disdate) FROM full_dates),
repaired AS (SELECT tpid, l_orderkey, l_linenumber, l_partkey, l_suppkey, price,
    CASE WHEN epistart > epiend THEN admidate ELSE epistart END AS epistart,
    CASE WHEN epistart > epiend THEN disdate ELSE epiend END AS epiend, admidate, disdate FROM turned)"""


def raw_episodes(d: Data):
    day, q, n = F.col("o_orderdate").cast("date"), F.col("l_quantity").cast("int"), F.col("l_linenumber")
    flag, unknown = F.col("l_returnflag"), F.lit("1801-01-01").cast("date")
    lines = d.lineitem.join(d.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        F.col("o_custkey").alias("tpid"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("price"),
        F.when((flag == "R") & (n == 6), unknown).otherwise(F.date_add(day, n)).alias("epistart"),
        F.when((flag != "A") | (n != 5), F.date_add(day, n + q % 11 - 2)).alias("epiend"),
        F.when((flag == "N") & (n == 4), unknown).otherwise(day).alias("admidate"),
        F.when((F.col("l_linestatus") != "F") | (n != 3), F.date_add(day, 5 * q - 20)).alias("disdate"),
    )


@case(f"WITH {EPISODE_SQL} SELECT * FROM repaired")
def q_repair_dates(d: Data):
    return repair_dates(raw_episodes(d))


MERGE_SQL = f"""
WITH {EPISODE_SQL}, e AS (SELECT DISTINCT * FROM repaired),
before AS (SELECT *, max(disdate) OVER (PARTITION BY tpid ORDER BY admidate RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS seen FROM e),
marks AS (SELECT *, CASE WHEN seen >= admidate THEN 0 ELSE 1 END AS opens FROM before),
firsts AS (SELECT tpid, admidate, max(opens) AS opens FROM marks GROUP BY 1, 2),
island AS (SELECT tpid, admidate, sum(opens) OVER (PARTITION BY tpid ORDER BY admidate) AS spell FROM firsts),
bounds AS (SELECT i.tpid, i.spell, min(e.admidate) AS spell_start, greatest(max(e.disdate), max(e.epiend)) AS spell_end
  FROM e JOIN island i ON i.tpid = e.tpid AND i.admidate = e.admidate GROUP BY 1, 2)
"""


@case(MERGE_SQL + """
SELECT e.*, b.spell_start, b.spell_end FROM e JOIN island i ON i.tpid = e.tpid AND i.admidate = e.admidate
JOIN bounds b ON b.tpid = i.tpid AND b.spell = i.spell
""")
def q_spells_merge(d: Data):
    return join_spells(repair_dates(raw_episodes(d)), "tpid", "merge")


# row by row, without aggregating to admissions
CHAIN_SQL = f"""
WITH {EPISODE_SQL}, e AS (SELECT DISTINCT * FROM repaired),
m AS (SELECT *, max(disdate) OVER (PARTITION BY tpid, admidate) AS md,
  row_number() OVER (PARTITION BY tpid ORDER BY admidate, disdate, epistart, epiend, l_orderkey, l_linenumber, l_partkey, l_suppkey, price) AS rn FROM e),
k AS (SELECT *, coalesce(md >= lead(admidate) OVER w, FALSE) AS lk FROM m WINDOW w AS (PARTITION BY tpid ORDER BY rn)),
p AS (SELECT *, coalesce(lag(lk) OVER w, FALSE) AS plk, lag(md) OVER w AS pmd FROM k WINDOW w AS (PARTITION BY tpid ORDER BY rn)),
c AS (SELECT *, sum(CASE WHEN plk THEN 0 ELSE 1 END) OVER (PARTITION BY tpid ORDER BY rn) AS ch FROM p),
x AS (SELECT *, CASE WHEN lk THEN max(md) OVER (PARTITION BY tpid, ch ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
  WHEN plk THEN greatest(md, pmd) ELSE md END AS send FROM c),
y AS (SELECT *, min(admidate) OVER (PARTITION BY tpid, send) AS spell_start FROM x),
z AS (SELECT *, max(greatest(send, epiend)) OVER (PARTITION BY tpid, spell_start) AS spell_end FROM y)
SELECT tpid, l_orderkey, l_linenumber, l_partkey, l_suppkey, price, epistart, epiend, admidate, disdate, spell_start, spell_end FROM z
"""


@case(CHAIN_SQL)
def q_spells_chain(d: Data):
    return join_spells(repair_dates(raw_episodes(d)), "tpid", "chain")


@case(MERGE_SQL + """
SELECT tpid, spell_start, spell_end, CAST(spell_end - spell_start AS INTEGER) AS nights FROM bounds
""")
def q_los(d: Data):
    spells = join_spells(repair_dates(raw_episodes(d)), "tpid").select("tpid", "spell_start", "spell_end").distinct()
    return spells.withColumn("nights", los_nights())
