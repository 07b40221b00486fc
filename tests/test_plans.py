"""What the plans may not contain, and what they must."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from linkcohort.config import Config
from linkcohort.operators import attach, first_per, join_spells, los_nights, match_codes, modal, repair_dates, with_year7
from linkcohort.plans import phenotypes
from linkcohort.plans.combine import phenotype_summary
from linkcohort.sources import codelist
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(entry_module.queries()[name](spark, SMALL))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def orders(spark):
    return spark.read.parquet(f"{SMALL}/orders.parquet")


def test_first_per_limits_each_key_before_the_shuffle(spark):
    text = plan(first_per(orders(spark), "o_custkey", ["o_orderdate", "o_orderkey"]))
    assert text.index("Exchange") < text.index("1, Partial") and "row_number(), 1, Partial" in text


def test_modal_counts_before_the_shuffle(spark):
    text = plan(modal(orders(spark), "o_custkey", ["o_orderpriority", "o_orderstatus"]))
    assert "partial_count" in text and len(re.findall("Exchange", text)) == 3
    assert "o_totalprice" not in text
    one = plan(modal(orders(spark), "o_custkey", ["o_orderpriority"]))
    assert len(re.findall("Exchange", one)) == 2


def test_spine_is_exchanged_once_per_identifier(spark):
    people = spark.read.parquet(f"{SMALL}/customer.parquet").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    parts = [orders(spark).groupBy("o_custkey").agg(F.max(c).alias(c)) for c in ("o_totalprice", "o_orderdate", "o_orderkey")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(attach(people, "o_custkey", *parts))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall("Exchange hashpartitioning", text)) == 1 + len(parts)


def test_codelists_are_broadcast_by_their_size(spark):
    codes = codelist(spark, [("1-U", "x")], ["code", "group"])
    df = orders(spark).select(F.col("o_orderpriority").alias("code"))
    assert "BroadcastHashJoin" in plan(match_codes(df, codes, ["group"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(match_codes(df, codes, ["group"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    text = entry_module.queries()["q_exclusions"](spark, SMALL)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "o_totalprice" not in text.split("ReadSchema")[1].split("\n")[0]


def test_episodes_are_scanned_once_for_spells(spark):
    df = entry_module.queries()["q_phenotype"](spark, SMALL)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert len(re.findall(r"FileScan parquet \[l_", final)) == 7


@pytest.mark.parametrize("parts", [1, 7, 200])
@pytest.mark.parametrize("name", ["q_modal", "q_resolve", "q_link", "q_spells_chain", "q_run_id"])
def test_results_do_not_depend_on_partitions(spark, name, parts):
    run = entry_module.queries()[name]
    want = run(spark, SMALL).toPandas()
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = run(spark, SMALL).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    by = list(want.columns)
    assert want.sort_values(by).reset_index(drop=True).equals(got.sort_values(by).reset_index(drop=True))


def test_presentations_read_the_episodes_once(spark):
    """The urgent rows are not read, made distinct and joined apart from all rows."""
    rows = [("T1", "1990-01-05", "1990-01-06", "1990-01-05", "1990-01-09", "21", "R104", 2), ("T1", "1990-01-08", "1990-01-09", "1990-01-08", "1990-01-20", "11", "K35", 2)]
    episodes = spark.createDataFrame(rows, "tpid string, epistart string, epiend string, admidate string, disdate string, admimeth string, codes string, startage int")
    spine = spark.createDataFrame([("T1", 1996)], "tpid string, y7_year int")
    spells = join_spells(repair_dates(with_year7(episodes, spine, "tpid"))).withColumn("spell_los_nights", los_nights())
    lists = [codelist(spark, [("R10", "potentially_psych", "")], ["code", "group", "flag2"]), codelist(spark, [("K35", "icd10")], ["code", "code_type"]), codelist(spark, [("21",)], ["code"])]
    out = phenotypes.presentations(phenotypes.long_codes(spells), *lists)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x and "admimeth" in x]
    assert [(r.tpid, r.code, r.group) for r in out.collect()] == [("T1", "R104", "psych")]


def test_dates_of_phenotypes_are_no_filter_on_the_episodes(spark):
    rows = [("T1", "chronic", "1992-03-01"), ("T1", "psych", "1994-01-01"), ("T2", "chronic", "1991-12-31"), ("T3", "psych", None)]
    codes = spark.createDataFrame(rows, "tpid string, phen_group string, epistart string").withColumn("epistart", F.col("epistart").cast("date"))
    out = phenotype_summary(codes, Config(phenotype_from=dt.date(1992, 1, 1), phenotype_to=dt.date(1994, 1, 1)))
    assert "Filter" not in plan(out).split("HashAggregate")[-1]  # the part below the aggregate
    assert {r.tpid: (r.chc_chronic, r.chc_psych) for r in out.collect()} == {"T1": (True, False)}


def test_groups_of_episodes_need_no_second_look_at_their_diagnoses(spark):
    r = random.Random(3)
    rows = [
        (r.choice(["T1", "T2", "T3", None]), 1996, r.choice(["1990-01-05", "1991-02-06", None]), r.choice(["21", "11", None]), r.choice([2, 12, 7001]), r.choice([1, 5, None]),
         r.choice(["diag", "opertn"]), r.randint(1, 3), r.choice(["R104", "K35", "X600", "J450", "A123", "E109", ""]))
        for _ in range(60)
    ]
    long = spark.createDataFrame(rows, "tpid string, y7_year int, epistart string, admimeth string, startage int, spell_los_nights int, code_type string, code_no int, code string")
    lists = [
        codelist(spark, [("J45", "LOS3", "respiratory"), ("E10", "", "metabolic")], ["code", "flag", "group"]),
        codelist(spark, [("R10", "potentially_psych", ""), ("X60", "selfharm", "")], ["code", "group", "flag2"]),
        codelist(spark, [("K35", "icd10"), ("A123", "opcs4")], ["code", "code_type"]), codelist(spark, [("21",)], ["code"]),
    ]
    want = phenotypes.phenotype_codes(long, Config(), *lists).select("tpid", "epistart", "phen_group")
    got = phenotypes.phenotype_episodes(long, Config(), *lists)
    assert {tuple(x) for x in got.collect()} == {tuple(x) for x in want.collect()}
    combined = entry_module.queries()["q_combine"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in combined.splitlines() if "Join" in x and len(re.findall("epistart#", x)) >= 2]
