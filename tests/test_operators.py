"""Hand-made cases: NULL ids, blanks, sentinels, ties, conflicts, three-valued flags."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from linkcohort import functions as fn
from linkcohort import operators as op
from linkcohort.sources import codelist
from tests.conftest import rows
from workload.reduce import q_row_number_wide

D = dt.date


def test_first_and_latest(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, None), (2, 1, "z"), (None, 5, "n")], "id int, t int, v string")
    assert rows(op.first_per(df, "id", ["t"])) == [(None, 5, "n"), (1, 1, "a"), (2, 1, "z")]
    assert rows(op.latest(df, "id", ["v"], ["t"])) == [(None, "n"), (1, None), (2, "z")]


def test_modal_ignores_nulls_and_breaks_ties(spark):
    data = [(1, "a", 1, 5), (1, "a", 2, 5), (1, "b", 3, 6), (2, "b", 1, None), (2, "a", 2, None), (2, None, 3, None), (3, None, 1, 7)]
    df = spark.createDataFrame(data, "id int, v string, t int, n int")
    assert rows(op.modal(df, "id", ["v", "n"])) == [(1, "a", 5), (2, "a", None), (3, None, 7)]
    assert rows(op.modal(df, "id", ["v"], "last", ["t"])) == [(1, "a"), (2, "a"), (3, None)]
    one, two = (rows(op.modal(df.repartition(k), "id", ["v"], "hash", seed=9)) for k in (1, 5))
    assert one == two and one[0] == (1, "a") and one[1][1] in ("a", "b")
    with pytest.raises(ValueError):
        op.modal(df, "id", ["v"], "last")


def test_last_falls_back_to_last_value_even_if_not_tied(spark):
    df = spark.createDataFrame([(1, v, t) for t, v in enumerate("aabbc")], "id int, v string, t int")
    assert rows(op.modal(df, "id", ["v"], "last", ["t"])) == [(1, "c")]


def test_ever_null_policy(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (2, 0), (3, None)], "id int, f int")
    assert rows(op.ever(df, "id", ["f"])) == [(1, 1), (2, 0), (3, None)]
    assert rows(op.ever(df, "id", ["f"], strict_nulls=True)) == [(1, None), (2, 0), (3, None)]


def test_highest(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (3, "x")], "id int, v string")
    levels = [("Low", F.col("v") == "x"), ("High", F.col("v") == "y")]
    assert rows(op.highest(df, "id", levels, "h", "None")) == [(1, "High"), (2, "None"), (3, "Low")]


def test_resolve_policies(spark):
    data = [(1, 1, 30, None), (1, 2, None, 9), (2, 1, 31, 1), (2, 2, 32, 2), (3, 1, None, None)]
    df = spark.createDataFrame(data, "id int, t int, a int, b int")
    assert rows(op.resolve(df, "id", ["a", "b"])) == [(1, 30, 9), (2, None, None), (3, None, None)]
    assert rows(op.resolve(df, "id", ["a", "b"], "drop")) == [(1, 30, 9), (3, None, None)]
    mixed = op.resolve(df, "id", ["a", "b"], {"a": "null", "b": "first"}, ["t"])
    assert rows(mixed) == [(1, 30, 9), (2, None, 1), (3, None, None)]


def test_resolve_where_and_unless(spark):
    data = [(1, 5, True, False), (1, 6, False, False), (2, 7, True, False), (2, 7, False, True), (3, 8, False, False)]
    df = spark.createDataFrame(data, "id int, a int, ok boolean, bad boolean")
    assert rows(op.resolve(df, "id", ["a"], "drop", where=F.col("ok"), unless=F.col("bad"))) == [(1, 5)]


def test_any_in_group_keeps_null_groups(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (None, None)], "id int, f int")
    got = rows(op.any_in_group(df, "id", {"hit": F.col("f") == 1}))
    assert got == [(None, None, True), (None, 1, True), (1, 0, True), (1, 1, True), (2, 0, False)]


def test_rank_number_and_runs(spark):
    data = [("a", D(2020, 1, 1), 1, "x"), ("a", D(2020, 1, 1), 2, "x"), ("a", D(2020, 1, 2), 1, "y"), ("a", D(2020, 1, 5), 1, "y"), ("b", D(2020, 1, 9), 1, "x")]
    df = spark.createDataFrame(data, "id string, d date, n int, v string")
    assert [r[-1] for r in rows(op.dense_rank_in(df, "id", "d", "r"))] == [1, 1, 2, 3, 1]
    assert [r[-1] for r in rows(op.number_rows(df, "id", "d", "n", "r"))] == [1, 2, 3, 4, 1]
    assert [r[-1] for r in rows(op.run_id(df, "id", "d", "v", "r"))] == [1, 1, 2, 2, 1]


def test_attach_null_ids_and_fill(spark):
    spine = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, id string")
    facts = spark.createDataFrame([("a", 5), (None, 9)], "id string, n int")
    assert rows(op.attach(spine, "id", facts, fill={"n": 0}), "k", "n") == [(1, 5), (2, None), (3, 0)]
    assert rows(op.attach(spine, "id", facts, null_safe=True), "k", "n") == [(1, 5), (2, 9), (3, None)]


def test_flag_exists_and_negation(spark):
    spine = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, id string")
    facts = spark.createDataFrame([("a", 8), ("a", None), ("c", None), (None, 8)], "id string, y int")
    got = op.flag_exists(spine, facts, "id", {"in8": F.col("y") == 8, "not9": F.col("y") == 9}, negate=["not9"])
    assert rows(got, "k", "in8", "not9") == [(1, True, True), (2, None, None), (3, False, True)]


def test_link_fan_out_and_default(spark):
    spine = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "pmr string")
    pairs = [("p1", "t1"), ("p1", "t2"), ("p2", "t1"), ("p2", None), ("p9", "t0")]
    bridge = spark.createDataFrame(pairs, "pmr string, tpid string")
    assert rows(op.link(spine, bridge, "pmr", "tpid")) == [("p1", "t1"), ("p2", None), ("p3", None)]
    assert rows(op.link(spine, bridge, "pmr", "tpid", ["tpid"])) == [("p1", "t1"), ("p1", "t2"), ("p2", None), ("p3", None)]


def test_add_new_members(spark):
    spine = spark.createDataFrame([("a", 1)], "id string, y int")
    extra = spark.createDataFrame([("a", 0), ("b", 3), ("b", 2)], "id string, y int")
    assert rows(op.add_new_members(spine, extra, "id", ["y"])) == [("a", 1), ("b", 2)]


def test_eligibility_is_three_valued(spark):
    df = spark.createDataFrame([("t", D(2003, 1, 1)), (None, D(2003, 1, 1)), ("t", None), (None, None), ("t", D(2009, 1, 1))], "tpid string, dob date")
    got = op.eligibility(df, "tpid", "dob", F.lit(D(2002, 9, 1)), F.lit(D(2005, 9, 1)))
    assert [(r.born_in_year, r.eligible) for r in got.collect()] == [(True, True), (True, False), (None, None), (None, False), (False, False)]


def test_flag_algebra(spark):
    df = spark.createDataFrame([(True, False), (None, True), (None, False), (False, False)], "a boolean, b boolean")
    got = df.select(fn.any_true(["a", "b"]), fn.count_true(["a", "b"]))
    assert [tuple(r) for r in got.collect()] == [(True, 1), (True, None), (None, None), (False, 0)]


def test_dates(spark):
    df = spark.createDataFrame([("112004",), ("92004",), ("132004",), ("",), (None,)], "m string")
    assert [r[0] for r in df.select(fn.dob_approx("m")).collect()] == [D(2004, 11, 15), D(2004, 9, 15), None, None, None]
    df = spark.createDataFrame([(D(2004, 8, 31),), (D(2004, 9, 1),), (None,)], "d date")
    assert [r[0] for r in df.select(fn.academic_year("d")).collect()] == [2004, 2005, None]
    df = spark.createDataFrame([("2015-02-30",), ("2015-02-03",), ("2015",), ("2015-02",), ("",), ("x",)], "s string")
    assert [r[0] for r in df.select(fn.parse_date("s")).collect()] == [None, D(2015, 2, 3), None, None, None, None]
    assert spark.range(1).select(fn.parse_acad_year(F.lit("2014/2015"))).first()[0] == 2015


def test_recode_and_ranges(spark):
    df = spark.createDataFrame([(" WBRI ", 21), ("zzz", 22), (None, 46), ("Chin", None)], "e string, g int")
    mapping = {"white": ["wbri"], "other": ["chin"]}
    got = df.select(fn.recode("e", mapping, normalise=True), fn.nullify_outside("g", 22, 45))
    assert [tuple(r) for r in got.collect()] == [("white", None), (None, 22), (None, None), ("other", None)]
    got = df.select(fn.case_update("e", [(F.col("g") > 0, "a"), (F.col("g") > 40, "b")]))
    assert [r[0] for r in got.collect()] == ["a", "a", "b", "Chin"]


def test_school_window_excludes_its_last_day(spark):
    spine = spark.createDataFrame([("t", 2015), ("u", None)], "tpid string, y7_year int")
    days = [D(2008, 8, 31), D(2008, 9, 1), D(2014, 8, 30), D(2014, 8, 31), None]
    df = spark.createDataFrame([("t", d) for d in days] + [("u", D(2010, 1, 1)), ("v", D(2010, 1, 1))], "tpid string, d date")
    assert rows(op.within_school_window(df, spine, "tpid", "d"), "d") == [(D(2008, 9, 1),), (D(2014, 8, 30),)]
    assert len(rows(op.within_school_window(df, spine, "tpid", "d", end_inclusive=True))) == 3


def test_absence_arithmetic(spark):
    df = spark.createDataFrame([(1, 10, None, 3), (1, 5, 2, None), (2, None, None, None)], "id int, p_a int, p_b int, m_a int")
    got = op.collapse_sum(df, ["id"], ["p_a", "p_b", "m_a"])
    assert rows(got) == [(1, 15, 2, 3), (2, 0, 0, 0)]
    got = op.annualise(got.withColumn("m_b", F.lit(0)), ["p", "m"], ["a", "b"])
    assert rows(op.rates(got, {"r": "m_annual"}, "p_annual"), "id", "r") == [(1, 17.6), (2, None)]


def test_melt_then_dcast_is_identity(spark):
    df = spark.createDataFrame([(1, 5, 6), (2, 7, 8)], "id int, v_1 int, v_2 int")
    long = op.melt(df, ["id"], ["v_1", "v_2"]).withColumn("n", F.substring("variable", 3, 1).cast("int"))
    back = op.dcast(long.withColumnRenamed("value", "v"), ["id"], "n", [1, 2], ["v"])
    assert rows(back) == rows(df)


def test_match_codes_longest_entry_wins(spark):
    codes = codelist(spark, [("J45", "resp"), ("J45.0", "asthma"), ("J45.0", "allergy"), ("E10", "met")], ["code", "group"])
    df = spark.createDataFrame([("J450",), ("J459",), ("E109",), ("A000",), (None,)], "code string")
    got = rows(op.match_codes(df, codes, ["group"]))
    assert got == [("E109", "E10", "met"), ("J450", "J450", "allergy"), ("J450", "J450", "asthma"), ("J459", "J45", "resp")]


def test_codes_long_forms_agree(spark):
    df = spark.createDataFrame([(1, "J4501", "", "A01"), (2, None, "X60", ""), (3, "", None, None)], "id int, diag_01 string, diag_02 string, opertn_01 string")
    cols = ["diag_01", "diag_02", "opertn_01"]
    wide = op.melt_codes(df, ["id"], cols)
    packed = op.unpack_codes(df.select("id", op.pack_codes(cols).alias("c")), ["id"], "c", {"diag": 2, "opertn": 1})
    want = [(1, "diag", 1, "J450"), (1, "opertn", 1, "A01"), (2, "diag", 2, "X60")]
    assert rows(wide, "id", "code_type", "code_no", "code") == rows(packed, "id", "code_type", "code_no", "code") == want


def test_checks(spark):
    df = spark.createDataFrame([(1, 2), (3, 2), (None, 2)], "a int, b int")
    assert rows(op.violations(df, {"le": F.col("a") <= F.col("b")})) == [("le", 1)]
    assert rows(op.violating(df, F.col("a") <= F.col("b"))) == [(3, 2)]
    assert rows(op.tabulate(df, ["b"])) == [(2, 3)]
    assert rows(op.missingness(df, ["a", "b"])) == [("a", 1), ("b", 0)]
    assert rows(op.uniqueness(df, "b")) == [(3, 1)]
    assert rows(op.linkage_report(df, "a"), "n", "n_linked", "n_distinct") == [(3, 2, 2)]


def test_fill_from_second_source(spark):
    a = spark.createDataFrame([(1, "f"), (2, None), (3, "m")], "id int, sex string")
    b = spark.createDataFrame([(1, "f"), (2, "m"), (3, "f")], "id int, sex string")
    assert rows(op.fill_from(a, b, "id", ["sex"]), "id", "sex", "sex_differs") == [(1, "f", False), (2, "m", None), (3, "m", True)]


def test_ids_beyond_64_bits_are_numbered(spark):
    class Orders:
        orders = spark.createDataFrame([(9_000_001, 1, "2000-01-01"), (9_000_002, 1, "2000-01-01"), (9_000_004, 1, "1999-01-01"), (9_000_003, None, None)], "o_orderkey long, o_custkey long, o_orderdate string")

    got = {int(r.id): r.order_n for r in q_row_number_wide(Orders).collect()}
    assert got == {-9_000_001 * 10**13: 2, 9_000_002 * 10**13: 3, 9_000_004 * 10**13: 1, -9_000_003 * 10**13: 1}
    Orders.orders = Orders.orders.withColumn("o_orderkey", F.col("o_orderkey") - 9_000_000)
    assert dict(q_row_number_wide(Orders).dtypes)["id"] == "bigint"
