"""Studies that stop and go on, results laid out by person, what is counted while steps are written, and the new operators on awkward rows."""

import datetime as dt
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from linkcohort.config import Config
from linkcohort.operators import (
    agreement, any_codes, bound_state, collapse_intervals, concordance, count_state, first_clear_event, linkage_bias, match_codes,
    merge_bounds, merge_counts, modal, modes_of, pack_codes, weighted_modal,
)
from linkcohort.plans.combine import combine_summaries, summaries
from linkcohort.plans.study import Study
from linkcohort.sources import codelist, read_marks
from tests.conftest import SMALL
from tests.test_study import absence, census, pupil

D = dt.date


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "Autumn_Census_2015": census(spark, "AUT15", [pupil("a", "7", "2014/2015"), pupil("b", "7", "2014/2015")]),
        "bridging": spark.createDataFrame([("a", "ta")], "pmr string, tpid string"),
        "Absence_2016": absence(spark, [
            ("a", "2015/2016", (100, 100, 100, 0), (10, 0, 0, 0), (5, 5, 0, None), (15, 5, 10, 0), (4, 0, 0, 0), (1, 0, 0, 0)),
            ("b", "2015/2016", (10, 10, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0), (30, 30, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0)),
        ]),
        "Exclusions_2016": spark.createDataFrame(
            [("z", "2015/2016", "FIXD", 2, D(2016, 2, 1))], "pupilmatchingrefanonymous_ex string, academicyear_ex string, category_ex string, sessions_ex int, startdate_ex date"),
        "KS4Pupil_2015_to_2021": spark.createDataFrame(
            [("a", "2018/2019", 45.5, 1, 0)], "KS4_PupilMatchingRefAnonymous string, KS4_ACADYR string, KS4_ATT8 double, KS4_GLEVEL2EM_PTQ_EE int, KS4_EBACC_94 int"),
    }


@pytest.fixture
def again(spark, tables, tmp_path):
    """A new run in the same folder, as after a restart."""
    def make(config=Config(), tables=tables, **more):
        return Study(spark, tables, {}, config, root=str(tmp_path), name="s", **more)

    return make


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_second_run_reads_what_is_finished(again):
    first = again()
    out = rows(first.run())
    marks = dict(first.marks)
    second = again()
    assert rows(second.run()) == out
    assert {s: m.run for s, m in second.marks.items()} == {s: m.run for s, m in marks.items()}  # nothing was written again


def test_a_step_that_was_only_begun_is_made_again(again):
    study = again()
    study.run_spine()
    study.run_modules(only=["exams"])
    study._mark(replace(study.marks["exams"], finished=False))  # as if the run had ended while it was written
    broken = study.spark.createDataFrame([("broken",)], "pmr string")
    broken.write.mode("overwrite").parquet(f"{study.folder}/exams")
    more = again()
    assert "exams" not in more.finished()
    with pytest.raises(ValueError, match="not finished"):
        more.load("exams")
    assert {r.pmr: r.att8 for r in more.run().collect()} == {"a": 45.5, "b": None}


def test_files_without_a_mark_are_not_a_step(again, spark):
    spark.createDataFrame([("broken",)], "pmr string").write.parquet(f"{again().folder}/exams")
    assert again().run().filter("att8 IS NOT NULL").count() == 1


def test_other_settings_or_inputs_are_noticed(again, tables, spark):
    again().run()
    for other in (again(Config(max_sessions=100)), again(version="newer"), again(tables=tables | {"Absence_2016": tables["Absence_2016"].withColumn("extra", F.lit(1))})):
        with pytest.raises(ValueError, match="other inputs or settings"):
            other.run()
    # a setting that only the combined dataset reads leaves the modules as they are
    last = again(Config(attended_only=True))
    last.run_modules()
    with pytest.raises(ValueError, match="2_cohort"):
        last.run_combine()


def test_forgetting_a_step_forgets_what_was_made_of_it(again):
    study = again()
    study.run()
    study.forget("census")
    assert not {"census", "enrolments", "demographics_modals", "2_cohort_spine_complete"} & set(study.finished())
    assert {"absence", "exams"} <= set(study.finished())
    kept = study.marks["exams"].run
    assert again().run().count() == 2
    assert again().marks["exams"].run == kept
    study = again()
    study.forget("exams")
    assert "att8" not in again().run_combine().columns  # its block goes on without the module


def test_modules_by_name(again):
    study = again()
    assert set(study.run_modules(only=["exams"])) == {"exams"}
    assert "absence" not in study.finished() and "1_cohort_spine" in study.finished()
    with pytest.raises(ValueError, match="no such"):
        study.run_modules(skip=["exam"])
    assert not any(c.startswith("abs") for c in study.run(skip=["absence"]).columns)


def test_report_counts_what_was_written(again):
    study = again()
    study.run()
    got = {(r.step, r.measure, r.item): r.n for r in study.report().collect()}
    assert got["1_cohort_spine", "rows", ""] == 2 and got["1_cohort_spine", "linked", ""] == 1 and got["1_cohort_spine", "missing", "tpid"] == 1
    assert got["absence", "broken", "overall within possible"] == 1  # b was away more than possible
    assert got["exclusions", "rows", ""] == 0 and got["exclusions", "broken", "sessions not negative"] == 0
    assert got["2_cohort_spine_complete", "missing", "att8"] == 1
    assert {(r.step, r.measure, r.item): r.n for r in again().report().collect()} == got  # also in another run
    assert again().report().count() == len(got)


def test_an_empty_folder_has_no_report(again):
    assert again().report().count() == 0 and again().finished() == [] and read_marks(again().spark, again().folder) == {}


def test_laid_out_by_person_nothing_of_the_modules_is_shuffled(spark, again):
    plain = rows(again().run().drop("source_table"))
    study = Study(spark, again().tables, {}, Config(), root=again().root, name="laid", buckets=8)
    assert rows(study.run()) == plain
    of = summaries({n: study.load(n) for n in ("absence", "exams", "exclusions", "demographics_modals")}, study.config)
    of = {n: replace(x, rows=study.load(f"by_person_{n}")) for n, x in of.items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = combine_summaries(study.load("1_cohort_spine"), of, study.config)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall("Exchange", plan)) == 1  # the spine's
    assert plan.count("SortMergeJoin") == 4 and len(re.findall(r"Bucketed: true", plan)) == 4
    # a session that has not seen the tables
    for t in spark.catalog.listTables():
        if t.name.startswith("linkcohort_"):
            spark.sql(f"DROP TABLE {t.name}")
    other = Study(spark, again().tables, {}, Config(), root=again().root, name="laid", buckets=8)
    assert rows(other.run()) == plain and rows(other.load("by_person_exams")) == rows(study.load("exams"))


def test_codes_are_read_once_whatever_the_lengths(spark):
    parts = spark.read.parquet(f"{SMALL}/part.parquet")
    codes = codelist(spark, [("B1", "x"), ("B12", "y"), ("B123", "z")], ["code", "group"])
    text = match_codes(parts.withColumnRenamed("p_brand", "code"), codes, ["group"], lengths=(2, 3, 4))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan parquet", text)) == 1 and len(re.findall(r"HashJoin|SortMergeJoin", text)) == 1
    packed = parts.select("p_partkey", pack_codes(["p_brand", "p_type"]).alias("codes"))
    text = any_codes(packed, "codes", {"a": (codes, (2, 3)), "b": (codes, (4,))}, ["p_partkey"])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan parquet", text)) == 2  # the rows, and their codes


def test_rows_with_codes_are_not_grouped(spark):
    parts = spark.read.parquet(f"{SMALL}/part.parquet").withColumnRenamed("p_brand", "code")
    codes = codelist(spark, [("B1", "x"), ("B12", "y"), ("B123", "z")], ["code", "group"])
    text = match_codes(parts, codes, ["group"], lengths=(2, 3, 4))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "hashpartitioning(_id" not in text


def test_longest_entry_wins_for_repeated_rows_and_listings(spark):
    df = spark.createDataFrame([("B123", 1), ("B123", 1), ("B1", 2), ("C9", 3), (None, 4), ("", 5), ("B", 6), ("B2", None)], "code string, k int")
    codes = codelist(spark, [("B1", "x"), ("B12", "y"), ("B12", "y2"), ("B", "short"), ("B2", "w")], ["code", "group"])
    got = rows(match_codes(df, codes, ["group"], lengths=(2, 3)))
    assert got == sorted([("B123", 1, "B12", "y"), ("B123", 1, "B12", "y2")] * 2 + [("B1", 2, "B1", "x"), ("B2", None, "B2", "w")], key=str)


def test_first_clear_event(spark):
    days = [("a", D(2000, 1, 1)), ("a", D(2000, 1, 1)), ("a", D(2000, 3, 1)), ("a", D(2000, 12, 1)), ("b", D(1999, 12, 31)), ("b", D(2000, 1, 10)), ("c", None), (None, D(2000, 1, 1))]
    df = spark.createDataFrame(days, "id string, day date")
    lo, hi = F.lit(D(2000, 2, 1)), F.lit(D(2001, 1, 1))
    assert rows(first_clear_event(df, "id", "day", 100, lo, hi)) == [("a", D(2000, 12, 1))]  # March is 60 days after January
    assert rows(first_clear_event(df, "id", "day", 60, lo, hi)) == [("a", D(2000, 12, 1))]
    assert rows(first_clear_event(df, "id", "day", 59, lo, hi)) == [("a", D(2000, 3, 1))]
    assert rows(first_clear_event(df, "id", "day", 365)) == [("a", D(2000, 1, 1)), ("b", D(1999, 12, 31))]


def test_weighted_mode(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 1), ("a", "y", 3), ("b", "z", 2), ("b", "w", 2), ("c", None, 5), ("d", "v", 0), ("d", "u", None), (None, "x", 9)], "id string, v string, w int")
    assert rows(weighted_modal(df, "id", ["v"], "w")) == [("a", "y"), ("b", "w"), ("c", None), ("d", None)]


def test_concordance_and_kappa(spark):
    a = spark.createDataFrame([(i, v) for i, v in enumerate(["f", "f", "m", "m", "m", None, None, "f"])], "id int, sex string")
    b = spark.createDataFrame([(i, v) for i, v in enumerate(["f", "m", "m", "m", None, "f", None])], "id int, sex string")
    pairs = concordance(a, b, "id", ["sex"])
    assert ("sex", "m", "m", 2) in rows(pairs) and sum(r.n for r in pairs.collect()) == 7
    row = agreement(pairs).collect()[0]
    assert (row.n_both, row.n_only_a, row.n_only_b, row.n_neither, row.n_agree, row.pct_agree) == (4, 1, 1, 1, 3, 75.0)
    assert row.kappa == 0.5  # (0.75 - 0.5) / (1 - 0.5)
    same = agreement(concordance(b.fillna("f"), b.fillna("f").withColumn("sex", F.lit("f")), "id", ["sex"]).filter("value_a = 'f'")).collect()[0]
    assert same.kappa is None
    assert agreement(concordance(a.limit(0), b, "id", ["sex"])).count() == 0


def test_linkage_bias(spark):
    df = spark.createDataFrame([("t", 1.0, "x"), ("t", 3.0, "y"), (None, 5.0, "x"), (None, 7.0, "x"), (None, None, None)], "tpid string, v double, c string")
    got = {(r.variable, r.level): r for r in linkage_bias(df, "tpid", ["v"], ["c"]).collect()}
    assert (got["v", None].n_in, got["v", None].n_out, got["v", None].std_diff) == (2, 2, round(-4 / 2**0.5, 4))
    assert (got["c", "x"].mean_in, got["c", "x"].mean_out, got["c", "y"].std_diff) == (0.5, 1.0, round(0.5 / (0.25 / 2) ** 0.5, 4))


def test_states_merge_to_what_all_rows_give(spark):
    df = spark.createDataFrame([(i % 7 if i % 11 else None, "xyz"[i * i % 3] if i % 5 else None, i * 37 % 20, i % 3) for i in range(400)] + [(99, None, None, 0)], "id int, v string, k int, part int")
    parts = [df.filter(F.col("part") == p) for p in range(3)]
    merged = merge_counts(*[count_state(p, "id", ["v", "k"]) for p in parts])
    assert rows(modes_of(merged, "id", {"v": "string", "k": "int"})) == rows(modal(df.filter("id IS NOT NULL"), "id", ["v", "k"]))
    flags = {"high": F.col("k") > 18}
    assert rows(merge_bounds(*[bound_state(p, "id", ["k"], flags) for p in parts])) == rows(bound_state(df, "id", ["k"], flags))


def test_collapse_intervals(spark):
    df = spark.createDataFrame([
        ("a", D(2000, 1, 1), D(2000, 1, 5)), ("a", D(2000, 1, 3), D(2000, 1, 4)), ("a", D(2000, 1, 5), D(2000, 1, 9)), ("a", D(2000, 1, 11), D(2000, 1, 1)),
        ("a", D(2000, 1, 20), None), ("a", D(2001, 1, 1), D(2001, 1, 2)), ("a", None, D(2000, 1, 1)), (None, D(2000, 1, 1), None), ("b", D(2000, 1, 1), D(2000, 1, 1)), ("b", D(2000, 1, 1), D(2000, 1, 1)),
    ], "id string, s date, e date")
    assert rows(collapse_intervals(df, "id", "s", "e")) == [
        ("a", D(2000, 1, 1), D(2000, 1, 9), 3), ("a", D(2000, 1, 11), D(2000, 1, 11), 1), ("a", D(2000, 1, 20), None, 2), ("b", D(2000, 1, 1), D(2000, 1, 1), 2)]
    assert [r[3] for r in rows(collapse_intervals(df, "id", "s", "e", gap=2))] == [4, 2, 2]


def test_an_event_cohort(spark, tmp_path):
    from tests.test_study import episodes, stay

    tables = {
        "HES_APC_2009": episodes(spark, stay("ta", "2009-12-20", "2009-12-21", diag_01="J459", epikey="1")),
        "HES_APC_2010": episodes(
            spark, stay("ta", "2010-03-01", "2010-03-05", diag_02="J459", epikey="2"), stay("tb", "2010-04-01", "2010-04-02", diag_01="J459", mydob="92003"),
            stay("tb", "2010-08-01", "2010-08-02", diag_01="J45", mydob="102003"), stay("tc", "2010-04-01", "2010-04-02", diag_01="K35"), stay("td", "2010-05-01", "2010-05-02", diag_03="J459"),
        ),
        "bridging": spark.createDataFrame([("d", "td")], "pmr string, tpid string"),
        "KS4Pupil_2015_to_2021": spark.createDataFrame(
            [("d", "2019/2020", 45.5, 1, 0)], "KS4_PupilMatchingRefAnonymous string, KS4_ACADYR string, KS4_ATT8 double, KS4_GLEVEL2EM_PTQ_EE int, KS4_EBACC_94 int"),
    }
    cfg = Config(inception="event", event_from=D(2010, 1, 1), event_to=D(2011, 1, 1), event_clear_days=365)
    lists = {"inception": codelist(spark, [("J45",)], ["code"])}
    got = {r.tpid: r for r in Study(spark, tables, lists, cfg, root=str(tmp_path)).run().collect()}
    assert set(got) == {"tb", "td"}  # ta had one within the year before
    assert (got["tb"].index_date, got["tb"].dob_approx, got["tb"].eligible) == (D(2010, 4, 1), None, False)  # two dates of birth, no pupil
    assert (got["td"].pmr, got["td"].y7_year, got["td"].att8, got["td"].eligible) == ("d", 2016, 45.5, True)
