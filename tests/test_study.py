"""A whole study on a handful of pupils, in the columns the extracts really have."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from linkcohort.config import ALL_COMPAT, Config
from linkcohort.plans.births import DIAG, OPERTN
from linkcohort.plans.study import Study
from linkcohort.sources import codelist

D = dt.date
CENSUS = ["pupilmatchingrefanonymous", "ageatstartofacademicyear", "monthpartofageatstartofacademicyear", "ncyearactual", "academicyear",
          "gender", "ethnicgroupmajor", "languagegroupmajor", "yearofbirth", "monthofbirth", "fsmeligible", "idaci_decile", "senprovision"]
INTS = {"yearofbirth", "monthofbirth", "fsmeligible", "idaci_decile"}


def census(spark, suffix, rows, ethnicity=True):
    cols = [c for c in CENSUS if ethnicity or c != "ethnicgroupmajor"]
    keep = [i for i, c in enumerate(CENSUS) if c in cols]
    schema = ", ".join(f"{c}_{suffix} {'int' if c in INTS else 'string'}" for c in cols)
    return spark.createDataFrame([tuple(r[i] for i in keep) for r in rows], schema)


def pupil(pmr, nc, ay, gender="F", eth="WBRI", lang="1_ENG", yob=2003, mob=10, fsm=0, idaci=4, sen="N", age="11"):
    return (pmr, age, "1", nc, ay, gender, eth, lang, yob, mob, fsm, idaci, sen)


EPISODE = {"token_person_id": None, "mydob": "102003", "epistart": None, "epiend": None, "admidate": None, "disdate": None, "admimeth": "21", "startage": 7,
           "epitype": 1, "classpat": 1, "neocare": 8, "hrgnhs": "A", "numbaby": "1", "dismeth": 1, "epikey": "e", "birstat_1": 1, "matage": 30, "birordr_1": "X",
           "gestat_1": 40, "birweit_1": 3300, "imd04_decile": "Most deprived 10%"} | dict.fromkeys([*DIAG, *OPERTN], "")
EP_INTS = {"startage", "epitype", "classpat", "neocare", "dismeth", "birstat_1", "matage", "gestat_1", "birweit_1"}


def episodes(spark, *rows):
    schema = ", ".join(f"{c.upper()} {'int' if c in EP_INTS else 'string'}" for c in EPISODE)
    return spark.createDataFrame([tuple((EPISODE | r).values()) for r in rows], schema)


def stay(who, start, end, **more):
    return {"token_person_id": who, "epistart": start, "epiend": end, "admidate": start, "disdate": end} | more


def absence(spark, rows):
    stems = ["sessionspossible", "authorisedabsence", "unauthorisedabsence", "overallabsence", "termlyreasoni", "termlyreasonm"]
    cols = [f"{s}_{t}_ab16" for s in stems for t in ("autumn", "spring", "summer", "summer6th")]
    data = [(p, y, *[v for stem in values for v in stem]) for p, y, *values in rows]
    return spark.createDataFrame(data, "pupilmatchingrefanonymous_ab16 string, academicyear_ab16 string, " + ", ".join(f"{c} int" for c in cols))


@pytest.fixture(scope="module")
def tables(spark):
    y7 = "2014/2015"
    return {
        # a: year 7 in autumn and spring; b: ungraded at 11; c: only in alternative provision; d: another year group
        "Autumn_Census_2015": census(spark, "AUT15", [pupil("a", "7", y7, fsm=1, idaci=2), pupil("b", "X", y7), pupil("d", "9", y7)], ethnicity=False),
        "Spring_Census_2015": census(spark, "SPR15", [pupil("a", "7", y7, idaci=2), pupil("a", "7", y7, idaci=3)]),
        "Spring_Census_2016": census(spark, "SPR16", [pupil("a", "8", "2015/2016"), pupil("b", "7", "2015/2016")]),
        "Autumn_Census_2010": census(spark, "AUT10", [
            pupil("a", "2", "2009/2010", sen="K", eth=" wbri ", gender="2", yob=2003, mob=10), pupil("b", "2", "2009/2010", eth="REFU", gender="9", fsm=1, yob=2004)]),
        "Spring_Census_2010": census(spark, "SPR10", [pupil("a", "2", "2009/2010", sen="E", lang="OTH"), pupil("b", "2", "2009/2010", eth="CHNE", fsm=None, gender="M")]),
        "Spring_Census_2015_Schools": spark.createDataFrame([(1,)], "urn int"),
        "AP_Census_2008_to_2022": spark.createDataFrame(
            [("c", "2015/2016", 11, "M", "BAFR", 2004, 1, 1, "E"), ("c", "2013/2014", 9, "M", "BAFR", 2004, 1, 0, "E"), ("a", "2014/2015", 11, "F", "WBRI", 2003, 10, 0, "N")],
            "AP_PupilMatchingRefAnonymous string, AP_ACADYR string, AP_Age_Start int, AP_Gender string, AP_EthnicGroupMajor string, AP_YearOfBirth int, "
            "AP_MonthOfBirth int, AP_FSMeligible int, AP_SENProvision string"),
        "PRU_Census_2010_to_2013": spark.createDataFrame(
            [("b", "2012/2013", "4", "8", "M", "CHNE", "OTH", 2003, 10, 1, "N")],
            "PRU_PupilMatchingRefAnonymous string, PRU_AcademicYear string, PRU_NCyearActual string, PRU_AgeAtStartOfAcademicYear string, PRU_Gender string, "
            "PRU_EthnicGroupMajor string, PRU_LanguageGroupMajor string, PRU_YearOfBirth int, PRU_MonthOfBirth int, PRU_FSMeligible int, PRU_SENprovision string"),
        "bridging": spark.createDataFrame([("a", "ta"), ("a", "ta2"), ("b", "ta"), ("b", None), ("c", "tc")], "pmr string, tpid string"),
        "HES_APC_2003": episodes(
            spark,
            stay("ta", "2003-03-10", "2003-03-11", startage=7001, diag_01="Z380"),
            stay("ta", "2003-03-10", "2003-03-11", startage=7002, epitype=3, matage=31, gestat_1=99, epikey="f"),
            stay("tc", "2004-01-05", "2004-01-06", startage=7001, diag_01="Z380", diag_02="P95X"),
            stay("tq", "2004-01-05", "2004-01-06", startage=7001, diag_01="Z380", mydob="12004"),
        ),
        "HES_APC_2010": episodes(
            spark,
            stay("ta", "2010-03-01", "2010-03-05", diag_01="J459", epikey="1"),          # five-day spell: counts
            stay("ta", "2010-05-01", "2010-05-02", diag_01="R104", opertn_01="A123", epikey="2"),  # void: surgical
            stay("tc", "2010-06-01", "2010-06-02", diag_01="J459", diag_02="X601", epikey="3"),    # too short for J45; self-harm
            stay("tc", "2010-07-01", "2010-07-02", diag_01="X601", admimeth="11", epikey="4"),     # not an emergency
        ),
        "HES_OP_2011": spark.createDataFrame(
            [("ta", "2011-05-01", "1", "5", "191"), ("ta", "2011-04-01", "2", "3", "241"), ("ta", "2011-01-01", "1", "5", "300")],
            "TOKEN_PERSON_ID string, APPTDATE string, FIRSTATT string, ATTENDED string, TRETSPEF string"),
        "Exclusions_2016": spark.createDataFrame(
            [("a", "2015/2016", "FIXD", 2, D(2016, 2, 1)), ("a", "2015/2016", "FIXD", 2, D(2016, 2, 1)), ("z", "2015/2016", "PERM", 0, D(2016, 2, 1))],
            "pupilmatchingrefanonymous_ex string, academicyear_ex string, category_ex string, sessions_ex int, startdate_ex date"),
        "Absence_2016": absence(spark, [
            ("a", "2015/2016", (100, 100, 100, 0), (10, 0, 0, 0), (5, 5, 0, None), (15, 5, 10, 0), (4, 0, 0, 0), (1, 0, 0, 0)),
            ("a", "2015/2016", (10, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0), (1, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0)),
            ("b", "2015/2016", (300, 200, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0)),
            ("a", "2018/2019", (50, 50, 100, 100), (0, 0, 50, 0), (0, 0, 0, 0), (10, 0, 60, 60), (0, 0, 0, 0), (0, 0, 0, 0)),
        ]),
        "KS4Pupil_2015_to_2021": spark.createDataFrame(
            [("a", "2018/2019", 45.5, 1, 0), ("a", "2019/2020", 50.0, None, 1), ("a", "2016/2017", 99.0, 1, 1)],
            "KS4_PupilMatchingRefAnonymous string, KS4_ACADYR string, KS4_ATT8 double, KS4_GLEVEL2EM_PTQ_EE int, KS4_EBACC_94 int"),
    }


@pytest.fixture(scope="module")
def codelists(spark):
    return {
        "births": codelist(spark, [("diag", "Z38"), ("hrg", "N03")], ["field", "code"]),
        "multiple_still_births": codelist(spark, [("diag", "stillbirth", "P95")], ["field", "group", "code"]),
        "chronic": codelist(spark, [("J45", "LOS3", "respiratory")], ["code", "flag", "group"]),
        "presentations": codelist(spark, [("X60", "selfharm", ""), ("R10", "potentially_psych", "")], ["code", "group", "flag2"]),
        "presentations_medical": codelist(spark, [("A12.3", "opcs4")], ["code", "code_type"]),
        "emergency_admissions": codelist(spark, [("21",)], ["code"]),
    }


@pytest.fixture(scope="module")
def csv(spark):
    cin = spark.createDataFrame([("a", D(2010, 1, 1), True, False), ("c", D(2010, 1, 1), True, True), ("b", D(2001, 1, 1), True, True)],
                                "pmr string, referraldate date, need_episode boolean, cpp boolean")
    cla = spark.createDataFrame([("c", D(2012, 1, 1)), ("a", D(2020, 1, 1))], "pmr string, date_episode_started date")
    return {"cin": cin, "cla": cla}


@pytest.fixture(scope="module")
def school_run(spark, tables, codelists, csv, tmp_path_factory):
    study = Study(spark, tables, codelists, Config(), csv, str(tmp_path_factory.mktemp("study")))
    return study, {r.pmr: r for r in study.run().collect()}


def test_spine_and_links(school_run):
    _, people = school_run
    assert {p: (r.y7_year, r.tpid) for p, r in people.items()} == {"a": (2015, "ta"), "b": (2015, None), "c": (2016, "tc")}


def test_demographics(school_run):
    _, p = school_run
    assert (p["a"].female, p["a"].ethnicgroup, p["a"].languagegroup) == (1, "white", "English")
    assert (p["b"].female, p["b"].ethnicgroup) == (0, "other")  # Chinese twice, White once
    assert p["a"].dob_approx == D(2003, 10, 15)
    assert (p["a"].fsmeligible_y7, p["a"].idaci_decile_y7, p["c"].idaci_decile_y7) == (1, 2, None)
    assert [p[k].highest_sen_primary for k in "abc"] == ["S/EHCP", "Specialist provision", "Specialist provision"]
    assert [p[k].fsm_ever_primary for k in "abc"] == [False, True, False]


def test_hospital_parts(school_run):
    _, p = school_run
    assert (p["a"].gestat, p["a"].birweit, p["a"].matage, p["a"].imd_decile) == (40, 3300, None, 1)
    assert (p["c"].gestat, p["b"].gestat) == (None, None)
    assert [p[k].chc_chronic for k in "abc"] == [True, None, False]
    assert [p[k].chc_psych for k in "abc"] == [False, None, False]
    assert [p[k].chc_selfharm for k in "abc"] == [False, None, True]
    assert [p[k].chc_any for k in "abc"] == [True, None, True]
    assert [(p[k].ever_attended_cpc, p[k].date_first_cpc) for k in "abc"] == [(True, D(2011, 4, 1)), (None, None), (False, None)]


def test_school_parts(school_run):
    study, p = school_run
    assert [p[k].not_enrolled_y8 for k in "abc"] == [False, False, True]
    assert (p["a"].not_enrolled_n_yr, p["a"].ever_not_enrolled) == (3, True)
    assert [p[k].excluded_y8 for k in "abc"] == [True, False, False]
    assert study.load("exclusions").count() == 1
    # two enrolments summed: 310 possible, 31 missed; year 11 without summer: 100 possible, 10 missed
    assert (p["a"].sessionspossible_annual_8, p["a"].abs_overall_rate_8, p["a"].pa10_8) == (310, 10.0, True)
    assert (p["a"].sessionspossible_annual_11, p["a"].abs_overall_rate_11, p["a"].abs_auth_rate_11) == (100, 10.0, 0.0)
    assert p["b"].sessionspossible_annual_8 is None  # 500 sessions are implausible
    assert (p["a"].ever_pa10, p["b"].ever_pa10) == (True, None)
    assert (p["a"].att8, p["a"].glevel2em_ptq_ee, p["a"].ebacc_94) == (50.0, 1, 1)


def test_social_care_and_eligibility(school_run):
    _, p = school_run
    assert [p[k].highest_csc for k in "abc"] == ["CiN", "None", "CLA"]
    assert [p[k].ever_cpp for k in "abc"] == [False, False, True]
    assert [p[k].eligible for k in "abc"] == [True, False, True]


def test_one_row_per_person_in_every_part(school_run):
    study, _ = school_run
    for step, key in [("1_cohort_spine", "pmr"), ("demographics_modals", "pmr"), ("demographics_y7", "pmr"), ("birth_records", "tpid"), ("exams", "pmr"), ("social_care", "pmr")]:
        df = study.load(step)
        assert df.count() == df.select(key).distinct().count(), step


def test_birth_inception(spark, tables, codelists, csv, tmp_path):
    study = Study(spark, tables, codelists, Config(inception="birth"), csv, str(tmp_path))
    people = {r.tpid: r for r in study.run().collect()}
    # ta's records disagree on the mother's age, tc was stillborn
    assert set(people) == {"tq"}
    assert (people["tq"].dob_approx, people["tq"].academic_yob, people["tq"].y7_year, people["tq"].pmr) == (D(2004, 1, 15), 2004, 2016, None)
    assert people["tq"].eligible is False and people["tq"].excluded_y7 is None


def test_compat_switches(spark, tables, codelists, csv, tmp_path):
    cfg = replace(Config(), compat=ALL_COMPAT, strict_nulls=True, spell_mode="chain", ties="hash", seed=3)
    out = Study(spark, tables, codelists, cfg, csv, str(tmp_path)).run()
    got = [(r.pmr, r.tpid) for r in out.select("pmr", "tpid").collect()]
    assert sorted(got, key=str) == [("a", "ta"), ("a", "ta2"), ("b", None), ("c", "tc")]
    first = {r.tpid: r.matage for r in out.collect()}
    assert first["ta"] == 30  # first value kept where records disagree


def test_last_tie_rule_follows_the_census_order(spark, tables, codelists):
    from linkcohort.plans.demographics import modal_demographics

    spine = spark.createDataFrame([("b", 2015)], "pmr string, y7_year int")
    got = modal_demographics(tables, replace(Config(), ties="last"), spine).collect()[0]
    assert got.yearofbirth == 2003


def test_missing_inputs_are_skipped(spark, tables, codelists, csv, tmp_path):
    few = {n: t for n, t in tables.items() if "Census" in n or n == "bridging"}
    study = Study(spark, few, {"chronic": codelists["chronic"]}, Config(), {"cin": csv["cin"]}, str(tmp_path))
    out = study.run()
    assert {r.pmr for r in out.collect()} == {"a", "b", "c"}
    assert "not_enrolled_y8" in out.columns and not {"att8", "ever_excluded", "chc_any", "ever_cin"} & set(out.columns)


def test_root_wins_and_runs_do_not_replace_each_other(spark, tables, tmp_path):
    one, two = (Study(spark, tables, {}, root=str(tmp_path)) for _ in range(2))
    assert one.folder.startswith(str(tmp_path)) and one.folder != two.folder
    named = [Study(spark, tables, {}, root=str(tmp_path), name="n") for _ in range(2)]
    named[0].save(spark.range(1), "step")
    with pytest.raises(Exception, match="(?i)exist"):
        named[1].save(spark.range(1), "step")


def test_several_tables_of_a_module_are_all_read(spark, tables):
    from linkcohort.plans.school import exams

    more = spark.createDataFrame([("a", "2019/2020", 60.0, 0, 0), ("b", "2018/2019", 30.0, 1, 1)], tables["KS4Pupil_2015_to_2021"].schema)
    spine = spark.createDataFrame([("a", 2015), ("b", 2015)], "pmr string, y7_year int")
    got = exams({**tables, "KS4Pupil_2022": more}, Config(), spine)
    assert {(r.pmr, r.att8) for r in got.collect()} == {("a", 60.0), ("b", 30.0)}


def test_a_long_list_marks_the_same_births(spark):
    from linkcohort.plans.births import BIRTH_FIELDS, mark_births

    base = dict.fromkeys(BIRTH_FIELDS) | {"startage": 7001, "epitype": 1, "classpat": 1, "neocare": 8, "admimeth": "21"}
    rows = [("p", "N03", "e", ""), ("q", "A01", "e", "Z380"), ("r", "A01", None, "Z380"), ("r", "A01", None, ""), ("s", "A01", "e", "")]
    schema = "tpid string, codes string, " + ", ".join(f"{c} {t}" for c, t in BIRTH_FIELDS.items())
    df = spark.createDataFrame([(t, c, *[{**base, "hrgnhs": h, "epikey": k}[f] for f in BIRTH_FIELDS]) for t, h, k, c in rows], schema)
    none = codelist(spark, [("diag", "stillbirth", "P95")], ["field", "group", "code"])
    few = [("hrg", "N03"), ("diag", "Z38")]
    many = few + [("hrg", f"H{i:05d}") for i in range(30_000)]
    got = [sorted(r.tpid for r in mark_births(df, codelist(spark, c, ["field", "code"]), none).collect()) for c in (few, many)]
    assert got == [["p", "q", "r", "r"]] * 2


def test_options_reach_the_combined_dataset(spark, tables, codelists, csv, tmp_path):
    cfg = replace(
        Config(), hospital_demographics=True, attended_only=True, phenotype_to=D(2000, 1, 1), exclusion_kinds={"ever_none": ("no such kind",)},
        persistent_flags={"pa10_illness": "abs_illness_rate"},
    )
    placed = tables | {"Autumn_Census_2010": tables["Autumn_Census_2010"].withColumn("URN_AUT10", F.lit("9"))}
    register = spark.createDataFrame([(9, "Community special school", None), (9, "Community Special School", None), (8, "Nursery", "x")], "urn int, type1 string, type2 string")
    p = {r.pmr: r for r in Study(spark, placed, codelists, cfg, csv, str(tmp_path), register=register).run().collect()}
    assert p["a"].highest_sen_primary == "Specialist provision"  # found in the register alone
    assert (p["a"].hospital_imd_decile, p["a"].hospital_female, p["b"].hospital_imd_decile) == (1, None, None)
    assert p["a"].chc_chronic is False and p["b"].chc_chronic is None  # all its episodes are later
    assert not any(r.ever_none for r in p.values()) and "ever_pa10_illness" in p["a"].asDict()
