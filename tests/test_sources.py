"""Discovery, harmonising, families with gaps, codelists, files."""

import pytest
from pyspark.sql import functions as F

from linkcohort import sources as src
from linkcohort.plans.study import Study
from tests.conftest import rows


def census(spark, suffix, data, ethnicity=True):
    names = ["PupilMatchingRefAnonymous", "AgeAtStartOfAcademicYear", "MonthPartOfAgeAtStartOfAcademicYear", "NCyearActual"]
    names += ["EthnicGroupMajor"] if ethnicity else []
    return spark.createDataFrame(data, ", ".join(f"{n}_{suffix} string" for n in names))


COLUMNS = {"pmr": "pupilmatchingrefanonymous", "ageatstart": "^ageatstartofacademicyear", "ncyearactual": "ncyearactual", "eth": "ethnicgroup"}


def test_discover_names_only(spark):
    names = ["Autumn_Census_2014", "Autumn_Census_2015", "Spring_Census_2015_Schools", "HES_APC_2015", "spring_census_2016"]
    tables = dict.fromkeys(names)
    assert src.discover(tables, "Autumn|Spring|Summer", [2015, 2016], "Schools") == ["Autumn_Census_2015", "spring_census_2016"]


def test_discover_accepts_views(spark):
    spark.range(1).createOrReplaceTempView("Autumn_Census_2015")
    found = src.discover(spark, "Autumn", [2015])
    assert [n.lower() for n in found] == ["autumn_census_2015"]
    assert src.open_table(spark, found[0]).count() == 1
    spark.catalog.dropTempView("Autumn_Census_2015")


def test_harmonise_fails_fast(spark):
    df = census(spark, "AUT15", [("p", "11", "3", "7", "WBRI")])
    assert rows(src.harmonise(df, COLUMNS, {"ageatstart": "int"})) == [("p", 11, "7", "WBRI")]
    with pytest.raises(ValueError, match="several"):
        src.harmonise(df, {"age": "ageatstartofacademicyear"})
    with pytest.raises(ValueError, match="no column"):
        src.harmonise(df, {"x": "idaci_"})
    assert rows(src.harmonise(df, {"pmr": "pupil", "x": "idaci_"}, {"x": "int"}, ["x"])) == [("p", None)]


def test_family_with_a_missing_column(spark):
    tables = {
        "Autumn_Census_2011": census(spark, "AUT11", [("a", "11", "1", "7", "WBRI"), ("b", "11", "1", "X", "CHNE"), ("c", "12", "1", "X", "CHNE")]),
        "Autumn_Census_2012": census(spark, "AUT12", [("a", "12", "1", "8"), ("d", "11", "1", "7")], ethnicity=False),
    }
    got = src.union_family(
        tables, src.discover(tables, "Autumn"), COLUMNS, {"eth": "string"},
        lambda n: ["eth"] if "2012" in n else [], src.year_group([7], "==", 11), ["pmr", "eth"],
    )
    got = got.select("pmr", "eth", src.census_year("source_table").alias("y"), src.census_term("source_table").alias("t"))
    assert rows(got) == [("a", "WBRI", 2011, "autumn"), ("b", "CHNE", 2011, "autumn"), ("d", None, 2012, "autumn")]


def test_year_group_by_age_is_numeric(spark):
    df = spark.createDataFrame([("X", "9"), ("X", "11"), ("X", "x"), ("R", "30"), ("8", "5")], "ncyearactual string, ageatstart string")
    assert rows(df.filter(src.year_group(["R", 1], "<", 11))) == [("R", "30"), ("X", "9")]


def test_numbered_and_lower(spark):
    assert src.numbered("diag", 20)[::19] == ["diag_01", "diag_20"]
    assert src.lower_names(spark.createDataFrame([(1, 2)], "A int, bC int")).columns == ["a", "bc"]


def test_codelists_and_csv_modules(spark, tmp_path):
    (tmp_path / "codes.csv").write_text('Code,group,flag2\nJ45.0,a,\n"X60",b,selfharm_xz_codes\n,c,\n')
    got = src.read_codelist(spark, str(tmp_path / "codes.csv"))
    assert rows(got, "code", "group", "flag2") == [("J450", "a", ""), ("X60", "b", "selfharm_xz_codes")]
    (tmp_path / "cin.csv").write_text("other,pmr,referraldate,cpp\n1,p,2010-03-04,TRUE\n2,,bad,FALSE\n")
    got = src.read_csv_module(spark, str(tmp_path / "cin.csv"), "pmr string, referraldate date, cpp boolean")
    assert [(r.pmr, str(r.referraldate), r.cpp) for r in got.collect()] == [("p", "2010-03-04", True), (None, "None", False)]


@pytest.mark.parametrize("fmt,compression", [("parquet", "none"), ("parquet", "gzip"), ("csv", "none"), ("csv", "gzip"), ("orc", None), ("json", None)])
def test_write_formats(spark, tmp_path, fmt, compression):
    df = spark.range(100).select(F.col("id"), F.concat(F.lit("r"), F.col("id")).alias("v"))
    src.write_table(df, str(tmp_path / "t"), fmt, compression)
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    assert reader.schema("id long, v string").format(fmt).load(str(tmp_path / "t")).count() == 100


def test_steps_cut_lineage(spark, tmp_path):
    saved = src.save_step(spark.range(5).withColumn("x", F.col("id") * 2), "m", str(tmp_path))
    assert "Range" not in saved._jdf.queryExecution().toString()
    assert src.load_step(spark, "m", str(tmp_path)).count() == 5


def test_shared_dir_prefers_the_session(spark, tmp_path):
    class Named:
        conf = {"spark.checkpoint.dir": "/shared/place/"}

    assert src.shared_dir(Named(), str(tmp_path)) == "/shared/place"
    if not spark.conf.get("spark.checkpoint.dir", None):
        assert src.shared_dir(spark, str(tmp_path)) == str(tmp_path)
        with pytest.raises(ValueError):
            src.shared_dir(spark)


def test_a_local_folder_is_refused_on_a_cluster():
    class Cluster:
        class sparkContext:
            master = "yarn"

    assert src.checked_root(Cluster, "hdfs://a/b/") == "hdfs://a/b"
    for path in ("/tmp/x", "file:///tmp/x"):
        with pytest.raises(ValueError):
            src.checked_root(Cluster, path)


@pytest.mark.parametrize("shared", ["/shared/place/", "file:///shared/place"])
def test_a_study_below_the_checkpoint_directory_of_a_cluster(shared):
    class Cluster:
        conf = {"spark.checkpoint.dir": shared}

        class sparkContext:
            master = "local-cluster[2,4,3000]"

    def folder(root):
        return Study(Cluster, {}, {}, root=root, name="mine").folder

    for root in ("/shared/place/a", "file:///shared/place/a/", "/shared/place"):
        assert folder(root) == f"{root.rstrip('/')}/mine"
    assert folder(None) == f"{shared.rstrip('/')}/mine"
    for root in ("/shared/placed", "/tmp/x", "/shared/place/../x"):
        with pytest.raises(ValueError):
            folder(root)
