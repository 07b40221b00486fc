"""One key with a third of all rows: whole results, and work that is split."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from linkcohort import operators as op

N = 30_000


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    keys = ["hot"] * (N // 3) + [None] * (N // 10) + [f"k{rng.randint(0, 3000)}" for _ in range(N - N // 3 - N // 10)]
    rng.shuffle(keys)
    return [(k, i, rng.choice("abc"), rng.choice([0, 1, None])) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data, "id string, t long, v string, f int").repartition(8)


def groups(data):
    out = defaultdict(list)
    for row in data:
        out[row[0]].append(row)
    return out


def test_reductions(df, data):
    want = groups(data)
    got = {r.id: r.t for r in op.first_per(df, "id", ["t"]).collect()}
    assert got == {k: min(r[1] for r in g) for k, g in want.items()}
    got = {r.id: r.v for r in op.modal(df, "id", ["v"]).collect()}
    counts = {k: Counter(r[2] for r in g) for k, g in want.items()}
    assert got == {k: min(v for v in c if c[v] == max(c.values())) for k, c in counts.items()}
    got = {r.id: (r.lo, r.f) for r in op.resolve(df, "id", ["f"]).withColumn("lo", F.lit(0)).collect()}
    single = {k: {r[3] for r in g} - {None} for k, g in want.items()}
    assert {k: v for k, (_, v) in got.items()} == {k: next(iter(s)) if len(s) == 1 else None for k, s in single.items()}


def test_row_numbers(spark, data):
    rows = spark.createDataFrame([(k, 1 if k == "hot" else t % 3, t) for k, t, *_ in data], "id string, d int, t long")
    got = {(r.id, r.d, r.t): r.n for r in op.number_rows(rows, "id", "d", "t", "n", cells=16).collect()}
    assert len(got) == len(data)
    for k in ("hot", None, "k7"):
        mine = sorted(key for key in got if key[0] == k)
        assert [got[m] for m in mine] == list(range(1, len(mine) + 1))


def test_flags_for_people_without_an_id(spark, df, data):
    people = [(i, r[0]) for i, r in enumerate(data)]
    spine = spark.createDataFrame(people, "person long, id string")
    flags = op.flag_exists(spine, df, "id", {"ever_a": F.col("v") == "a"})
    has_a = {k: any(r[2] == "a" for r in g) for k, g in groups(data).items()}
    got = {r.person: r.ever_a for r in flags.collect()}
    assert got == {i: None if k is None else has_a[k] for i, k in people}


def test_a_hot_group_is_split_when_joined_back(spark, df, data):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = op.any_in_group(df, "id", {"hit": F.col("f") == 1})
        assert out.count() == len(data)
        rows = out.collect()
        text = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert "skew=true" in text
    want = {k: any(r[3] == 1 for r in g) for k, g in groups(data).items()}
    assert all(r.hit == want[r.id] for r in rows)
