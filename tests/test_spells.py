"""Date repair, and both kinds of spell against walking the episodes in Python."""

import datetime as dt
import random
from collections import defaultdict

from linkcohort.operators import join_spells, repair_dates
from tests.conftest import rows

D = dt.date
SCHEMA = "tpid string, epistart date, epiend date, admidate date, disdate date"


def test_repair(spark):
    data = [
        ("in_order", "2010-01-02", "2010-01-03", "2010-01-01", "2010-01-05"),
        ("no_discharge", "2010-01-02", "2010-01-03", "2010-01-01", ""),
        ("unknown_end", "2010-01-02", "1801-01-01", "2010-01-01", "2010-01-05"),
        ("no_admission", "2010-01-02", "2010-01-03", "", "2010-01-05"),
        ("turned", "2010-01-04", "2010-01-02", "2010-01-05", "2010-01-01"),
        ("late_start", "2010-01-09", "2010-01-03", "2010-01-01", "2010-01-05"),
        ("bad_text", "2010-02-30", "2010-01-03", "2010-01-01", "2010-01-05"),
    ]
    df = spark.createDataFrame(data, "tpid string, epistart string, epiend string, admidate string, disdate string")
    assert rows(repair_dates(df)) == [
        ("in_order", D(2010, 1, 2), D(2010, 1, 3), D(2010, 1, 1), D(2010, 1, 5)),
        ("late_start", D(2010, 1, 1), D(2010, 1, 5), D(2010, 1, 1), D(2010, 1, 5)),
        ("no_discharge", D(2010, 1, 2), D(2010, 1, 3), D(2010, 1, 1), D(2010, 1, 3)),
        ("turned", D(2010, 1, 2), D(2010, 1, 4), D(2010, 1, 1), D(2010, 1, 5)),
    ]


def random_episodes(n_people=300, seed=7):
    rng, out = random.Random(seed), []
    for p in range(n_people):
        for _ in range(rng.randint(1, 9)):
            adm = D(2010, 1, 1) + dt.timedelta(rng.randint(0, 40))
            dis = adm + dt.timedelta(rng.choice([0, 1, 2, 5, 9, 20]))
            start = adm + dt.timedelta(rng.randint(0, 2))
            out.append((f"p{p}", start, max(start, dis + dt.timedelta(rng.choice([-1, 0, 0, 3]))), adm, dis))
        if rng.random() < 0.3:
            out.append(out[-1])
    return out


def walk_chains(episodes):
    """Spell bounds by visiting each episode and following its links forward."""
    people = defaultdict(set)
    for e in episodes:
        people[e[0]].add(e)
    result = {}
    for eps in people.values():
        eps = sorted(eps, key=lambda e: (e[3], e[4], e[1], e[2]))
        longest = {a: max(e[4] for e in eps if e[3] == a) for a in {e[3] for e in eps}}
        reach = [longest[e[3]] for e in eps]
        linked = [i + 1 < len(eps) and reach[i] >= eps[i + 1][3] for i in range(len(eps))]
        end = list(reach)
        for i in range(len(eps)):
            stop = i
            while linked[stop]:
                stop += 1
            if stop > i:
                end[i:stop + 1] = [max(reach[i:stop + 1])] * (stop + 1 - i)
        start = [min(eps[j][3] for j in range(len(eps)) if end[j] == end[i]) for i in range(len(eps))]
        late = [max(end[i], eps[i][2]) for i in range(len(eps))]
        for i, e in enumerate(eps):
            result[e] = (start[i], max(late[j] for j in range(len(eps)) if start[j] == start[i]))
    return result


def merged(episodes):
    """Spell bounds by sweeping each person's admissions in date order."""
    people = defaultdict(set)
    for e in episodes:
        people[e[0]].add(e)
    result = {}
    for eps in people.values():
        spells = []
        for e in sorted(eps, key=lambda e: e[3]):
            if spells and e[3] <= spells[-1]["reach"]:
                spells[-1]["reach"] = max(spells[-1]["reach"], e[4])
            else:
                spells.append({"reach": e[4], "eps": []})
            spells[-1]["eps"].append(e)
        for s in spells:
            end = max(s["reach"], max(e[2] for e in s["eps"]))
            result |= {e: (s["eps"][0][3], end) for e in s["eps"]}
    return result


def by_episode(df):
    return {(r.tpid, r.epistart, r.epiend, r.admidate, r.disdate): (r.spell_start, r.spell_end) for r in df.collect()}


def test_chain_equals_walking(spark):
    episodes = random_episodes()
    got = by_episode(join_spells(spark.createDataFrame(episodes, SCHEMA), mode="chain"))
    assert got == walk_chains(episodes)


def test_merge_equals_sweeping(spark):
    episodes = random_episodes(seed=8)
    df = join_spells(spark.createDataFrame(episodes, SCHEMA))
    assert by_episode(df) == merged(episodes)
    assert df.count() == len(set(episodes))


def test_modes_differ_on_a_nested_stay(spark):
    data = [("p", a, b, a, b) for a, b in [(D(2010, 1, 1), D(2010, 1, 30)), (D(2010, 1, 5), D(2010, 1, 6)), (D(2010, 1, 10), D(2010, 1, 12))]]
    df = spark.createDataFrame(data, SCHEMA)
    assert set(by_episode(join_spells(df)).values()) == {(D(2010, 1, 1), D(2010, 1, 30))}
    assert len(set(by_episode(join_spells(df, mode="chain")).values())) > 1


def test_people_without_id_are_dropped_and_chain_may_reach_the_last_row(spark):
    data = [(None, D(2010, 1, 1), D(2010, 1, 2), D(2010, 1, 1), D(2010, 1, 2)), ("z", D(2010, 1, 1), D(2010, 1, 9), D(2010, 1, 1), D(2010, 1, 9)),
            ("z", D(2010, 1, 3), D(2010, 1, 4), D(2010, 1, 3), D(2010, 1, 4))]
    df = spark.createDataFrame(data, SCHEMA)
    assert all(k[0] == "z" for k in by_episode(join_spells(df, mode="chain")))


def test_one_person_with_a_third_of_all_rows(spark):
    """Hot person: many episodes on few days; same result as sweeping."""
    rng = random.Random(3)
    hot = []
    for i in range(4000):
        adm = D(2010, 1, 1) + dt.timedelta(rng.randint(0, 300))
        dis = adm + dt.timedelta(rng.randint(0, 1))
        hot.append(("hot", adm, dis, adm, dis))
    episodes = hot + random_episodes(2000, seed=4)
    for parts in (1, 7, 200):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            assert by_episode(join_spells(spark.createDataFrame(episodes, SCHEMA))) == merged(episodes)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
