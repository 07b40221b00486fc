"""Conversation repair against all edits tried one by one."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from linkcohort.llm import dialogue, queries
from linkcohort.llm.dialogue import Costs
from tests.conftest import SMALL

COLUMNS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
GOOD = re.compile("(s?(ua)+)?")


def damaged(rows):
    """Per conversation its rows (turn, role, text) after damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, fault = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (turn, "user" if fault == 4 else role, text)
        out.setdefault(conv, []).extend([row] * (0 if fault == 0 else 2 if fault == 3 else 1))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(x[2].encode()).digest())) for c, r in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, costs, inserts):
    """Every sequence of edits, the least by (cost, audit)."""
    marks = faults(rows)
    options = [[(0, "", ())]]
    extra = [(len(c) * costs.insert, "I" * len(c), tuple((r, "") for r in c)) for n in range(inserts + 1) for c in itertools.product(("user", "assistant"), repeat=n)]
    options = [extra]
    for (_, role, text), mark in zip(rows, marks):
        here = [(costs.delete, "D", ())]
        if mark not in ("blank", "duplicate"):
            more = costs.truncated if mark == "truncated" else 0
            here += [(costs.keep + more, "K", ((role, text),)), *[(costs.rerole + more, "R", ((r, text),)) for r in ("user", "assistant")]]
        options += [here, extra]
    best = None
    for way in itertools.product(*options):
        cost, audit = sum(w[0] for w in way), "".join(w[1] for w in way)
        if best is None or (cost, audit) < best[:2]:
            out = [r for w in way for r in w[2]]
            if all(r[0] for r in out) and GOOD.fullmatch("".join(r[0][0] for r in out)):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in out))
    return best


def summary(rows, costs=Costs(), inserts=1):
    marks, turns = faults(rows), [t for t, _, _ in rows if t is not None]
    pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(rows, rows[1:])]
    cost, audit, text = cheapest(rows, costs, inserts)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *[marks.count(k) for k in ("blank", "duplicate", "truncated")], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())


def sample(seed, n, size):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant"]
    texts = ["Yes.", "No", "Why?", None, "", " \n", "A b c. ", "So  ", "é!", "end.\t"]
    return [(c if c else None, r.choice([None, *range(6)]) if r.random() < 0.3 else t, r.choice(roles) if r.random() < 0.4 else roles[t % 2], r.choice(texts)) for c in range(n) for t in range(r.randint(1, size))]


@pytest.fixture(scope="module")
def table(spark):
    schema = "conv_id long, turn long, role string, text string, conv string, h string, part string"
    return lambda rows: spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema).repartition(3)


def got(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_all_edits(table):
    rows = sample(1, 150, 4)
    rows += rows[7:12] + [(900, None, None, None), (901, 5, "user", "x" * 70_000 + ".")]
    rows = [r for r in rows if len(damaged(rows).get(r[0], ())) <= 4]
    left = damaged(rows)
    found = got(dialogue.repair_conversations(table(rows)))
    assert found == {c: summary(left[c]) for c in {r[0] for r in rows}}
    assert len(found) > 100 and any(v[5] == 0 for v in found.values())


def test_other_costs_insert(table):
    rows = sample(2, 60, 3)
    costs = Costs(rerole=4, delete=6, insert=1, truncated=1)
    left = damaged(rows)
    rows = [r for r in rows if len(left.get(r[0], ())) <= 3]
    found = got(dialogue.repair_conversations(table(rows), costs))
    assert found == {c: summary(left[c], costs, 2) for c in {r[0] for r in rows}}
    assert any("I" in v[6] for v in found.values())


@pytest.mark.parametrize("piece", [1, 3, 512])
def test_long_conversations_in_pieces(spark, table, piece):
    """Chains of pieces, one conversation in all partitions, give what a conversation in one piece gives."""
    rows = [(1, i, *x[2:]) for i, x in enumerate(sample(3, 90, 6))] + sample(4, 30, 8)
    df = table(rows)
    left = damaged(rows)
    for conv, found in got(dialogue.repair_conversations(df, piece=piece)).items():
        marks = tuple((role[:1], ["", "blank", "duplicate", "truncated"].index(m)) for (_, role, _), m in zip(left[conv], faults(left[conv])))
        cost, audit = dialogue.whole(marks, Costs())
        assert found[5:7] == (cost, audit)
        out = dialogue.Repaired()
        out.add([r for _, r, _ in left[conv]], [t for _, _, t in left[conv]], audit)
        assert found[7] == out.hash.hexdigest()
        assert found[1:4] == tuple(faults(left[conv]).count(k) for k in ("blank", "duplicate", "truncated"))


def test_empty_table_and_lost_conversations(spark, table):
    assert got(dialogue.repair_conversations(table([]))) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert got(dialogue.repair_conversations(table([(gone, 0, "user", "Hi.")]))) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = damaged(rows)
    found = got(queries.QUERIES["op11_conversations"](spark, SMALL))
    assert set(found) == {r[0] for r in rows}
    for conv, now in found.items():
        assert now[:5] == summary(left[conv][:0])[:5] if not left[conv] else now[1:4] == tuple(faults(left[conv]).count(k) for k in ("blank", "duplicate", "truncated"))
        if len(left[conv]) <= 4:
            assert now == summary(left[conv])
