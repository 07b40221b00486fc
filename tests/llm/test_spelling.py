"""Spelling variants against all pairs of words compared one by one."""

import random
import re
import zlib
from collections import Counter

import pytest

from linkcohort.llm import spelling

rng = random.Random(7)


def brute(docs):
    held = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                held[run] += 1
    words = {w: n for w, n in held.items() if n >= 5}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def edit(word):
    at, letter = rng.randrange(len(word)), rng.choice("abé÷zz")
    return rng.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :]])


@pytest.fixture(scope="module")
def texts():
    words = ["".join(rng.choice("abzé") for _ in range(rng.randint(5, 9))) for _ in range(60)] + ["aaaaaaaa", "bbbbbbbbb", "Abcdefghijklmnopqrstuvwxyzabcdefghij" * 2, "ÀÿÖ×÷ßab"]
    words += [edit(w) for w in words for _ in range(3)]
    words += [edit(w) for w in words]
    rows = [(None, None), (1, ""), (2, "short a b c"), (None, "zzzzzz " * 6), (3, "ccccccc " * 700 + "cccccccc " * 100 + "ccccccccc " * 10 + "x" * 70_000)]
    for i in range(150):
        rows.append((i % 140 + 10, rng.choice([" ", ", ", "Ā", "7", "😀"]).join(rng.choice(words[: rng.choice([5, 40, len(words)])]) for _ in range(rng.randint(1, 90)))))
    return rows + rows[10:14]


def test_all_pairs(spark, texts):
    df = spark.createDataFrame([(*r, "w", 1, "f") for r in texts], "doc_id long, text string, word string, n long, form string").repartition(5)
    want = brute(texts)
    rows = spelling.group_variants(df).collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(rows) == len(got) and got == want
    assert sum(v[0] is not None for v in want.values()) > 20 and any(v[1] != v[0] and v[0] for v in want.values())


def test_empty(spark):
    assert spelling.group_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_each_pair_meets_once(spark):
    """Also where a letter is lost from a long run of equal ones."""
    words = ["a" * n for n in range(6, 40)] + ["ab" * 9, "ab" * 9 + "b", "b" + "ab" * 9, "a" * 10 + "b" + "a" * 9, "abcdefgh" * 3]
    pairs = spelling.near_pairs(spark.createDataFrame([(w, 5) for w in words], "word string, n long")).select("a", "b").collect()
    got = Counter(frozenset(p) for p in pairs)
    assert set(got.values()) == {1}
    assert {frozenset(("a" * n, "a" * (n + 1))) for n in range(6, 39)} <= set(got) and frozenset(("ab" * 9, "ab" * 9 + "b")) in got
