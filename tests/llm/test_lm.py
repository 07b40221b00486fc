"""Language-model scores: counts and base scores against plain Python, the model against differences and held-out text."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from linkcohort.llm import lm, queries, recurrent
from tests.conftest import SMALL

rng = random.Random(3)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) + [None]


def base_scores(docs):
    """(held_out, n_tokens, n_known, train_tokens, base_score) of each document."""
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in docs]
    c = Counter(t for (_, text), h in zip(docs, held) if not h for t in tokens(text))
    n, v = sum(c.values()), len(c)
    out = []
    for (_, text), h in zip(docs, held):
        own = tokens(text)
        out.append((h, len(own), sum(c[t] > 0 for t in own), n, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in own)))
    return out


def compare(rows, docs):
    want = Counter((d, *w[:4], round(w[4], 6)) for (d, _), w in zip(docs, base_scores(docs)))
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    assert all(math.isfinite(r.score) and r.score < 1e-3 for r in rows)


@pytest.fixture(scope="module")
def docs():
    languages = [["".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(300)] for letters in ("abcdeé", "xyzwvü")]
    out = [(None, None), (1, ""), (None, "a b"), (2, "\x0b \x1c\x85 \xa0x"), (3, "Q" * 70_000 + " " + "q" * 70_000), (4, "ÀÉ àé É"), (7, " ".join(languages[0]) * 12)]
    for i in range(300):
        words = rng.choice(languages)
        out.append((i % 290 + 10, " ".join(words[min(int(rng.expovariate(0.02)), 299)].upper() if rng.random() < 0.1 else words[min(int(rng.expovariate(0.02)), 299)] for _ in range(rng.randint(0, 120)))))
    return out + out[20:24]


@pytest.mark.parametrize("settings", [lm.Settings(), lm.Settings(top=40, words=16, tails=4, rounds=3, replica=2_000)])
def test_counts_and_base(spark, docs, settings):
    df = spark.createDataFrame([(*d, "c", 1, "r") for d in docs], "doc_id long, text string, token string, c long, row string").repartition(4)
    compare(lm.score_documents(df, settings).collect(), docs)


def test_empty_and_nothing_to_learn(spark):
    assert lm.score_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    held = [(i, "some words") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = lm.score_documents(spark.createDataFrame(held, "doc_id long, text string")).collect()
    compare(rows, held)


@pytest.fixture(scope="module")
def layout():
    return recurrent.Layout(np.array([50, 40, 30, 20, 10, 5, 4, 3, 2, 1]), np.array([20, 7]), 2)


def test_chances_sum_to_one(layout):
    model = recurrent.Model(layout, layout.start() + np.random.default_rng(1).normal(0, 0.3, len(layout.start())))
    n = layout.words + layout.tails
    h = np.random.default_rng(2).normal(0, 1, (1, recurrent.WIDTH)).astype(np.float32)
    logp, _ = model.output(np.repeat(h, n, 0), np.arange(n))
    assert abs(np.exp(logp).sum() - 1) < 1e-5


def test_untrained_model_is_the_counts(layout):
    docs = [np.array([0, 1, 10, 11, 2], np.int32)]
    mass = np.array([51, 41, 31, 21, 11, 6, 5, 4, 3, 2, 20, 7])
    got = recurrent.log_likelihoods(recurrent.Model(layout, layout.start()), docs)[0]
    assert abs(got - np.log(mass[docs[0]] / mass.sum()).sum()) < 1e-3


def test_gradient(layout):
    r = np.random.default_rng(4)
    trainer = recurrent.Trainer(layout, layout.start() + r.normal(0, 0.2, len(layout.start())))
    docs = [r.integers(0, 12, 30).astype(np.int32) for _ in range(3)]
    window = next(recurrent.lanes(docs, layout.end))

    def loss(flat):
        given, target, _, first = window
        model = recurrent.Model(layout, flat)
        states, _ = model.run(given, (1 - first).astype(np.float32)[..., None], np.zeros((given.shape[1], recurrent.WIDTH), np.float32))
        return -model.output(states[target >= 0], target[target >= 0])[0].mean()

    flat = trainer.model.flat.copy()
    trainer.step = lambda: None
    trainer.learn([d[: recurrent.WINDOW] for d in docs])
    for i in r.choice(np.flatnonzero(trainer.grad), 60, replace=False):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-2
        down[i] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - trainer.grad[i]) < 2e-3


def test_state_is_carried_through_lanes(layout):
    """Each document scores alone what it scores among others, over many windows."""
    r = np.random.default_rng(5)
    model = recurrent.Model(layout, layout.start() + r.normal(0, 0.4, len(layout.start())))
    docs = [r.integers(0, 12, n).astype(np.int32) for n in [1, 2, 300, 17, 16, 15, *r.integers(1, 90, 400)]]
    together = recurrent.log_likelihoods(model, docs)
    alone = [recurrent.log_likelihoods(model, [d])[0] for d in docs]
    assert np.allclose(together, alone, rtol=1e-4)


def test_learns_held_out_text(spark):
    """On the given documents the model does better than the counts, on text it has not learned from."""
    rows = queries.QUERIES["op13_language"](spark, SMALL.replace("0.001", "0.01")).collect()
    held = [r for r in rows if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    assert sum(r.score for r in held) / tokens > sum(r.base_score for r in held) / tokens + 0.03
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text").collect()]
    compare(rows, docs)
