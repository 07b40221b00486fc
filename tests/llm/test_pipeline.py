"""The pipeline on awkward documents, each stage against plain Python on what it was given."""

import random
import re

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from linkcohort.llm import queries
from linkcohort.llm.common import free_names

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept_id string, _kept_id string, kept_key string, hit_id string, hit_key string, rest string, node string, comp string"
rng = random.Random(11)
WORDS = ["".join(rng.choice("abcdefghiklmnoprstuv") for _ in range(rng.randint(2, 8))) for _ in range(600)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


LEAK = prose(16, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    texts = [None, "", " \n\t ", "one", "x" * 40_000, prose(9_000, 2), f"{prose(60, 3)} {LEAK.upper()} {prose(60, 4)}", f"mail me at a.b@c.example.com or +1 (212) 555-1234 {prose(80, 5)}"]
    texts += [prose(80, 100 + i) for i in range(60)]
    for i in range(8, 20):  # exact and near copies
        words = texts[i].split()
        texts += [texts[i], " ".join(words[:-1] + ["other"]), " ".join(words + ["more", "words"])]
    rows = [(i, t, "en", "s", None if t is None else len(t), *"abcdefgh") for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (None, *rows[30][1:]), (None, prose(70, 900), *[None] * 11), (None, prose(70, 901), *[None] * 11)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 9 != 0), 0) for i in range(len(texts))]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([("i1", LEAK), ("i2", None), ("i3", "")], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def groups(rows):
    """Components of texts whose five-word shingles are alike by 0.8 or more; texts without words each on their own."""
    sets = [shingles(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], sets


def windows(text, size=10):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    n = min(size, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def test_each_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    given = docs.collect()

    kept = stages["quality"](spark, docs, folder)
    assert kept.columns == docs.columns
    assert not [r for r in kept.collect() if not shingles(r.text)]  # no words, no quality
    assert set(map(tuple, kept.collect())) <= set(map(tuple, given))

    # of all documents, also those that the classifier would reject
    out = stages["near_duplicates"](spark, docs, folder)
    assert out.columns == docs.columns
    comp, sets = groups(given)
    worded = {comp[i] for i in range(len(given)) if sets[i]}
    got = out.collect()
    assert len([r for r in got if shingles(r.text)]) == len(worded)  # one row of each group
    assert {tuple(sorted(shingles(r.text))) for r in got if shingles(r.text)} <= {tuple(sorted(s)) for s in sets}
    left, _ = groups(got)
    assert len(set(left)) == len(got)
    assert sum(not shingles(r.text) for r in got) == sum(not s for s in sets)

    out = stages["decontamination"](spark, docs, folder)
    leaks = windows(LEAK)
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(str(r) for r in given if not windows(r.text) & leaks)

    out = stages["personal_data"](spark, docs, folder).collect()
    assert len(out) == len(given)
    for r in out:
        assert "@c.example" not in (r.text or "") and "555-1234" not in (r.text or "")
    clean = {r.doc_id: r.text for r in given if r.doc_id is not None and r.doc_id != 7}
    assert all(r.text == clean[r.doc_id] for r in out if r.doc_id in clean)

    theirs = Tokenizer.from_file(queries.vocabulary())
    for r in stages["tokens"](spark, docs.filter("length(text) < 2000 OR text IS NULL"), folder).collect():
        text = next(x.text for x in given if x.doc_id == r.doc_id and r.doc_id is not None) if r.doc_id is not None else None
        if r.doc_id is not None:
            assert list(r.ids) == theirs.encode(text or "", add_special_tokens=False).ids


def test_run_and_an_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = docs
    for name, stage in corpus_pipeline.STAGES:
        want = stage(spark, want, folder)
    rows = lambda df: sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect())
    got = rows(corpus_pipeline.run(spark, folder))
    assert got == rows(want) and 20 < len(got) < docs.count()
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_free_names(spark):
    df = spark.range(1).select(F.col("id").alias("Kept"), F.col("id").alias("_kept"))
    assert free_names(df, "kept", "other") == ["__kept", "other"]
