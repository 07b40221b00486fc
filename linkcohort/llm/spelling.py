"""Spelling variants: words one edit apart, found by asymmetric chunks and grams, each led to its commonest form."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.llm.common import arrow_schema, cut, map_arrow

LEAST = 6  # code points of a word
SEEN = 5  # occurrences of a word, over all documents
TIMES = 5  # a form occurs so many times as often as the word
DAMAGED = 199  # one of so many words of a document loses a letter
HELD = 400_000  # words a task counts before it hands its counts on
RUNS = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST)  # of Latin-1 bytes in lower case


def damaged_runs(doc_id: str, text: str) -> Iterator[tuple[bytes, int]]:
    """Each long enough run of a text with its count, as Latin-1 bytes, a letter of some removed by the contract's rule.

    Characters beyond U+00FF become "?" and end a run, as they do in the text.
    """
    before = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(RUNS.findall(text.encode("latin-1", "replace").lower())).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
        if h % DAMAGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST:
                continue
        yield run, n


def count_words(docs: DataFrame) -> DataFrame:
    """``word``, ``n``: the distinct damaged runs of all whole texts that occur often enough."""
    schema = "word string, n long"

    def batch(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())], schema=arrow_schema(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(*b.columns):
                for word, n in damaged_runs(doc_id.as_py(), text.as_py()):
                    held[word] += n
                if len(held) >= HELD:
                    yield batch(held)
                    held.clear()
        yield batch(held)

    rows = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("doc_id"), docs["text"].alias("text")).filter("text IS NOT NULL")
    return map_arrow(rows, run, schema).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= SEEN)


def _cuts(length: Column) -> Column:
    """Into how many parts a word of a length is cut: two chunks, each cut in two or more, so that a part has at most four letters."""
    return F.greatest(F.lit(4), F.pow(F.lit(2), F.floor(F.log2(length)) - 1).cast("int"))


def _keys(words: DataFrame, length: Column, spared: Column) -> DataFrame:
    """A key for each part that an edit may have hit, of all that stands before and behind it.

    ``length`` is the longer word's, whose parts they are; what stands behind is
    ``spared`` places further left in the other word.
    """
    parts = words.withColumn("long", length).withColumn("part", F.explode(F.sequence(F.lit(0), _cuts(F.col("long")) - 1)))
    edge = lambda k: F.floor(k * F.col("long") / _cuts(F.col("long"))).cast("int")
    parts = parts.withColumn("from", edge(F.col("part"))).withColumn("to", edge(F.col("part") + 1))
    key = F.xxhash64("long", "part", F.substring("word", F.lit(1), F.col("from")), F.substring("word", F.col("to") - spared + 1, F.length("word")))
    return parts.select(key.alias("key"), "word", "n", "from")


def near_pairs(words: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n_a``, ``n_b``: each pair of words that differ by exactly one inserted, deleted or replaced letter, once.

    Of two words the longer one, or the first in order, is cut into two disjoint
    chunks, and the other gives the grams that could equal them, in place or one
    place to the left: one edit spares a chunk, and the words meet there. What the
    edit has hit is again a word one edit away, so it is cut in turn, down to a few
    letters; this splits the words that share a frequent chunk, and no group of
    them is paired out. Lengths and places are part of the key. Pairs that meet are
    compared letter by letter.
    """
    size = F.length("word")
    longer = _keys(words, size, F.lit(0)).select("key", F.col("word").alias("a"), F.col("n").alias("n_a"), "from")
    shift = words.withColumn("shift", F.explode(F.array(F.lit(0), F.lit(1))))
    parts = [_keys(shift.filter(f"shift = {k}"), size + k, F.lit(k)).select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), F.lit(k).alias("shift")) for k in (0, 1)]
    met = longer.join(parts[0].unionByName(parts[1]), "key")
    # a letter lost from a run of equal ones may lie in several parts; the first of them counts
    first = (F.col("from") == 0) | (F.expr("substring(a, from + 1)") != F.expr("substring(b, from)"))
    ordered = F.when(F.col("shift") == 0, F.col("a") < F.col("b")).otherwise(first)
    return met.filter(ordered & (F.levenshtein("a", "b", 1) == 1)).select("a", "b", "n_a", "n_b")


def follow(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: where following ``form`` from each word ends. A form occurs several times as often, so no way is long."""
    now = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = cut(now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not joined.filter("moved").limit(1).count():
            return joined.select("word", "root")
        now = joined.select("word", "root")


def group_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text).

    Texts are read whole; NULL texts have no words, a NULL doc_id is written as
    nothing, repeated rows count each, further columns are ignored, and an empty
    table has no words. Ties of the commonest near word go to the first in code
    point order. Tasks hand on counts, so a word in a third of all places is a few
    rows; of each word a few keys are shuffled, and no key has many words.
    """
    words = cut(count_words(docs), "words")
    pairs = near_pairs(words)
    both = pairs.select(F.explode(F.array(*[
        F.struct(F.col(x).alias("word"), F.col(y).alias("near"), F.col(f"n_{y}").alias("near_n")) for x, y in (("a", "b"), ("b", "a"))
    ])).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    common = -F.col("best.less") >= TIMES * F.col("n")
    found = cut(
        words.join(best, "word", "left").select(
            "word", F.when(common, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(common, -F.col("best.less")).alias("form_n")
        ),
        "variants",
    )
    roots = follow(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
