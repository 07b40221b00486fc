"""Benchmark decontamination: windows of benchmark words searched in training text, with DataFrame functions only."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.llm.common import ascii_lower, cut, free_names, let

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed value: digits, a to z and everything beyond ASCII
WINDOW = 10
PREFIX = 3  # words of a window that are looked up before the whole window is
BITS = 1 << 20  # of the table of prefixes, which has this size (128 KB) for any benchmark


def words_of(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def _prefix(words: Column, at, n: int) -> Column:
    """A hash of the first ``n`` words from position ``at`` on."""
    return F.xxhash64(*[F.get(words, at + i) for i in range(n)])


def _bits(h: Column) -> list[Column]:
    """The two bits of a prefix in the table."""
    return [F.pmod(h, F.lit(BITS)), F.pmod(F.shiftrightunsigned(h, 32), F.lit(BITS))]


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, size, gram: each distinct window of each item, the words joined by spaces.

    An item of fewer words than ``window`` is one window; one without words has none.
    """

    def grams(words):
        n = F.least(F.size(words), F.lit(window))
        starts = F.when(n > 0, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(n.alias("size"), F.array_join(F.slice(words, i + 1, n), " ").alias("gram")))

    rows = benchmark.select("item_id", F.explode(let(words_of("text"), grams)).alias("w"))
    return rows.select("item_id", "w.size", "w.gram").distinct()


def _prefix_table(grams: DataFrame, n: int) -> Column:
    """The bits of all prefixes of ``n`` words, as a constant array of longs of one fixed size."""
    h = _prefix(F.split("gram", " "), F.lit(0), n)
    cells = grams.select(F.explode(F.array(*_bits(h))).alias("bit"))
    cells = cells.select(F.shiftright("bit", 6).alias("cell"), F.expr("shiftleft(1L, cast(bit & 63 AS int))").alias("value"))
    table = [0] * (BITS >> 6)
    for cell, value in cells.groupBy("cell").agg(F.bit_or("value")).collect():
        table[cell] = value
    return F.from_json(F.lit(json.dumps(table)), "array<bigint>")


def candidates(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, found: the windows of each row whose prefix is in the table, with position, size and text.

    Every window position of the whole text is looked up; only those that may
    hit are written out in words.
    """
    sizes = sorted(r[0] for r in grams.select("size").distinct().collect())  # 1 to the window's words
    if not sizes:
        none = F.array().cast("array<struct<at: int, size: int, gram: string>>")
        return docs.select("doc_id", _key(docs), F.size(words_of("text")).alias("n_words"), none.alias("found"))
    by_prefix = {n: [s for s in sizes if min(s, PREFIX) == n] for n in sorted({min(s, PREFIX) for s in sizes})}
    tables = F.array(*[_prefix_table(grams.filter(F.col("size").isin(by_prefix[n])), n) for n in by_prefix])

    def scan(words, bits):
        places = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
        parts = []
        for k, n in enumerate(by_prefix):
            hits = F.filter(places, _listed(words, bits[k], n))
            parts += [F.transform(F.filter(hits, _fits(words, size)), _window(words, size)) for size in by_prefix[n]]
        return F.struct(F.size(words).alias("n_words"), (F.concat(*parts) if len(parts) > 1 else parts[0]).alias("found"))

    both = let(words_of("text"), lambda words: let(tables, lambda bits: scan(words, bits)))
    return docs.select("doc_id", _key(docs), both.alias("r")).select("doc_id", "text_key", "r.n_words", "r.found")


def _listed(words: Column, cells: Column, n: int):
    def both(h: Column) -> Column:
        one, two = (F.getbit(F.get(cells, F.shiftright(b, 6).cast("int")), F.pmod(b, F.lit(64)).cast("int")) == 1 for b in _bits(h))
        return one & two

    return lambda i: let(_prefix(words, i, n), both)


def _fits(words: Column, size: int):
    return lambda i: i + size <= F.size(words)


def _window(words: Column, size: int):
    return lambda i: F.struct(i.alias("at"), F.lit(size).alias("size"), F.array_join(F.slice(words, i + 1, size), " ").alias("gram"))


def _key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["text"], F.length(docs["text"])).alias("text_key")


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def hits(found: DataFrame, grams: DataFrame) -> DataFrame:
    """doc_id, text_key, spans, items of the rows with a window: distinct (at, size) and item ids as text.

    Windows are compared word by word in a join on their text.
    """
    rows = found.filter(F.size("found") > 0).select("doc_id", "text_key", F.explode("found").alias("w"))
    rows = rows.distinct().join(grams.withColumnRenamed("gram", "_gram"), F.col("w.gram") == F.col("_gram"))
    spans = F.collect_set(F.struct("w.at", "w.size")).alias("spans")
    return rows.groupBy("doc_id", "text_key").agg(spans, F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))


def covered(spans: Column) -> Column:
    """The positions of all words inside any of the spans."""
    return F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["at"], s["at"] + s["size"] - 1))))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs`` (doc_id, text).

    ``benchmark`` (item_id, text). The first words of every window of a text are
    looked up in a bit table of the benchmark's windows, of a fixed size whatever
    the benchmark's; windows that pass are joined to the benchmark's by their whole
    text. Spark broadcasts the benchmark's windows where their size allows and
    shuffles the few candidates otherwise; a window in very many documents is one
    key of that join, which AQE splits, and nothing is gathered but the hits of
    one document.

    NULL and empty texts have no words; items without an id hit but are not
    listed; repeated rows are judged each; an empty benchmark hits nothing; further
    columns are ignored.
    """
    grams = cut(windows_of(benchmark, window), "windows")
    found = cut(candidates(docs.select("doc_id", "text"), grams), "candidates")
    own = cut(hits(found, grams), "hits")
    out = found.join(own, _same(found, own), "left")
    items = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.size(covered(F.col("spans"))), F.lit(0)).cast("long")
    n_hit = F.when(F.col("spans").isNull(), F.lit(0).cast("long")).otherwise(n_hit)
    return out.select(
        found["doc_id"], F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, spans: bool = False, window: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated rows, or with ``spans`` without the words hit; all columns stay.

    Words are cut out of the text as it is, what is between them stays; ``n_chars``,
    if there, is counted anew.
    """
    grams = cut(windows_of(benchmark, window), "windows")
    found = cut(candidates(docs.select("doc_id", "text"), grams), "candidates")
    hit_id, hit_key, hit_spans, left = free_names(docs, "hit_id", "hit_key", "hit_spans", "rest")
    own = cut(hits(found, grams), "hits").select(F.col("doc_id").alias(hit_id), F.col("text_key").alias(hit_key), F.col("spans").alias(hit_spans))
    same = docs["doc_id"].eqNullSafe(F.col(hit_id)) & (_key(docs) == F.col(hit_key))
    if not spans:
        return docs.join(own.drop(hit_spans), same, "left_anti")

    def rest(text, spans):
        cased = F.lit(f"({WORD.replace('x60', 'x40').replace('x7B', 'x5B-\\x60\\x7B')})")
        words, between = F.regexp_extract_all(text, cased, F.lit(1)), F.split(text, cased, -1)
        return let(words, lambda w: let(between, lambda b: let(covered(spans), lambda hit: F.concat(
            F.array_join(F.transform(w, lambda x, i: F.concat(F.get(b, i), F.when(F.array_contains(hit, i), "").otherwise(x))), ""), F.get(b, F.size(w))))))

    text = F.when(F.col(hit_spans).isNull(), docs["text"]).otherwise(rest(docs["text"], F.col(hit_spans)))
    out = docs.join(own, same, "left").withColumn(left, text)
    cols = [F.col(left).alias("text") if c == "text" else F.length(left).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else docs[c] for c in docs.columns]
    return out.select(*cols)
