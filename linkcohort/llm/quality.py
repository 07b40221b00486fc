"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkcohort.llm.common import arrow_schema, cut, free_names, map_arrow

BUCKETS = 1 << 14  # of hashed unigrams and bigrams
MAX_LABELLED = 20_000  # labelled documents of either kind that are used, at most
TEMPERATURE = 0.01  # mean log ratios are divided by it before Gumbel noise is added
WORDS_HELD = 400_000
TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^\s0-9a-z\x80-\xff]")


class _Hashes(dict):
    """64-bit hashes of words, remembered until there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


HASHES = _Hashes()


def gram_buckets(text: str | None) -> np.ndarray:
    """The bucket of each unigram (a lower-case word or a sign) and bigram of a text."""
    words = TOKEN.findall((text or "").encode("utf-8", "surrogatepass").lower())
    one = np.array([HASHES[w] for w in words], np.uint64)
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
    two = (two ^ (two >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (np.concatenate([one, two]) >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text, good in zip(batch.column(0), batch.column(1).to_pylist()):
            grams = np.bincount(gram_buckets(text.as_py()), minlength=BUCKETS)
            raw += grams
            if good:
                target += grams
    at = np.flatnonzero(raw)
    yield pa.record_batch([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])


def _kth_largest(df: DataFrame, column: str, k: int, small: int = 4_096) -> float:
    """The k-th largest value: bins are counted and the one that holds it is cut into bins again.

    Only counts of 1,024 bins, and a last bin of few rows, come to the driver.
    """
    x = F.col(column)
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    while True:
        here = df.filter((x >= lo) & (x <= hi))
        n = here.count()
        middle = lo + (hi - lo) / 2
        if n <= small or not lo < middle < hi:
            rows = here.select(column).orderBy(x.desc()).limit(min(k, small)).collect()
            return rows[-1][0] if len(rows) == k else lo
        edge = F.floor((x - lo) / F.lit((hi - lo) / 1024)).cast("int")
        bins = here.groupBy(F.least(edge, F.lit(1023)).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"))
        for b in sorted(bins.collect(), key=lambda b: -b["bin"]):
            if k <= b["n"]:
                lo, hi = b["lo"], b["hi"]
                break
            k -= b["n"]


def _best_cut(rows: list[tuple[float, int, int]]) -> float:
    """Where fewest good documents lie below and fewest bad ones above, midway to the next value below; rows of (value, good, bad)."""
    good = sum(r[1] for r in rows)
    best, at, below = -1, -math.inf, -math.inf
    right = good
    for value, g, b in sorted(rows):
        if right > best:
            best, at = right, value if below == -math.inf else (value + below) / 2
        right += b - g
        below = value
    return at


def score_documents(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, temperature: float = TEMPERATURE, seed: int = 0) -> DataFrame:
    """doc_id, text_key, n_grams, log_ratio, gumbel_key, kept of every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, quality, toxic): the target model counts the documents of
    quality 1 that are not toxic, the raw model counts all documents; those of
    quality 0 and toxic ones are bad. log_ratio is
    the mean log ratio of the two over the n-grams of a text. As many documents are
    kept as lie above the value that best parts the labelled ones, of which one half
    is for the target model and the other for this, drawn with
    weights exp(log_ratio / temperature) by Gumbel top-k: the noise is of the id
    and text, so that repeated rows share a draw.

    The target counts at most ``max_labelled`` good documents and the cut looks at as
    many bad ones (those with the smallest hashes); everything else covers all rows.
    Without good labels all documents with words are kept, as there is nothing to
    tell them by; without bad ones too. Texts without n-grams (NULL, empty, blank) have
    a NULL ratio and are not kept. All rows equal to the last value kept stay.
    """
    docs = docs.select(docs["doc_id"].alias("doc_id"), "text")
    half = F.xxhash64("doc_id", F.lit(seed + 1)) % 2 == 0
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.when(good, 1).when((F.col("quality") == 0) | (F.col("toxic") == 1), 0)).alias("good")).filter("good IS NOT NULL")
    sample = lambda kind: known.filter(F.col("good") == kind).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_labelled)
    labelled = cut(sample(1).unionByName(sample(0)), "labelled")
    rows = docs.join(F.broadcast(labelled), "doc_id", "left")  # 2 * max_labelled rows of an id and a mark, at most
    counts = map_arrow(rows.select("text", F.coalesce((F.col("good") == 1) & half, F.lit(False)).alias("good")), _count, "bucket long, raw long, target long")
    counts = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()  # BUCKETS rows at most
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for b, r, t in counts:
        raw[b] += r
        target[b] += t
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    if not any(t for _, _, t in counts):
        ratio[:] = 0
    schema = "doc_id long, text_key long, good int, n_grams long, log_ratio double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(schema)
        for batch in batches:
            n, mean = [], []
            for text in batch.column(3):
                grams = gram_buckets(text.as_py())
                n.append(len(grams))
                mean.append(float(ratio[grams].mean()) if len(grams) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64()), pa.array(mean, pa.float64())], schema=out)

    scored = map_arrow(rows.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "good", "text"), score, schema)
    bits = F.shiftrightunsigned(F.xxhash64("doc_id", "text_key", F.lit(seed)), 11)
    uniform = (bits + 0.5) / F.lit(float(2**53))
    scored = cut(scored.withColumn("gumbel_key", F.col("log_ratio") / temperature - F.log(-F.log(uniform))), "scores")
    seen = scored.filter("good IS NOT NULL AND log_ratio IS NOT NULL").filter(~half).groupBy(F.round("log_ratio", 3).alias("v"))
    seen = [tuple(r) for r in seen.agg(F.sum("good"), F.sum(1 - F.col("good"))).collect()]
    both = any(g for _, g, _ in seen) and any(b for _, _, b in seen)
    least = _best_cut(seen) if both else -math.inf
    k = scored.filter(F.col("log_ratio") >= least).count()
    last = _kth_largest(scored.filter("gumbel_key IS NOT NULL"), "gumbel_key", k) if k else math.inf
    return scored.select("doc_id", "text_key", "n_grams", "log_ratio", "gumbel_key", F.coalesce(F.col("gumbel_key") >= last, F.lit(False)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    own, key = free_names(docs, "kept_id", "kept_key")
    kept = score_documents(docs, labels).filter("kept").select(F.col("doc_id").alias(own), F.col("text_key").alias(key)).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(F.col(own)) & (F.xxhash64(docs["text"]) == F.col(key)), "left_semi")
