"""Document fingerprints by context-triggered piecewise hashing, compared by edit distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkcohort.llm.common import arrow_schema, cut, map_arrow

WINDOW = 7  # bytes the rolling hash sees
SMALLEST = 3  # the smallest block size; each further one is twice the one before
LONGEST = 64  # chunks of a signature, at most
COMMON = 4  # chunks in a row that two signatures must share to be alike at all
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
CHUNK_CHARS = 1_500_000  # characters hashed at once, but for a longer text


class _Powers:
    """Powers of a base modulo 2**64, as many as were asked for so far."""

    def __init__(self, base: np.uint64):
        self.base, self.table = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            steps = np.full(max(n, 1 << 20), self.base, np.uint64)
            steps[0] = 1
            self.table = np.cumprod(steps, dtype=np.uint64)
        return self.table[:n]


POWERS, INVERSES = _Powers(BASE), _Powers(INVERSE)


def _rolling(d: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the last ``WINDOW`` bytes at each position: their sum, weighted sum and shifted xor."""
    wide = d.astype(np.uint32)
    plain, weighted, shifted = wide.copy(), wide * np.uint32(WINDOW), wide.copy()
    for k in range(1, WINDOW):
        back = wide[:-k]
        plain[k:] += back
        weighted[k:] += back * np.uint32(WINDOW - k)
        shifted[k:] ^= back << np.uint32(5 * k)
    return plain + weighted + shifted


def _signatures(ends: np.ndarray, docs: np.ndarray, start: np.ndarray, stop: np.ndarray, sums: np.ndarray) -> list[str]:
    """A letter for each chunk; ``ends`` are the triggered chunk ends in order, ``docs`` whose they are."""
    first = np.searchsorted(docs, np.arange(len(start)))
    keep = np.arange(len(ends)) - first[docs] < LONGEST - 1
    ends, docs = ends[keep], docs[keep]
    last = np.flatnonzero(stop > start)  # what follows the last trigger is a chunk as well
    ends, docs = np.concatenate([ends, stop[last]]), np.concatenate([docs, last])
    order = np.lexsort((ends, docs))
    ends, docs = ends[order], docs[order]
    new = np.ones(len(ends), bool)
    new[1:] = (ends[1:] != ends[:-1]) | (docs[1:] != docs[:-1])
    ends, docs = ends[new], docs[new]
    begin = np.empty_like(ends)
    begin[1:] = ends[:-1]
    head = np.ones(len(ends), bool)
    head[1:] = docs[1:] != docs[:-1]
    begin[head] = start[docs[head]]
    value = (sums[ends] - sums[begin]) * INVERSES.upto(len(sums))[begin]
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    text = LETTERS[(value >> np.uint64(58)).astype(np.int64)].tobytes().decode()
    at = np.searchsorted(docs, np.arange(len(start) + 1)).tolist()
    return [text[a:b] for a, b in zip(at, at[1:])]


def fingerprints(texts: Sequence[str]) -> list[str]:
    """``block size:signature:signature at twice the block size`` of each text.

    A chunk ends where the rolling hash plus one is a multiple of the block size.
    The block size is the largest that gives about half of the longest signature,
    so it follows the length of the text. All texts are hashed together, with
    zero bytes between them that the rolling hash does not see.
    """
    if not texts:
        return []
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    gap = bytes(WINDOW)
    d = np.frombuffer(gap + gap.join(raw) + gap, np.uint8)
    start = np.cumsum(size + WINDOW) - size
    stop = start + size
    trigger = _rolling(d) + np.uint32(1)
    hit = trigger % np.uint32(SMALLEST) == 0
    at = np.flatnonzero(hit)
    doc = np.searchsorted(start, at, "right") - 1
    inside = (doc >= 0) & (at < stop[doc])
    at, doc = at[inside], doc[inside]
    low = trigger[at]
    low = np.where(low == 0, np.uint32(1 << 31), low & (~low + np.uint32(1)))
    level = np.frexp(low.astype(np.float64))[1] - 1
    counts = np.bincount(doc * 33 + level, minlength=33 * len(raw)).reshape(-1, 33)
    above = counts[:, ::-1].cumsum(1)[:, ::-1]
    wanted = np.ceil(np.log2(np.maximum(size / (SMALLEST * LONGEST), 1))).astype(np.int64)
    fits = (above >= LONGEST // 2 - 1) & (np.arange(33) <= wanted[:, None])
    k = np.where(fits.any(1), 32 - fits[:, ::-1].argmax(1), 0)
    sums = np.zeros(len(d) + 1, np.uint64)
    np.cumsum((d.astype(np.uint64) + np.uint64(1)) * POWERS.upto(len(d)), dtype=np.uint64, out=sums[1:])
    one, two = ((at[m] + 1, doc[m]) for m in (level >= k[doc], level >= k[doc] + 1))
    first, second = _signatures(*one, start, stop, sums), _signatures(*two, start, stop, sums)
    return [f"{SMALLEST << i}:{a}:{b}" for i, a, b in zip(k.tolist(), first, second)]


def _common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence, 64 columns at a time in one number."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        if m := where.get(c):
            hit = row & m
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    """One less the insertions and deletions that turn a into b, as a share of both lengths."""
    if a == b:
        return 1.0 if a else 0.0
    runs = {a[i:i + COMMON] for i in range(len(a) - COMMON + 1)}
    if not any(b[i:i + COMMON] in runs for i in range(len(b) - COMMON + 1)):
        return 0.0
    return 2 * _common_letters(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1: of signatures at the same block size; 0 where the block sizes are more than twofold apart."""
    if a == b:
        return 1.0
    (i, a1, a2), (j, b1, b2) = a.split(":"), b.split(":")
    x, y = int(i), int(j)
    if x == y:
        return max(_alike(a1, b1), _alike(a2, b2))
    if x == 2 * y:
        return _alike(a1, b2)
    return _alike(a2, b1) if y == 2 * x else 0.0


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many of the first characters of the next."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_WITH_EDGES = _OUT + ", part int, edge string, text string"
_EDGE = (None,) * 6


def _compare(rows: Sequence[tuple], following: Sequence[str]) -> Iterator[tuple]:
    """Result rows of (doc_id, text) rows, each with the text that follows it."""
    texts = [t for _, t in rows]
    changed = [edited(t, f) for t, f in zip(texts, following)]
    prints = fingerprints([*texts, *changed, *following[-1:]])
    n = len(rows)
    after = [prints[i + 1] if i + 1 < n and following[i] == texts[i + 1] else prints[-1] for i in range(n)]
    for i, (doc, text) in enumerate(rows):
        sha = hashlib.sha256(changed[i].encode("utf-8", "surrogatepass")).hexdigest()
        yield doc, len(text), sha, prints[i], prints[n + i], likeness(prints[i], prints[n + i]), likeness(prints[i], after[i])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    rows, held = [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py() or ""
            rows.append((doc.as_py(), text))
            held += len(text)
            if held >= CHUNK_CHARS or len(rows) >= 2_000:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def _sorted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, part, pending = arrow_schema(_WITH_EDGES), TaskContext.get().partitionId(), None
    for rows in _chunks(batches):
        out = []
        if pending is None:
            out.append((rows[0][0], *_EDGE, part, "first", rows[0][1]))
        else:
            rows = [pending, *rows]
        pending = rows[-1]
        if len(rows) > 1:
            out += [(*r, part, None, None) for r in _compare(rows[:-1], [t for _, t in rows[1:]])]
        if out:
            yield _batch(out, schema)
    if pending is not None:
        yield _batch([(pending[0], *_EDGE, part, "last", pending[1])], schema)


def _edge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_OUT)
    for batch in batches:
        for doc, text, following in zip(*[c.to_pylist() for c in batch.columns]):
            yield _batch(list(_compare([(doc, text)], [following])), schema)


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row of ``docs`` (doc_id, text).

    The next document is the one that follows by descending doc_id, and the first
    after the last. Texts are shuffled once, into ranges of doc_id, and each task
    pairs the rows as they come; the rows at the edges of ranges, two a task, are
    written and paired by a join. Ranges have an even number of rows whatever the
    ids, unless very many rows share an id.

    NULL text is empty, a NULL id comes last, repeated ids are put in order by
    their text's hash; a single row follows itself; no rows give none; further
    columns are ignored.
    """
    tie = F.xxhash64("text")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").desc_nulls_last(), tie]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = cut(map_arrow(rows, _sorted_rows, _WITH_EDGES), "fingerprints")
    parts = sorted(r[0] for r in found.filter("edge = 'first'").select("part").collect())  # a number for each task
    spark = docs.sparkSession
    ring = spark.createDataFrame(pa.table({"part": pa.array(parts, pa.int32()), "then": pa.array(parts[1:] + parts[:1], pa.int32())}))
    last = found.filter("edge = 'last'").select("part", "doc_id", "text")
    first = found.filter("edge = 'first'").select(F.col("part").alias("then"), F.col("text").alias("following"))
    pairs = last.join(ring, "part").join(first, "then").select("doc_id", "text", "following")
    return found.filter("edge IS NULL").select(*[c.strip().split(" ")[0] for c in _OUT.split(",")]).unionByName(map_arrow(pairs, _edge_rows, _OUT))
