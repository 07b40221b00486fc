"""Near-duplicate documents: MinHash bands for candidates, sequential Bayesian pruning, exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkcohort.llm.common import arrow_schema, components, cut, free_names, map_arrow

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
WORDS_HELD = 400_000
STEP = 4_096  # shingles hashed by all functions at once
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


@dataclass(frozen=True)
class Settings:
    """Documents are linked where ``100 * intersection >= percent * union`` of their shingles."""

    words: int = 5
    percent: int = 80
    bands: int = 28
    rows: int = 4  # hashes of a band; a pair at the threshold shares one with all but 1e-6 or less
    batch: int = 16  # hashes compared before the posterior is looked at again
    miss: float = 1e-9  # a pair is dropped when it is as unlikely as this to reach the threshold
    block: int = 1_024  # documents compared with one another in one task, about
    pivots: int = 32  # documents of a larger cluster that each of its blocks gets

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


HASHES = _Hashes()


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all k-word shingles; fewer words are one shingle, no words none.

    Words are runs of characters other than ASCII white space, A-Z in lower case.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([HASHES[w] for w in words], np.uint64)
    if len(h) < k:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes())], np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = (out ^ h[i:len(h) - k + 1 + i]) * MIX[0]
        out ^= out >> np.uint64(29)
    out *= MIX[1]
    out ^= out >> np.uint64(32)
    return np.unique(out)


@cache
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """What each hash function flips and multiplies by."""
    draw = lambda kind: np.array([[xxhash.xxh32_intdigest(f"{kind}{i}")] for i in range(n)], np.uint32)
    return draw("flip"), draw("odd") | np.uint32(1)


def minhashes(items: np.ndarray, n: int) -> np.ndarray:
    """The smallest value of each of ``n`` hash functions over the items; none may be missing."""
    flip, odd = _functions(n)
    x = (items >> np.uint64(32)).astype(np.uint32) ^ items.astype(np.uint32)
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), STEP):
        y = (x[None, at:at + STEP] ^ flip) * odd
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        np.minimum(out, y.min(1), out=out)
    return out


def least_matches(s: Settings) -> list[int]:
    """For each number of batches compared, the fewest equal hashes with which a pair may still be linked.

    With a uniform prior the chance that the similarity reaches t, m of n hashes
    being equal, is that of at most m successes in n + 1 draws of chance t.
    """
    t, out = s.percent / 100, []
    for n in range(s.batch, s.hashes + 1, s.batch):
        total, m = 0.0, -1
        while total < s.miss:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


_SIGNED = "doc_id long, text_key long, n_shingles long, node binary, signature binary"


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, text_key, n_shingles, node, signature; equal sets have equal nodes, texts without words have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_SIGNED)
        for batch in batches:
            n, nodes, signs = [], [], []
            for text in batch.column(2):
                items = shingles(text.as_py(), s.words)
                n.append(len(items))
                nodes.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
                signs.append(minhashes(items, s.hashes).tobytes() if len(items) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), pa.array(signs, pa.binary())], schema=schema)

    return map_arrow(docs.select(docs["doc_id"].cast("long"), text_key(docs).alias("text_key"), "text"), run, _SIGNED)


def text_key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["text"], F.length(docs["text"]))


def candidate_edges(nodes: DataFrame, s: Settings) -> DataFrame:
    """a, b: each node of a band's bucket and the smallest of the bucket, so that no bucket emits its pairs."""
    width = 4 * s.rows
    hashed = F.transform(F.sequence(F.lit(0), F.lit(s.bands - 1)), lambda i: F.xxhash64(i, F.expr("signature").substr(i * width + 1, F.lit(width))))
    bands = nodes.select("node", F.explode(hashed).alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a != z")
    return bands.join(cut(shared.select("bucket", "a"), "buckets"), "bucket").filter("a != node").select("a", F.col("node").alias("b")).distinct()


def link_block(keys: list[bytes], signs: list[bytes], sets: list[bytes], s: Settings, old: list[bool] | None = None) -> list[tuple[int, int]]:
    """Links that join all documents of one block that are linked, by position; at most one less than the documents.

    Each document is compared with all later ones that are not yet joined with it,
    one batch of hashes after the other, and pairs drop out when the posterior
    says so. Pairs that survive all batches are verified on their full sets, the
    likeliest first. With ``old``, pairs of two old documents are left out.
    """
    n = len(keys)
    sign = np.frombuffer(b"".join(signs), np.uint32).reshape(n, s.hashes)
    items = [np.frombuffer(x, np.uint64) for x in sets]
    size = np.array([len(x) for x in items])
    group, links, least = np.arange(n), [], least_matches(s)
    aged = np.array(old if old is not None else [False] * n)
    for i in range(n - 1):
        rest = np.arange(i + 1, n)
        rest = rest[group[rest] != group[i]]
        if aged[i]:
            rest = rest[~aged[rest]]
        small, large = np.minimum(size[rest], size[i]), np.maximum(size[rest], size[i])
        rest = rest[100 * small >= s.percent * large]
        same = np.zeros(len(rest), np.int64)
        for k, fewest in enumerate(least):
            part = slice(k * s.batch, (k + 1) * s.batch)
            same += (sign[rest, part] == sign[i, part]).sum(1)
            alive = same >= fewest
            rest, same = rest[alive], same[alive]
        for j in rest[np.argsort(-same, kind="stable")].tolist():
            if group[i] == group[j]:
                continue
            both = len(np.intersect1d(items[i], items[j], assume_unique=True))
            if 100 * both >= s.percent * (len(items[i]) + len(items[j]) - both):
                links.append((i, j))
                group[group == group[j]] = group[i]
    return links


def _linked(blocks: DataFrame, s: Settings) -> DataFrame:
    """a, b: the links found within each block of (block, node, signature, items, old)."""

    def run(table: pa.Table) -> pa.Table:
        keys = table["node"].to_pylist()
        links = link_block(keys, table["signature"].to_pylist(), table["items"].to_pylist(), s, table["old"].to_pylist())
        return pa.table({"a": pa.array([keys[i] for i, _ in links], pa.binary()), "b": pa.array([keys[j] for _, j in links], pa.binary())})

    return blocks.groupBy("block").applyInArrow(run, "a binary, b binary")


def _members(docs: DataFrame, signed: DataFrame, clusters: DataFrame, s: Settings) -> DataFrame:
    """comp, node, signature, items: the full set of each node of a cluster, from the text of one row that has it."""
    one = signed.filter("node IS NOT NULL").join(clusters, "node").groupBy("comp", "node").agg(F.min(F.struct("doc_id", "text_key", "signature")).alias("r"))
    one = cut(one.select("comp", "node", "r.*"), "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), s.words).tobytes() for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sets, pa.binary())], names=["comp", "node", "signature", "items"])

    text = docs.select(docs["doc_id"].cast("long").alias("_id"), text_key(docs).alias("_key"), "text")
    rows = text.join(one, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    return cut(map_arrow(rows.select("comp", "node", "signature", "text"), run, "comp binary, node binary, signature binary, items binary").dropDuplicates(["node"]), "sets")


def _pivots(members: DataFrame, s: Settings) -> DataFrame:
    """comp, node of the members with the smallest hashes; a few of each piece are looked at, so no cluster is gathered."""
    order = F.xxhash64("node", F.lit(1))
    few = lambda *by: Window.partitionBy(*by).orderBy("_order")
    rows = members.select("comp", "node", "piece", order.alias("_order"))
    rows = rows.withColumn("_n", F.row_number().over(few("comp", "piece"))).filter(F.col("_n") <= s.pivots)
    return rows.withColumn("_n", F.row_number().over(few("comp"))).filter(F.col("_n") <= s.pivots).select("comp", "node")


def _true_links(members: DataFrame, s: Settings) -> DataFrame:
    """a, b: links that join all that is linked within each candidate cluster.

    A cluster of up to ``block`` nodes is one block. A larger one is dealt into
    blocks, each with the same few pivots, which joins a group of near copies to
    one component at a cost that grows with its size. What is then not in the
    cluster's largest component is compared with every block of the cluster, so
    every pair that is not joined yet has been compared.
    """
    sizes = members.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("items")).alias("bytes"))
    pieces = F.greatest(F.ceil(F.col("n") / s.block), F.ceil(F.col("bytes") / F.lit(s.block * 64_000))).cast("int")
    sizes = cut(sizes.select("comp", pieces.alias("pieces")), "sizes")
    one = members.join(sizes.filter("pieces = 1"), "comp")
    links = _linked(one.select(F.col("comp").alias("block"), "node", "signature", "items", F.lit(False).alias("old")), s)
    many = sizes.filter("pieces > 1")
    if many.isEmpty():
        return links
    many = cut(members.join(many, "comp").withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int")), "pieces")
    block = lambda *parts: F.to_binary(F.sha2(F.concat_ws(":", F.hex("comp"), *parts), 256), F.lit("hex")).alias("block")
    shape = ["block", "node", "signature", "items", "old"]
    lead = _pivots(many, s)
    heads = many.join(lead, ["comp", "node"], "left_semi")
    spread = heads.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).filter("to != piece")
    first = many.select(block(F.col("piece")), "node", "signature", "items", F.lit(False).alias("old"))
    first = first.unionByName(spread.select(block(F.col("to")), "node", "signature", "items", F.lit(False).alias("old")))
    found = cut(_linked(first.select(*shape), s), "links")
    joined = components(found, "a", "b")
    now = many.select("comp", "node", "piece", "pieces").join(joined.withColumnRenamed("comp", "own"), "node", "left")
    now = cut(now.withColumn("own", F.coalesce("own", "node")), "joined")
    largest = now.groupBy("comp", "own").agg(F.count(F.lit(1)).alias("n")).groupBy("comp").agg(F.max(F.struct("n", "own")).alias("m"))
    rest = now.join(largest.select("comp", F.col("m.own").alias("main")), "comp").filter("own != main").select("comp", "node")
    rest = cut(many.join(rest, ["comp", "node"], "left_semi"), "rest")
    chunks = rest.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("chunks"))
    chunks = cut(chunks, "chunks")
    chunk = F.pmod(F.xxhash64("node", F.lit(2)), F.col("chunks")).cast("int")
    new = rest.join(chunks, "comp").withColumn("chunk", chunk).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    new = new.select(block(F.col("to"), F.col("chunk")), "node", "signature", "items", F.lit(False).alias("old"))
    old = many.join(chunks, "comp").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    old = old.select(block(F.col("piece"), F.col("chunk")), "node", "signature", "items", F.lit(True).alias("old"))
    second = new.unionByName(old).select(*shape)
    return links.unionByName(found).unionByName(_linked(second, s))


def near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_key of every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable over links, itself included;
    links join documents, whole sets confirmed, with ``100 * intersection >=
    percent * union`` of their k-word shingles.

    Equal sets are one node. Nodes that share a band of their MinHash signature are
    joined to candidate clusters through the smallest node of each bucket; then the
    nodes of a cluster are compared in blocks of bounded size, by batches of their
    signatures with Bayesian pruning and then exactly, see :func:`_true_links`. No
    pairs of a group are emitted, only links that join it. A pair at the threshold
    is missed with the bands' probability (1e-6 at most) or ``miss``.

    A text without words (NULL, empty, blank) has no shingles, is linked with nothing
    and kept. Repeated rows of one id are kept alike. Rows without an id have the
    component_id of what they are linked with, and are kept only if that is none.
    No rows give none; further columns are ignored.
    """
    return _judged(docs, s).drop("comp")


def _judged(docs: DataFrame, s: Settings) -> DataFrame:
    """As :func:`near_duplicates`, with comp: the smallest node of the component, which tells components whatever their ids."""
    signed = cut(signatures(docs, s), "signatures")
    nodes = signed.filter("node IS NOT NULL").groupBy("node").agg(F.first("signature").alias("signature"), F.min("doc_id").alias("least"))
    clusters = cut(components(candidate_edges(nodes.select("node", "signature"), s), "a", "b"), "clusters")
    members = _members(docs, signed, clusters, s)
    comps = components(_true_links(members, s), "a", "b")
    ids = signed.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    least = ids.join(comps, "node", "left").groupBy(F.coalesce("comp", "node").alias("comp")).agg(F.min("least").alias("component"))
    found = ids.join(comps, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")).join(least, "comp").select("node", "comp", "component")
    out = signed.select("doc_id", "text_key", "n_shingles", "node").join(cut(found, "components"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key", "comp")


def drop_near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row of each group of near-duplicates, with all columns: the one with the smallest id.

    Of rows that repeat an id and text within a group, one stays; texts without words all stay.
    Groups are told by their links, so rows without an id, or with the same one, are
    dropped only where their texts are linked.
    """
    kept = _judged(docs, s).filter("kept")
    worded = kept.filter("n_shingles > 0").groupBy("comp").agg(F.min(F.struct("doc_id", "text_key")).alias("r")).select("r.*")
    blank = kept.filter("n_shingles = 0").select("doc_id", "text_key").distinct()
    own, kept_key = free_names(docs, "kept_id", "kept_key")
    keys = worded.unionByName(blank).select(F.col("doc_id").alias(own), F.col("text_key").alias(kept_key))
    key = docs["doc_id"].eqNullSafe(F.col(own)) & (text_key(docs) == F.col(kept_key))
    rows = docs.join(cut(keys, "kept"), key, "left_semi")
    blank_row = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]", "")) == 0
    return rows.filter(~blank_row).dropDuplicates(["doc_id", "text"]).unionByName(rows.filter(blank_row))
