"""Language-model scores of whole documents: counts of all training tokens, and a recurrent model trained on all of them."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkcohort.llm.common import arrow_schema, cut, map_arrow

END = b"\n"  # the token after a text's last word; no word holds it
LONG = 32  # bytes; longer words go by the digest of their bytes
HELD = 400_000  # tokens a task counts before it hands its counts on
HELD_BYTES = 64 << 20  # of text, likewise
BATCH = 4_000_000  # symbols of documents that are read side by side
SLICE = 16_384  # weights of a model that are averaged together
HOLD = 2  # documents whose crc32(doc_id) mod 7 is this are held out


@dataclass(frozen=True)
class Settings:
    top: int = 262_144  # most frequent tokens that each task gets with their counts; the rest are joined
    words: int = 2_048  # of them, symbols of the model
    tails: int = 40  # symbols for all other tokens, by their last letters
    rounds: int = 4  # shares of the training documents, each learned from once; models are averaged after each
    replica: int = 2_000_000  # tokens that a model learns from before it is averaged, at least
    replicas: int = 4_096  # models of a round, at most


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case, as UTF-8: ``bytes`` lowers and splits by ASCII alone."""
    return (text or "").encode().lower().split()


def key_of(word: bytes) -> bytes:
    return word if len(word) <= LONG else END + xxhash.xxh3_128_digest(word)


def tail_of(key: bytes, tails: int) -> int:
    return zlib.crc32(key.rstrip(b".,;:!?")[-2:]) % tails


def is_held_out(doc_id: str | None) -> bool:
    return zlib.crc32((doc_id or "").encode()) % 7 == HOLD


def count_tokens(docs: DataFrame, tails: int) -> DataFrame:
    """``token``, ``tail``, ``c`` of all training documents (doc_id, text)."""
    schema = "token binary, tail int, c long"

    def batch(held: Counter) -> pa.RecordBatch:
        keys: Counter = Counter()
        for word, n in held.items():
            keys[key_of(word)] += n
        cols = [list(keys), [tail_of(k, tails) for k in keys], list(keys.values())]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow_schema(schema))], schema=arrow_schema(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = Counter(), 0
        for b in batches:
            for doc_id, text in zip(*b.columns):
                if is_held_out(doc_id.as_py()):
                    continue
                text = text.as_py()
                held.update(words_of(text))
                held[END] += 1
                size += len(text or "")
                if len(held) >= HELD or size >= HELD_BYTES:
                    yield batch(held)
                    held, size = Counter(), 0
        yield batch(held)

    return map_arrow(docs, run, schema).groupBy("token", "tail").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What each task gets: the most frequent tokens with their counts, and the mass of each tail."""

    tokens: list[bytes]
    counts: np.ndarray
    tail_mass: np.ndarray
    total: int  # N
    distinct: int  # V
    settings: Settings

    def __post_init__(self):
        k = min(self.settings.words, len(self.tokens))
        tails = np.array([tail_of(t, self.settings.tails) for t in self.tokens], np.int64)
        self.words, self.logs = k, np.log10(self.counts + 1.0)
        self.symbols = np.where(np.arange(len(tails)) < k, np.arange(len(tails)), k + tails).astype(np.uint16)
        self.tail_logs = np.log10(self.tail_mass)

    @property
    def end(self) -> int:
        return self.tokens.index(END) if END in self.tokens[: self.words] else self.words + tail_of(END, self.settings.tails)

    def layout(self):
        from linkcohort.llm.recurrent import Layout

        return Layout(self.counts[: self.words], self.tail_mass, self.end)


def vocabulary(counts: DataFrame, settings: Settings) -> Vocabulary:
    """From all counts: sums by tail, and the ``top`` largest."""
    sums = {r.tail: (r.c, r.v) for r in counts.groupBy("tail").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()}
    top = counts.orderBy(F.desc("c"), "token").limit(settings.top).select("token", "c").toArrow()
    tokens, c = [bytes(t) for t in top["token"].to_pylist()], top["c"].to_numpy().astype(np.int64)
    # a tail has the mass of all its tokens that are no words of the model, a count and one each, and one for all unseen tokens
    mass = np.array([1 + sum(sums.get(k, (0, 0))) for k in range(settings.tails)], np.int64)
    for t, n in zip(tokens[: settings.words], c):
        mass[tail_of(t, settings.tails)] -= n + 1
    return Vocabulary(tokens, c, mass, sum(n for n, _ in sums.values()), sum(v for _, v in sums.values()), settings)


ENCODED = "row long, doc_id string, held_out boolean, n_tokens long, n_top long, base double, fixed double, symbols binary, rare array<binary>, rare_n array<long>"


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Each document (row, doc_id, text) as the model's symbols, what frequent tokens add to the scores, and its rare tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(vocab.tokens)}
        tails, k, types = vocab.settings.tails, vocab.words, arrow_schema(ENCODED)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part, rows = b.slice(at, 256), []
                for row, doc_id, text in zip(*[c.to_pylist() for c in part.columns]):
                    words = words_of(text)
                    words.append(END)
                    found = np.fromiter(map(place.get, words, itertools.repeat(-1)), np.int64, len(words))
                    missing = np.flatnonzero(found < 0).tolist()
                    keys = [key_of(words[i]) for i in missing]
                    for i, key in zip(missing, keys):
                        if key[0] == END[0]:  # of a long word
                            found[i] = place.get(key, -1)
                    symbols = vocab.symbols[found] if len(place) else np.zeros(len(found), np.uint16)
                    rare = Counter([key for i, key in zip(missing, keys) if found[i] < 0])
                    for i, key in zip(missing, keys):
                        if found[i] < 0:
                            symbols[i] = k + tail_of(key, tails)
                    known = found[found >= 0]
                    tail = symbols[symbols >= k].astype(np.int64) - k
                    rows.append((
                        row, doc_id, is_held_out(doc_id), len(words), len(known), vocab.logs[known].sum(),
                        vocab.logs[known[known >= k]].sum() - vocab.tail_logs[tail].sum(), symbols.tobytes(), list(rare), list(rare.values()),
                    ))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), types)], schema=types)

    return map_arrow(docs, run, ENCODED)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(rows, symbols) of up to ``BATCH`` symbols' documents; the last column are the symbols."""
    rows, docs, size = [], [], 0
    for b in batches:
        for *row, symbols in zip(*[c.to_pylist() for c in b.columns]):
            rows.append(row)
            docs.append(np.frombuffer(symbols, np.uint16).astype(np.int32))
            size += len(docs[-1])
            if size >= BATCH:
                yield rows, docs
                rows, docs, size = [], [], 0
    if docs:
        yield rows, docs


def train(encoded: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """The model's weights: in each round models start alike, learn from their part of the round's documents and are averaged by tokens.

    Every training document is learned from once. What is shuffled and sent to the
    driver are weights, as many as the layout has.
    """
    settings, layout = vocab.settings, vocab.layout()
    weights, schema = layout.start(), "slice int, tokens long, weights binary"
    learned = encoded.filter("NOT held_out").withColumn("round", F.pmod(F.xxhash64("row"), F.lit(settings.rounds)))
    sizes = {r["round"]: r.n for r in learned.groupBy("round").agg(F.sum("n_tokens").alias("n")).collect()}

    def batch(values: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*values), arrow_schema(schema))], schema=arrow_schema(schema))

    def learn(start: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from linkcohort.llm.recurrent import Trainer

            trainer = Trainer(layout, start)
            for _, docs in _documents(batches):
                trainer.learn(docs)
            if trainer.tokens:
                flat = trainer.model.flat
                yield batch([(k, trainer.tokens, flat[at : at + SLICE].tobytes()) for k, at in enumerate(range(0, len(flat), SLICE))])

        return run

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        tokens: Counter = Counter()
        for b in batches:
            for k, n, values in zip(*[c.to_pylist() for c in b.columns]):
                sums[k] = sums.get(k, 0) + n * np.frombuffer(values, np.float32).astype(np.float64)
                tokens[k] += n
        if sums:
            yield batch([(k, tokens[k], (s / tokens[k]).astype(np.float32).tobytes()) for k, s in sums.items()])

    for k in range(settings.rounds):
        if not sizes.get(k):
            continue
        n = max(1, min(settings.replicas, sizes[k] // settings.replica))
        share = learned.filter(F.col("round") == k).select("row", "symbols").repartition(n, "row")
        models = map_arrow(share, learn(weights), schema)
        parts = map_arrow(models.repartition(max(1, min(n, len(weights) // SLICE)), "slice"), average, schema).toArrow()
        order = np.argsort(parts["slice"].to_numpy())
        weights = np.concatenate([np.frombuffer(parts["weights"][int(i)].as_py(), np.float32) for i in order])
    return weights


def score_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    Texts are whole, NULL is empty and has its end alone; a NULL doc_id is written
    as nothing, so it is learned from; repeated rows count each; further columns
    are ignored; an empty table gives no rows. Without training documents every
    token is unseen.

    All training tokens are counted. Tokens of the ``top`` largest counts are known
    in each task; the others, none of which can be frequent, are joined by shuffle.
    The model's words are the ``words`` largest; each further token belongs to the
    tail of its last two letters, in which its chance is its share of counts plus
    one, unseen tokens sharing one. So chances of all tokens sum to one.
    """
    ids = docs["doc_id"].cast("string").alias("doc_id")
    counts = cut(count_tokens(docs.select(ids, docs["text"].alias("text")), settings.tails), "token-counts")
    vocab = vocabulary(counts, settings)
    encoded = cut(encode(docs.select(F.monotonically_increasing_id().alias("row"), ids, docs["text"].alias("text")), vocab), "encoded")
    weights, layout = train(encoded, vocab), vocab.layout()

    # rare tokens: their counts, joined, and summed by document
    rare = encoded.filter(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select("row", F.col("r.rare").alias("token"), F.col("r.rare_n").alias("n"))
    least = int(vocab.counts[-1]) if len(vocab.tokens) == settings.top else 0
    few = counts.filter(F.col("c") <= least).select("token", "c")
    sums = rare.join(few, "token").groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_sum"), F.sum("n").alias("rare_known"))

    schema = "row long, doc_id string, held_out boolean, n_tokens long, n_top long, base double, fixed double, model double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from linkcohort.llm.recurrent import Model, log_likelihoods

        model, types = Model(layout, weights), arrow_schema(schema)
        for rows, texts in _documents(batches):
            scores = log_likelihoods(model, texts) / math.log(10)
            cols = [*zip(*rows), scores]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, types)], schema=types)

    scored = map_arrow(encoded.select("row", "doc_id", "held_out", "n_tokens", "n_top", "base", "fixed", "symbols"), run, schema)
    rest, floor = F.coalesce("rare_sum", F.lit(0.0)), math.log10(vocab.total + vocab.distinct + 1)
    kind = docs.schema["doc_id"].dataType
    return scored.join(sums, "row", "left").select(
        F.col("doc_id").cast(kind).alias("doc_id"), "held_out", "n_tokens", (F.col("n_top") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + rest - F.col("n_tokens") * floor).alias("base_score"),
        (F.col("model") + F.col("fixed") + rest).alias("score"),
    )
