"""BPE encoding and decoding with a public vocabulary file, merged by a segment tree."""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from linkcohort.llm.common import arrow_schema, map_arrow

CACHED = 200_000  # words a worker remembers; then it starts anew
SHORT = 64  # bytes of a word whose tree is worked beside others, and which is remembered
TOGETHER = 8_192  # words whose trees are worked side by side
NO_RANK = 1 << 40
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
TAILS = "'s|'t|'re|'ve|'m|'ll|'d"
WORDS = regex.compile(rf"{TAILS}|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
ASCII_WORDS = re.compile(rf"{TAILS}|[a-z]+|[0-9]|[^\t-\r\x20a-z0-9]+")
SPACES = re.compile(f"[{SPACE}]+")


@cache
def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself, or the next one from 256 on."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(others)}


class PairTree:
    """Symbols in a row, and a segment tree of the ranks of adjacent pairs.

    A node holds the smallest (rank, position) below it, packed into one number,
    so the root is the leftmost pair of lowest rank. A merge changes the pairs on
    either side, each a point update up the tree.
    """

    def __init__(self, symbols: list[str], ranks: dict[tuple[str, str], int]):
        self.sym, self.ranks, n = symbols, ranks, len(symbols)
        self.next, self.prev = list(range(1, n + 1)), list(range(-1, n - 1))
        self.size = 1 << max(0, (n - 1).bit_length())
        self.bits = self.size.bit_length()
        self.none = NO_RANK << self.bits
        self.node = [self.none] * (2 * self.size)
        node, size, bits = self.node, self.size, self.bits
        for i in range(n - 1):
            if (rank := ranks.get((symbols[i], symbols[i + 1]))) is not None:
                node[size + i] = rank << bits | i
        for i in range(size - 1, 0, -1):
            a, b = node[2 * i], node[2 * i + 1]
            node[i] = a if a < b else b

    def update(self, i: int) -> None:
        node, j = self.node, self.next[i]
        rank = self.ranks.get((self.sym[i], self.sym[j])) if j < len(self.sym) else None
        k = self.size + i
        value = self.none if rank is None else rank << self.bits | i
        while True:
            if node[k] == value:
                return
            node[k] = value
            if k == 1:
                return
            other = node[k ^ 1]
            value = value if value < other else other
            k >>= 1

    def clear(self, i: int) -> None:
        """The symbol at ``i`` is gone: it has no pair."""
        self.next[i] = len(self.sym)
        self.update(i)

    def merge(self) -> list[str]:
        sym, after, before, n = self.sym, self.next, self.prev, len(self.sym)
        mask = (1 << self.bits) - 1
        while (root := self.node[1]) < self.none:
            i = root & mask
            j = after[i]
            sym[i] += sym[j]
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            self.clear(j)
            self.update(i)
            if before[i] >= 0:
                self.update(before[i])
        out, i = [], 0
        while i < n:
            out.append(sym[i])
            i = after[i]
        return out


class PairTrees:
    """The segment trees of many words of up to ``size`` symbols (a power of two), one merge in each of them a round.

    A tree is as in ``PairTree``, of vocabulary ids: node ``k`` of all words is row
    ``k`` of ``node``. Words without a pair to merge leave the rounds.
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, size: int, merges: Merges):
        """``symbols`` of all words, one word after the other."""
        self.size, self.bits, self.merges, n = size, size.bit_length() - 1, merges, len(lengths)
        self.none = NO_RANK << self.bits
        at = np.arange(size)[:, None]
        there = at < lengths
        self.sym = np.zeros((size + 1, n), np.int64)
        self.sym[:size].T[there.T] = symbols
        self.next = np.where(at + 1 < lengths, at + 1, size)
        self.prev = np.repeat(np.arange(-1, size)[:, None], n, 1)  # of ``size``, the end, too
        self.node = np.full((2 * size, n), self.none)
        word, place = np.nonzero((at + 1 < lengths).T)
        rank = merges.ranks(self.sym[place, word], self.sym[place + 1, word])
        self.node[size + place, word] = np.where(rank < NO_RANK, rank << self.bits | place, self.none)
        for k in range(size - 1, 0, -1):
            np.minimum(self.node[2 * k], self.node[2 * k + 1], out=self.node[k])

    def leaf(self, i: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The value of the pair that begins at ``i``."""
        j = self.next[i, rows]
        rank = self.merges.ranks(self.sym[i, rows], self.sym[j, rows])
        return np.where((j < self.size) & (rank < NO_RANK), rank << self.bits | i, self.none)

    def merge(self) -> list[list[int]]:
        rows, node, size = np.arange(self.node.shape[1]), self.node, self.size
        while True:
            root = node[1, rows]
            rows, root = rows[root < self.none], root[root < self.none]
            if not len(rows):
                break
            i = root & (size - 1)
            j = self.next[i, rows]
            k = self.next[j, rows]
            self.sym[i, rows] = self.merges.result[root >> self.bits]
            self.next[i, rows] = k
            self.next[j, rows] = size
            self.prev[k, rows] = i
            p = self.prev[i, rows]
            left = np.where(p < 0, i, p)
            node[size + j, rows] = self.none
            node[size + i, rows] = self.leaf(i, rows)
            node[size + left, rows] = self.leaf(left, rows)
            changed = [size + i, size + j, size + left]
            for _ in range(self.bits):
                changed = [at >> 1 for at in changed]
                for at in changed:
                    node[at, rows] = np.minimum(node[2 * at, rows], node[2 * at + 1, rows])
        out, at = [[] for _ in range(node.shape[1])], np.zeros(node.shape[1], np.int64)
        rows = np.arange(node.shape[1])
        while len(rows):
            for row, s in zip(rows.tolist(), self.sym[at, rows].tolist()):
                out[row].append(s)
            at = self.next[at, rows]
            rows, at = rows[at < size], at[at < size]
        return out


class Merges:
    """Ranks of pairs of ids, and the id that each rank makes."""

    def __init__(self, pairs: list[tuple[int, int]], result: list[int], ids: int):
        self.ids, self.result = ids, np.array(result, np.int64)
        keys = np.array([a * ids + b for a, b in pairs], np.int64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.ids + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NO_RANK)


class Encoder:
    """Encodes texts to ids as the vocabulary's own library does, and ids back to text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        self.merges = Merges([(self.ids[a], self.ids[b]) for a, b in self.ranks], [self.ids[a + b] for a, b in self.ranks], len(self.ids))
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.letters = byte_letters()
        self.first = np.array([self.ids[self.letters[b]] for b in range(256)])
        self.last = np.array([self.ids[self.letters[b] + self.end] for b in range(256)])
        self.known: dict[str, tuple[str, str]] = {}

    def normalise(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = SPACES.sub(" ", unicodedata.normalize("NFC", text))
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()  # a final sigma is not special here

    def words(self, text: str) -> list[str]:
        """The words of a text in order; a special token is a word of its own, with a leading blank to tell it."""
        out = []
        for part in self.split_special.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(" " + part)
                continue
            part = self.normalise(part)
            out += (ASCII_WORDS if part.isascii() else WORDS).findall(part)
        return out

    def merged(self, words: list[str]) -> Iterator[list[int]]:
        """The ids of each word: short words by length, their trees side by side, longer ones one by one."""
        found: dict[str, list[int]] = {}
        classes: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            data = w.encode()
            if w[0] == " ":
                found[w] = [self.special[w[1:]]]
            elif len(data) > SHORT:
                symbols = [self.letters[b] for b in data]
                symbols[-1] += self.end
                found[w] = [self.ids[x] for x in PairTree(symbols, self.ranks).merge()]
            else:
                classes.setdefault(1 << (len(data) - 1).bit_length(), []).append((w, data))
        for size, own in classes.items():
            for at in range(0, len(own), TOGETHER):
                part = own[at : at + TOGETHER]
                lengths = np.array([len(data) for _, data in part])
                letters = np.frombuffer(b"".join([data for _, data in part]), np.uint8)
                symbols, ends = self.first[letters], np.cumsum(lengths) - 1
                symbols[ends] = self.last[letters[ends]]
                found.update(zip([w for w, _ in part], PairTrees(symbols, lengths, size, self.merges).merge()))
        for w in words:
            yield found[w]

    def encode(self, text: str) -> str:
        """All ids of a text, in decimal, joined by spaces."""
        return next(self.encode_all([text]))[0]

    def decode(self, ids: str) -> str:
        return " ".join([self.tokens[int(i)] for i in ids.split()])

    def encode_all(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Of each text all ids, in decimal, and the tokens they decode to, both joined by spaces.

        The vocabulary names no decoder, so the decoded text is just that. The words
        that no earlier text held are merged together first.
        """
        split = [self.words(t) for t in texts]
        if len(self.known) >= CACHED:
            self.known = {}
        known, names = self.known, self.tokens
        new = [w for w in dict.fromkeys(itertools.chain.from_iterable(split)) if w not in known]
        for w, ids in zip(new, self.merged(new)):
            known[w] = " ".join(map(str, ids)), " ".join([names[i] for i in ids])
        for words in split:
            pieces = [known[w] for w in words]
            yield " ".join([ids for ids, _ in pieces]), " ".join([back for _, back in pieces])
        for w in new:
            if len(w) > SHORT:
                del known[w]


@cache
def encoder(path: str) -> Encoder:
    """One a worker, kept from task to task."""
    return Encoder(path)


def encode_documents(docs: DataFrame, vocabulary: str, outputs: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs``; ``outputs`` may add ``ids`` (array<int>) and ``decoded``.

    A map over the rows: nothing is shuffled, and a worker holds a few texts, the
    vocabulary and about ``CACHED`` words. Whole texts are encoded, a word of any
    length in n log n steps. NULL text is empty and has no ids; repeated rows are
    encoded each; further columns are ignored. ``vocabulary`` is a path that all
    executors have, as that of an installed package. Characters that this Python's
    Unicode tables do not know yet count as signs.
    """
    kinds = {"ids": "array<int>", "decoded": "string"}
    schema = ", ".join(["doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", *[f"{o} {kinds[o]}" for o in outputs]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, types = encoder(vocabulary), arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cols: list[list] = [[] for _ in range(3 + len(outputs))]
                for ids, back in enc.encode_all([t or "" for t in part.column(1).to_pylist()]):
                    more = {"ids": np.array(ids.split(" ") if ids else [], np.int32) if "ids" in outputs else None, "decoded": back}
                    row = (ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), *[more[o] for o in outputs])
                    for col, value in zip(cols, row):
                        col.append(value)
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, f.type) for c, f in zip(cols, list(types)[1:])]], schema=types)

    return map_arrow(docs.select(docs["doc_id"].cast("long"), "text"), run, schema)
