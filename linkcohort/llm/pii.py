"""Personal data: fixed patterns, and a span classifier trained on the votes of weak labelers."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkcohort.llm.common import arrow_schema, cut, map_arrow

# The kinds in their order and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What further candidates look like, and what the labelers look for.
MORE = ("handle", "name", "number")  # kinds that only the classifier finds
NUMBER = re.compile(r"(?<![0-9A-Za-z.])\(?[0-9][0-9().\x20/-]{5,24}[0-9](?![0-9A-Za-z])")
HANDLE = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}\x20?(?:\[dot\]|\(dot\)|\x20dot\x20|\.)\x20?[A-Za-z]{2,12}")
NAME = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame|Name|Contact)[.:]?\x20[A-Z][a-zà-ÿ]+(?:\x20[A-Z][a-zà-ÿ]+)?")
BEFORE = 40  # characters before a span that a labeler may look at
FOR = re.compile(r"(?i)\b(?:call|phone|tel|telefon|mobile|fax|e-?mail|mail|contact|kontakt|ssn|social security|passport|card|iban|account|ip|address|reach|write to|born|dob)\b")
AGAINST = re.compile(r"(?i)\b(?:version|v|page|figure|fig|isbn|issn|section|chapter|table|total|sum|nr|no|id|build|licen[sc]e)\b")
GIVEN = frozenset("anna carlos david elena emma hans james jean john juan julia karl laura maria marie mary michael paul peter pierre robert sarah sofia thomas".split())
ENDINGS = frozenset("com org net edu gov io info de fr es uk eu example".split())
DATE = re.compile(r"(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:[0-9]{4}|[0-9]{2})|[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2})\Z")
SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}\Z")
DIGITS = re.compile("[0-9]")

BUCKETS = 1 << 12
MAX_FITTED = 20_000  # spans the final classifier is fitted on, at most
SURE = 0.9  # probability from which on it adds a span


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` outwards, so that a long run of letters is read once."""
    pos, at = 0, text.find("@")
    while at >= 0:
        start = pos + len(text[pos:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            pos = domain.end()
        else:
            pos = at + 1
        at = text.find("@", pos)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed; failing matches are dropped without a second try."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    for m in CARD.finditer(text):
        digits = "".join(DIGITS.findall(m.group()))
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(DIGITS.findall(m.group())) <= 15]
    return ordered(out)


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    rank = {k: i for i, k in enumerate((*KINDS, *MORE))}
    return sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))


def joined(spans: Sequence[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def more_candidates(text: str, base: Sequence[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of looser shapes that touch none of ``base`` nor one another, the leftmost first."""
    found = [("number", *m.span()) for m in NUMBER.finditer(text)]
    if "dot" in text or "[at]" in text or "(at)" in text:
        found += [("handle", *m.span()) for m in HANDLE.finditer(text)]
    found += [("name", *m.span()) for m in NAME.finditer(text)]
    out, last = [], 0
    taken, i = sorted((a, b) for _, a, b in base), 0
    for kind, a, b in ordered(found):
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if a >= last and (i == len(taken) or taken[i][0] >= b):
            out.append((kind, a, b))
            last = b
    return out


def votes(text: str, kind: str, a: int, b: int) -> tuple[int, ...]:
    """What each labeler says of a span: 1 personal, -1 not, 0 nothing."""
    span, before = text[a:b], text[max(0, a - BEFORE):a]
    digits = len(DIGITS.findall(span))
    strict = 1 if kind in KINDS else 0
    loose = 1 if SSN.match(span) or kind == "handle" or (9 <= digits <= 15 and not span.isdigit()) else -1 if 0 < digits < 7 else 0
    words = [w.lower() for w in re.findall(r"[^\W\d_]+", span)]
    gazetteer = 1 if any(w in GIVEN for w in words) or (words and words[-1] in ENDINGS) else 0
    context = 1 if FOR.search(before) else -1 if AGAINST.search(before) else 0
    touching = text[a - 1:a] + text[b:b + 1]
    neighbours = -1 if any(c.isalnum() or c in "$€£%=/" for c in touching) else 0
    dated = -1 if DATE.match(span) else 0
    return strict, loose, gazetteer, context, neighbours, dated


def features(text: str, kind: str, a: int, b: int) -> list[int]:
    """Hashed features of a span: its shape, length and digits, and the words before."""
    span, before = text[a:b], text[max(0, a - BEFORE):a]
    shape = re.sub(r"[0-9]+", lambda m: f"9{len(m.group())}", re.sub(r"[^\W\d_]+", "a", span))
    words = re.findall(r"[^\W\d_]+", before.lower())[-3:]
    own = [f"s:{shape[:40]}", f"g:{re.sub('[0-9a]+', 'x', shape)[:30]}", f"n:{len(DIGITS.findall(span))}", f"l:{len(span) // 4}", f"k:{kind if kind in MORE else 'base'}", f"c:{before[-1:]}"]
    return [xxhash.xxh32_intdigest(f) % BUCKETS for f in own + [f"w:{w}" for w in words]]


def reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = 50) -> dict[tuple[int, ...], float]:
    """The probability that spans with each pattern of votes are personal, by expectation-maximisation.

    Each labeler has a share of each vote among personal spans and among others;
    both start from the majority of the votes. The input is a count for each
    pattern, of which there are at most 3 to the power of the labelers.
    """
    keys = sorted(patterns)
    if not keys:
        return {}
    v, n = np.array(keys) + 1, np.array([patterns[k] for k in keys], float)
    p = np.clip(0.5 + 0.35 * (v - 1).sum(1), 0.05, 0.95)
    for _ in range(rounds):
        prior = np.clip((n * p).sum() / n.sum(), 0.01, 0.99)
        odds = np.full(len(keys), math.log(prior / (1 - prior)))
        for j in range(v.shape[1]):
            yes = np.bincount(v[:, j], n * p, 3) + 0.5
            no = np.bincount(v[:, j], n * (1 - p), 3) + 0.5
            odds += (np.log(yes / yes.sum()) - np.log(no / no.sum()))[v[:, j]]
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return dict(zip(keys, p.tolist()))


@dataclass
class SpanClassifier:
    """Logistic regression on hashed features; without a fit no span is added."""

    weights: np.ndarray | None = None

    @classmethod
    def fit(cls, rows: Sequence[tuple[list[int], float]], rounds: int = 200, rate: float = 0.5, decay: float = 1e-3) -> SpanClassifier:
        if not rows:
            return cls()
        at = np.concatenate([np.array(f, np.int64) for f, _ in rows])
        row = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
        y, w = np.array([p for _, p in rows]), np.zeros(BUCKETS + 1)
        step = np.full(BUCKETS + 1, 1e-8)
        for _ in range(rounds):
            error = 1 / (1 + np.exp(-(np.bincount(row, w[at], len(rows)) + w[-1]))) - y
            g = np.append(np.bincount(at, error[row], BUCKETS), error.sum()) / len(rows) + decay * w
            step += g * g
            w -= rate * g / np.sqrt(step)
        return cls(w)

    def probability(self, feats: Sequence[int]) -> float:
        if self.weights is None:
            return 0.0
        return 1 / (1 + math.exp(-float(self.weights[list(feats)].sum() + self.weights[-1])))


_FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, more array<string>, patterns array<string>, feats array<string>"


def inspect(text: str) -> tuple[list, list, list[str], list[str]]:
    """Base spans, further candidates, and votes and features of both in this order."""
    base = base_spans(text)
    more = more_candidates(text, base)
    both = [*base, *more]
    return base, more, [" ".join(map(str, votes(text, *s))) for s in both], [" ".join(map(str, features(text, *s))) for s in both]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_FOUND)
    for batch in batches:
        rows = []
        for text in batch.column(1):
            base, more, patterns, feats = inspect(text.as_py() or "")
            rows.append((*[sum(s[0] == k for s in base) for k in KINDS], joined(base), [joined([s]) for s in more], patterns, feats))
        cols = list(zip(*rows)) if rows else [()] * 8
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:])]], schema=schema)


def train(found: DataFrame) -> SpanClassifier:
    """Votes of all spans are counted by pattern; the classifier is fitted on those with the smallest hashes."""
    spans = found.filter(F.size("patterns") > 0).select("doc_id", F.explode(F.arrays_zip("patterns", "feats")).alias("s")).select("doc_id", "s.patterns", "s.feats")
    counts = {tuple(map(int, k.split(" "))): n for k, n in spans.groupBy("patterns").count().collect()}  # 3 ** 6 at most
    p = reliabilities(counts)
    sample = spans.orderBy(F.xxhash64("doc_id", "patterns", "feats"), "feats").select("patterns", "feats").limit(MAX_FITTED).collect()
    return SpanClassifier.fit([(list(map(int, f.split(" "))), p[tuple(map(int, k.split(" ")))]) for k, f in sample])


def find_personal(docs: DataFrame, classifier: SpanClassifier | None = None, sure: float = SURE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row of ``docs`` (doc_id, text).

    Each whole text is scanned once for the fixed patterns and looser candidates.
    Regex, gazetteer, context, neighbour and date labelers vote on every span;
    expectation-maximisation over the counts of vote patterns estimates how far
    each is to be trusted, and a classifier fitted to the result (or given) adds
    candidates it is ``sure`` of. Only samples and counts are shuffled.

    NULL text is empty and has no spans; repeated rows are scanned each; further
    columns are ignored. Positions count code points, ends are exclusive.
    """
    found = cut(map_arrow(docs.select(docs["doc_id"].cast("long"), "text"), _scan, _FOUND), "personal")
    model = classifier or train(found)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sha, spans = [], []
            for base, more, feats in zip(*[c.to_pylist() for c in batch.columns[5:]]):
                own = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in base.split(","))] if base else []
                split = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in more)]
                new = [s for s, f in zip(split, feats[len(own):]) if model.probability([int(x) for x in f.split(" ")]) >= sure]
                sha.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append(joined(ordered([*own, *new])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sha, pa.string()), pa.array(spans, pa.string())], names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    slim = found.select("doc_id", *[f"n_{k}" for k in KINDS], "base", "more", "feats")
    return map_arrow(slim, decide, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: Sequence[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars``, if there, counted anew; other columns as they are.

    The classifier is trained on the spans of all rows first. NULL text stays NULL.
    """
    found = cut(map_arrow(docs.select(docs["doc_id"].cast("long"), "text"), _scan, _FOUND), "personal")
    model = train(found)
    at, count = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(at):
                text = text.as_py()
                if text:
                    base, more, _, feats = inspect(text)
                    new = [s for s, f in zip(more, feats[len(base):]) if model.probability([int(x) for x in f.split(" ")]) >= sure]
                    text = masked(text, ordered([*base, *new])) if base or new else text
                texts.append(text)
            cols = list(batch.columns)
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            if count is not None:
                cols[count] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(count).type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return map_arrow(docs, run, docs.schema)
