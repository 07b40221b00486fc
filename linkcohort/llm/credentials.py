"""Secret scans: fixed patterns, and candidates scored by automata inferred from all that the patterns found and all ordinary strings."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkcohort.llm.automata import Automaton, Formats, shape_of, symbols
from linkcohort.llm.common import arrow_schema, cut, map_arrow

# The kinds in their order and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
WORD = re.compile(r"[^\W_]{5,}")
SIGNS = re.compile(r"[+/_=-]+")
PLAIN = re.compile(r"(?:[A-Z][a-z]{2,})+|[a-z]+(?:[A-Z][a-z]{2,})*|[A-Z]+")  # between the signs of paths, compounds, rules and the like
NUMBERS = re.compile(r"[0-9]+(?:[+/_=-]+[0-9]+)*")  # dates and ranges too
LEARNED = "format"  # the kind of spans that only the automata found
RARE = 500  # a start that fewer than one in so many strings of its kind have is no state of its own
DEPTH = 64  # symbols of a start that is a state of its own, at most
ONE_IN = 1_000  # held-out ordinary strings, of which one may be taken for a secret
MARGIN = 6.0  # natural log of how many times likelier than an ordinary word a secret must be, whatever its length
MOST = 12.0  # likewise, where held-out ordinary strings ask for more

# Alphabets and lengths of common credentials, of which examples are made beside those that the patterns found.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MADE = {
    "mixed": (DIGITS + UPPER + LOWER, 16, 44), "base64": (DIGITS + UPPER + LOWER + "+/", 20, 64), "upper": (DIGITS + UPPER, 16, 40),
    "lower": (DIGITS + LOWER, 16, 40), "upper_hex": (DIGITS + "ABCDEF", 24, 40),
}
MADE_EACH = 300


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed; failing matches are dropped without a second try."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]  # shorter runs would be dropped
    return ordered(out)


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    rank = {k: i for i, k in enumerate((*KINDS, LEARNED))}
    return sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def credential(text: str, span: tuple[str, int, int]) -> str:
    """The secret itself: of an assignment, what is assigned."""
    kind, a, b = span
    return ASSIGN.match(text, a).group(2) if kind == "assign" else text[a:b]


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Runs that could be a secret (12 characters or more, of any kind) and touch no span of ``base``."""
    out, taken, i = [], sorted((a, b) for _, a, b in base), 0
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if i == len(taken) or taken[i][0] >= b:
            out.append((a, b))
    return out


def ordinary_words(text: str, base: list[tuple[str, int, int]], once: set[str], twice: set[str]) -> list[str]:
    """The words of a text that have no digit, touch no span of ``base`` and are not known from two texts; ``once`` and ``twice`` take them up."""
    if base:
        new = {m.group() for m in WORD.finditer(text) if not any(a < m.end() and m.start() < b for _, a, b in base)} - twice
    else:
        new = set(WORD.findall(text)) - twice
    twice |= new & once
    once |= new
    return sorted(w for w in new if not any(c.isdigit() for c in w))


def is_plain(run: str) -> bool:
    return bool(NUMBERS.fullmatch(run)) or all(PLAIN.fullmatch(piece) for piece in SIGNS.split(run) if piece)


_FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base string, kinds array<string>, secrets array<string>, starts array<long>, tokens array<string>, words array<string>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_FOUND)
    for batch in batches:
        rows, once, twice = [], set(), set()
        for text in batch.column(1):
            text = text.as_py() or ""
            base = base_spans(text)
            found = candidates(text, base)
            n = [sum(s[0] == k for s in base) for k in KINDS]
            rows.append((*n, joined(base), [s[0] for s in base], [credential(text, s) for s in base], [a for a, _ in found], [text[a:b] for a, b in found], ordinary_words(text, base, once, twice)))
        cols = list(zip(*rows)) if rows else [()] * 9
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:])]], schema=schema)


def made_examples(seed: int = 17) -> dict[str, list[str]]:
    """Labelled credentials of common formats, by their rules: random strings of an alphabet, and identifiers of 8-4-4-4-12 hex digits."""
    r = random.Random(seed)
    out = {k: ["".join(r.choices(alphabet, k=r.randint(lo, hi))) for _ in range(MADE_EACH)] for k, (alphabet, lo, hi) in MADE.items()}
    dashed = ["".join(r.choices(DIGITS + LOWER[:6], k=32)) for _ in range(MADE_EACH)]
    return out | {"dashed": [f"{x[:8]}-{x[8:12]}-{x[12:16]}-{x[16:20]}-{x[20:]}" for x in dashed]}


ORDINARY, TRAINING = "ordinary ", "training "  # before the shape: all ordinary strings, and those not held out


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Credentials by kind, numbers and runs by shape, as if two texts had them; words by shape, with the texts that have them, two a batch at most."""
    for batch in batches:
        own, words = {}, Counter()
        for kinds, secrets, tokens, found in zip(*[c.to_pylist() for c in batch.columns]):
            own |= dict.fromkeys(zip(kinds, secrets), 2)
            own |= dict.fromkeys(((ORDINARY + shape_of(t), t) for t in tokens if is_plain(t)), 2)
            words.update(found)
        rows = [(*key, n) for key, n in own.items()] + [(ORDINARY + shape_of(w), w, n) for w, n in words.items()]
        cols = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], names=["own", "text", "texts"])


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([symbols(t) for t in batch.column(2).to_pylist()], pa.string())], names=["own", "held", "word"])


def _of(own: str, held: bool) -> tuple[str, ...]:
    """The automata that learn from a string."""
    return (own, TRAINING + own.removeprefix(ORDINARY)) if own.startswith(ORDINARY) and not held else (own,)


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each start of the strings, what comes next and how often; nothing at the end."""
    for batch in batches:
        n = Counter()
        for own, held, word, k in zip(*[c.to_pylist() for c in batch.columns]):
            for name in _of(own, held):
                for i in range(min(len(word), DEPTH) + 1):
                    n[name, word[:i], word[i : i + 1]] += k
        cols = list(zip(*n)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in cols], pa.array(n.values(), pa.int64())], names=["own", "start", "next", "n"])


def _trees(words: DataFrame, totals: Mapping[str, int]) -> dict[str, Automaton]:
    """Automata of the starts that are frequent among all strings of their kind: at most RARE of each length, so few come to the driver."""
    if not totals:
        return {}
    nodes = map_arrow(words, _starts, "own string, start string, next string, n long").groupBy("own", "start", "next").agg(F.sum("n").alias("n"))
    nodes = nodes.groupBy("own", "start").agg(F.sum("n").alias("n"), F.collect_list(F.struct("next", "n")).alias("nexts"))
    least = F.element_at(F.create_map(*[F.lit(x) for own, n in totals.items() for x in (own, max(2, math.ceil(n / RARE)))]), F.col("own"))
    trees: dict[str, dict] = {own: {} for own in totals}
    for r in nodes.filter(F.col("n") >= least).select("own", "start", "nexts").collect():
        trees[r.own][r.start] = {x.next: x.n for x in r.nexts}
    return {own: Automaton.of_tree(tree) for own, tree in sorted(trees.items())}


def _counted(words: DataFrame, automata: dict[str, Automaton]) -> dict[str, Automaton]:
    """The automata with counts of all strings, whole; a row for each state and symbol comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = Counter()
            for own, held, word, k in zip(*[c.to_pylist() for c in batch.columns]):
                for name in _of(own, held):
                    if name in automata:
                        for at, c in automata[name].steps(word):
                            n[name, at, c] += k
            own, at, c = list(zip(*n)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array(at, pa.int64()), pa.array(c, pa.string()), pa.array(n.values(), pa.int64())], names=["own", "state", "next", "n"])

    counts: dict[str, dict] = {own: {} for own in automata}
    for r in map_arrow(words, count, "own string, state long, next string, n long").groupBy("own", "state", "next").agg(F.sum("n").alias("n")).collect():
        counts[r.own][r.state, r.next] = r.n
    return {own: a.counted(counts[own]) for own, a in automata.items()}


def _exceeded_by(words: DataFrame, known: Formats, n: int) -> float:
    """The score, rounded up to a hundredth, that ``n`` of the held-out ordinary strings exceed; between -100 and 100."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [math.ceil(100 * max(-100.0, min(100.0, known.score_of_symbols(w)))) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), batch.column(1)], names=["score", "n"])

    held = words.filter("held").select("word", "n")
    for r in map_arrow(held, score, "score long, n long").groupBy("score").agg(F.sum("n").alias("n")).orderBy(F.desc("score")).collect():
        n -= r.n
        if n < 0:
            return r.score / 100
    return -math.inf


def learn_formats(found: DataFrame) -> Formats:
    """Automata of labelled credentials and of ordinary strings.

    Labelled are all distinct credentials of each kind that the patterns found, and
    examples made of common formats. Ordinary are all distinct plain numbers and
    plain runs of the texts, and all distinct words that two texts have: a word of one text
    only may be a secret itself. A half of them, by their hashes, is held out first, to see
    above which score one in a thousand of them lies.

    The prefix trees are counted by Spark over all strings. Of them the driver gets the
    starts that are frequent (``RARE``, ``DEPTH``), from which it infers the states; then
    Spark counts anew what all strings do in these states, from end to end.
    """
    strings = map_arrow(found.select("kinds", "secrets", "tokens", "words"), _strings, "own string, text string, texts long")
    strings = strings.groupBy("own", "text").agg(F.sum("texts").alias("texts")).filter("texts >= 2")
    strings = strings.select("own", (F.col("own").startswith(ORDINARY) & (F.xxhash64("text").bitwiseAND(F.lit(1)) == 1)).alias("held"), "text")
    words = map_arrow(strings, _symbols, "own string, held boolean, word string").groupBy("own", "held", "word").agg(F.count(F.lit(1)).alias("n"))
    words = cut(words, "formats")
    totals, held = Counter(), 0
    for r in words.groupBy("own", "held").agg(F.sum("n").alias("n")).collect():
        held += r.n if r.held else 0
        for own in _of(r.own, r.held):
            totals[own] += r.n
    if not totals[ORDINARY + "letters"] + totals[ORDINARY + "capitals"]:  # without ordinary words nothing is told
        totals, held = {own: n for own, n in totals.items() if own in KINDS}, 0
    if held < ONE_IN:
        totals = {own: n for own, n in totals.items() if not own.startswith(TRAINING)}
    automata = _counted(words, _trees(words, {own: n for own, n in totals.items() if n}))
    part = lambda first: {own.removeprefix(first): a for own, a in automata.items() if own.startswith(first)}
    kinds = {k: automata[k] for k in KINDS if k in automata} | {k: Automaton(v) for k, v in made_examples().items()}
    rate_at = _exceeded_by(words, Formats(kinds, part(TRAINING)), held // ONE_IN) if held >= ONE_IN and part(TRAINING) else -math.inf
    return Formats(kinds, part(ORDINARY), rate_at)


def find_secrets(docs: DataFrame, formats: Formats | None = None, margin: float = MARGIN) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of ``docs`` (doc_id, text).

    Each whole text is scanned once; what was found is written, automata are
    inferred from the labelled part of it (or given as ``formats``), and all
    candidates are scored. Only distinct strings are shuffled. A candidate is a
    secret if the best format is by ``margin`` likelier than ordinary text, or by as much
    more, up to ``MOST``, as leaves one in a thousand of held-out ordinary strings.

    NULL text is empty and has no spans; without any ordinary words nothing is
    added to the patterns' spans; repeated rows are scanned each; further columns
    are ignored. Positions count code points, ends are exclusive.
    """
    found = cut(map_arrow(docs.select(docs["doc_id"].cast("long"), "text"), _scan, _FOUND), "secrets")
    known = formats or learn_formats(found)
    least = max(margin, min(known.false_rate_at, MOST))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sha, spans = [], []
            for base, starts, tokens in zip(*[c.to_pylist() for c in batch.columns[4:]]):
                own = [tuple(s.split(":")) for s in base.split(",")] if base else []
                more = [(LEARNED, a, a + len(t)) for a, t in zip(starts, tokens) if known.score(t) >= least]
                sha.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append(joined(ordered([(k, int(a), int(b)) for k, a, b in own] + more)) if more else base)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sha, pa.string()), pa.array(spans, pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    slim = found.select("doc_id", "n_assign", "n_access", "n_hex", "base", "starts", "tokens")
    return map_arrow(slim, score, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
