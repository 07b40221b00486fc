"""Repair of conversation structure: the cheapest edits that make turns alternate, ties settled by their letters.

A path's weight is one integer. Its high digits are the cost, its low digits the
letters of its audit, of fixed width, the first letter highest and zeros at the
end; so the smaller integer is the cheaper path, and of equally cheap ones the
one whose audit comes first. Nothing but ``min`` on these integers decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.llm.common import arrow_schema, cut, map_arrow

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
PIECE = 512  # rows of a conversation whose paths are worked out together; longer ones are chains of such pieces
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
START, S, U, A = range(4)  # what the repaired rows so far end with
NEXT = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
GOAL = (U, U, A, U)  # where an inserted or reroled row leads, which takes the role that can follow
ROLES = {U: "user", A: "assistant"}
LETTERS = {letter: i + 1 for i, letter in enumerate("DIKR")}
DIGIT = 3  # bits of a letter; 0 is the padding
INF = 1 << 62  # a cost beyond all others


@dataclass(frozen=True)
class Costs:
    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5  # more than 0, or inserting would never end
    truncated: int = 5  # added where a truncated row stays


class Weights:
    """Weights with ``width`` letters; ``put`` sets a letter and its cost before a path."""

    def __init__(self, width: int):
        self.bits = DIGIT * width
        self.low = (1 << self.bits) - 1
        self.none = INF << self.bits

    def put(self, path: int, cost: int, letter: int) -> int:
        if path >= self.none:
            return self.none
        bits = self.bits
        return (path >> bits) + cost << bits | letter << bits - DIGIT | (path & self.low) >> DIGIT

    def cost(self, path: int) -> int:
        return path >> self.bits

    def digits(self, path: int) -> list[int]:
        out, at = [], self.bits - DIGIT
        while at >= 0 and (d := path >> at & (1 << DIGIT) - 1):
            out.append(d)
            at -= DIGIT
        return out

    def audit(self, path: int) -> str:
        return "".join(" DIKR"[d] for d in self.digits(path))


def before_rows(rows: list[tuple[str, int]], ends: list[int], weights: Weights, costs: Costs) -> list[int]:
    """The least weight from each state before ``rows`` (initial, fault), given that from each state after them.

    Rows are edited last to first; what is inserted goes before a row, at most two
    in a place, as two more lead back to the same state at a price.
    """
    put, d, i, k, r = weights.put, *(LETTERS[x] for x in "DIKR")
    paths = ends
    for initial, fault in reversed(rows):
        here = [put(p, costs.delete, d) for p in paths]
        if fault in (OK, TRUNCATED):
            more = costs.truncated if fault == TRUNCATED else 0
            for q in range(4):
                here[q] = min(here[q], put(paths[GOAL[q]], costs.rerole + more, r))
                if (to := NEXT.get((q, initial))) is not None:
                    here[q] = min(here[q], put(paths[to], costs.keep + more, k))
        once = [min(p, put(here[GOAL[q]], costs.insert, i)) for q, p in enumerate(here)]
        paths = [min(p, put(once[GOAL[q]], costs.insert, i)) for q, p in enumerate(here)]
    return paths


def at_end(weights: Weights, costs: Costs) -> list[int]:
    """The least weight after all rows: nothing or a whole pair of turns stands, or else inserted rows complete it."""
    done = {START: 0, A: 0}
    one = weights.put(0, costs.insert, LETTERS["I"])
    return [done.get(q, one if q == U else weights.put(one, costs.insert, LETTERS["I"])) for q in range(4)]


@lru_cache(1 << 14)
def whole(rows: tuple[tuple[str, int], ...], costs: Costs) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    weights = Weights(3 * len(rows) + 2)
    best = before_rows(list(rows), at_end(weights, costs), weights, costs)[START]
    return weights.cost(best), weights.audit(best)


def between(rows: list[tuple[str, int]], costs: Costs) -> tuple[list[int], list[int], list[str]]:
    """For each state before and after a piece (4 * before + after): cost, rank of the audit among the piece's other ends, audit.

    Each audit ends with the letter of the last row, so none begins another one of
    the same piece, and their order settles that of all longer ones.
    """
    weights = Weights(3 * len(rows))
    found = [before_rows(rows, [0 if q == e else weights.none for q in range(4)], weights, costs) for e in range(4)]
    return *ranked(found, weights), [weights.audit(found[e][q]) if found[e][q] < weights.none else "" for q in range(4) for e in range(4)]


def ranked(found: list[list[int]], weights: Weights) -> tuple[list[int], list[int]]:
    costs, ranks = [], []
    for q in range(4):
        order = sorted(range(4), key=lambda e: found[e][q] & weights.low)
        costs += [min(INF, weights.cost(found[e][q])) for e in range(4)]
        ranks += [order.index(e) + 1 for e in range(4)]
    return costs, ranks


def chain(tables: list[tuple[list[int], list[int]]], ends: list[int], weights: Weights) -> tuple[list[int], list[list[int]]]:
    """As ``before_rows`` over pieces, whose ranks are the letters; also where to go from each state before each piece."""
    paths, ways = ends, []
    for costs, ranks in reversed(tables):
        here = []
        for q in range(4):
            here.append(min((weights.put(paths[e], costs[4 * q + e], ranks[4 * q + e]) if costs[4 * q + e] < INF else weights.none, e) for e in range(4)))
        paths = [w for w, _ in here]
        ways.append([e for _, e in here])
    return paths, ways[::-1]


def joined(tables: list[tuple[list[int], list[int]]]) -> tuple[list[int], list[int], bytes]:
    """Costs and ranks of a chain of pieces as of one piece, and the ways through it: by end, piece and state before it."""
    weights = Weights(len(tables) + 1)
    runs = [chain(tables, [0 if q == e else weights.none for q in range(4)], weights) for e in range(4)]
    return *ranked([paths for paths, _ in runs], weights), bytes(e for _, ways in runs for w in ways for e in w)


def through(ways: bytes, start: int, end: int) -> list[int]:
    """4 * before + after for each piece of a chain."""
    n, out = len(ways) // 16, []
    for piece in range(n):
        after = ways[4 * (end * n + piece) + start]
        out.append(4 * start + after)
        start = after
    return out


class Counts:
    """What is counted over rows in order; ``add`` takes the counts of the rows that follow."""

    FIELDS = ("blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns")

    def __init__(self, *values):
        self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last, self.low, self.high, self.turns = values or (0, 0, 0, 0, None, None, None, None, 0)

    def row(self, initial: str, fault: int, turn: int | None) -> None:
        self.add(Counts(fault == BLANK, fault == DUPLICATE, fault == TRUNCATED, 0, initial, initial, turn, turn, turn is not None))

    def add(self, o: Counts) -> None:
        self.blank += o.blank
        self.duplicate += o.duplicate
        self.truncated += o.truncated
        if o.first is not None:
            self.illegal += o.illegal + (self.first is not None and (self.last + o.first) not in ("su", "ua", "au"))
            self.first, self.last = o.first if self.first is None else self.first, o.last
        if o.low is not None:
            self.turns += o.turns - (self.high == o.low)
            self.low, self.high = o.low if self.low is None else self.low, o.high

    def values(self) -> list:
        return [getattr(self, f) for f in self.FIELDS]

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)


class Repaired:
    """The repaired rows as their digest, from the rows and audits of a conversation's pieces in turn."""

    def __init__(self):
        self.state, self.hash, self.any = START, hashlib.sha256(), False

    def emit(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True

    def add(self, roles: list[str], texts: list[str], audit: str) -> None:
        at = 0
        for letter in audit:
            if letter in "IR":
                self.state = GOAL[self.state]
                self.emit(ROLES[self.state], "" if letter == "I" else texts[at])
            elif letter == "K":
                self.state = NEXT[self.state, roles[at][0]]
                self.emit(roles[at], texts[at])
            at += letter != "I"


RESULT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
PIECES = (
    "part int, seq int, costs array<long>, ranks array<int>, ways binary, roles array<string>, texts array<string>, audits array<string>, "
    "first string, last string, low long, high long, turns long"
)


def find_faults(text: Column) -> Column:
    """BLANK, TRUNCATED or OK by the text alone."""
    bare = F.rtrim(text, F.lit(SPACES))
    return F.when(F.octet_length(bare) == 0, BLANK).when(F.right(bare, F.lit(1)).isin(*ENDS), OK).otherwise(TRUNCATED)


def damage(conversations: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text``, ``copies``: the rows as the contract damages them.

    NULLs are one space. What is dropped stays as a row without turn, role and
    text, so that its conversation is not lost.
    """
    conv, turn = conversations["conv_id"].cast("string"), conversations["turn"]
    role, text = (F.coalesce(conversations[c], F.lit(" ")) for c in ("role", "text"))
    key = F.concat(F.coalesce(conv, F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    rows = conversations.select(
        conv.alias("conv"), turn.cast("long").alias("turn"), role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fault")
    )
    stays, fault = F.col("fault") != 0, F.col("fault")
    return rows.select(
        "conv",
        F.when(stays, F.col("turn")).alias("turn"),
        F.when(fault == 4, "user").when(stays, F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate("text", ENDS, "")).when(stays, F.col("text")).alias("text"),
        F.when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def in_order(rows: DataFrame) -> DataFrame:
    """Equal rows once with their number ``n``, sorted through all partitions; before a repeat of an earlier row stands a mark, ``n`` below 0.

    Sorting is by conversation, turn, role and hash of the text, so one conversation
    may lie in many partitions. Repeats are found on hashes only; that side too uses
    ``n`` and rows without a role, so the texts are dealt out by equality once for both.
    """
    once = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("n")).withColumn("h", F.unhex(F.sha2("text", 256)))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    said = once.select("conv", "turn", "role", "h", "n", when.alias("at"))
    firsts = said.groupBy("conv", "role", "h").agg(F.min("at").alias("first"), F.sum("n").alias("times")).filter("times > 1")
    a, b = said.alias("a"), firsts.alias("b")
    again = a.join(b, reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("conv", "role", "h")]))
    marks = again.filter("a.at != b.first").select("a.conv", "a.turn", "a.role", "a.h", (-F.col("a.n")).alias("n"), F.lit(None).cast("string").alias("text"))
    order = ["conv", "turn", "role", "h"]
    every = once.select(*order, "n", "text").unionByName(marks)
    return every.repartitionByRange(*order).sortWithinPartitions(*order, "n").select("conv", "turn", "role", "n", "text", find_faults(F.col("text")).alias("fault"))


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, turn, role, text, fault) of each row of the sorted ones, copies written out; role None where only the conversation is known."""
    marked = False
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for conv, turn, role, n, text, fault in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns]):
                if role is None:
                    yield conv, None, None, None, None
                elif n < 0:
                    marked = True
                else:
                    yield conv, turn, role, text, DUPLICATE if marked and fault != BLANK else fault
                    again = DUPLICATE if fault != BLANK else BLANK
                    for _ in range(n - 1):
                        yield conv, turn, role, text, again
                    marked = False


class _Run:
    """The rows of one conversation in one partition."""

    def __init__(self, conv: str | None):
        self.conv, self.tables, self.seq = conv, [], 0
        self.clear()

    def clear(self) -> None:
        self.roles, self.texts, self.turns, self.marks, self.counts = [], [], [], [], Counts()

    def row(self, turn, role, text, fault) -> None:
        initial = role[:1]
        self.roles.append(role)
        self.texts.append(text)
        self.marks.append((initial, fault))
        self.counts.row(initial, fault, turn)

    def finished(self, costs: Costs) -> dict:
        cost, audit = whole(tuple(self.marks), costs)
        out = Repaired()
        out.add(self.roles, self.texts, audit)
        return _result(self.conv, self.counts, cost, audit, out)

    def piece(self, part: int, costs: Costs) -> dict:
        price, ranks, audits = between(self.marks, costs)
        self.tables.append((price, ranks))
        values = dict(zip(Counts.FIELDS, self.counts.values()))
        out = {"conv": self.conv, "part": part, "seq": self.seq, "roles": self.roles, "texts": self.texts, "audits": audits, **values}
        self.seq += 1
        self.clear()
        return out

    def total(self, part: int) -> dict:
        price, ranks, ways = joined(self.tables)
        return {"conv": self.conv, "part": part, "seq": -1, "costs": price, "ranks": ranks, "ways": ways}


def _result(conv, counts: Counts, cost: int, audit: str, repaired: Repaired) -> dict:
    numbers = {f: getattr(counts, f) for f in ("blank", "duplicate", "truncated", "illegal")}
    return {"conv": conv, "gaps": counts.gaps, **numbers, "cost": cost, "audit": audit, "repaired_sha256": repaired.hash.hexdigest()}


def _batches(rows: Iterator[dict], schema: str, size: int) -> Iterator[pa.RecordBatch]:
    types, held = arrow_schema(schema), []
    for row in rows:
        held.append(row)
        if len(held) >= size or row.get("texts"):
            yield pa.RecordBatch.from_pylist(held, schema=types)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=types)


def _pieces(batches: Iterable[pa.RecordBatch], costs: Costs, size: int) -> Iterator[dict]:
    """The result of each conversation that surely lies in this partition alone and is one piece; pieces and totals of the others."""
    part = TaskContext.get().partitionId()
    run, first = None, True
    for conv, turn, role, text, fault in _rows(batches):
        if run is None or conv != run.conv:
            if run is not None:
                yield from _close(run, part, costs, alone=not first)
                first = False
            run = _Run(conv)
        if role is not None:
            if len(run.marks) == size:
                yield run.piece(part, costs)
            run.row(turn, role, text, fault)
    if run is not None:
        yield from _close(run, part, costs, alone=False)


def _close(run: _Run, part: int, costs: Costs, alone: bool) -> Iterator[dict]:
    if alone and not run.tables:
        yield run.finished(costs)
    else:
        yield run.piece(part, costs)
        yield run.total(part)


def _choose(batches: Iterable[pa.RecordBatch], costs: Costs) -> Iterator[dict]:
    """The ways through each conversation's totals, which come in order of their partitions."""
    for batch in batches:
        for conv, totals in zip(*[c.to_pylist() for c in batch.columns]):
            weights = Weights(len(totals) + 3)
            ends = at_end(weights, costs)
            paths, ways = chain([(t["costs"], t["ranks"]) for t in totals], ends, weights)
            state, cost = START, weights.cost(paths[START])
            for k, (total, to) in enumerate(zip(totals, ways)):
                tail = weights.audit(ends[to[state]]) if k == len(totals) - 1 else None
                yield {"conv": conv, "part": total["part"], "seq": -1, "ranks": through(total["ways"], state, to[state]), "cost": cost, "audit": tail}
                state = to[state]


def _assemble(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Each long conversation from its pieces, sorted, the ways of a partition before its pieces; holds one piece."""
    now, counts, repaired, audit, cost, ways, tail = None, Counts(), Repaired(), [], 0, [], ""

    def result() -> dict:
        repaired.add([], [], tail)
        return _result(now[0], counts, cost, "".join(audit) + tail, repaired)

    for batch in batches:
        for k in range(batch.num_rows):
            p = batch.slice(k, 1).to_pylist()[0]
            if now is None or p["conv"] != now[0]:
                if now is not None:
                    yield result()
                now, counts, repaired, audit, tail = (p["conv"],), Counts(), Repaired(), [], ""
            if p["seq"] < 0:
                ways, cost, tail = p["ranks"], p["cost"], p["audit"] or ""
                continue
            letters = p["audits"][ways[p["seq"]]]
            counts.add(Counts(*[p[f] for f in Counts.FIELDS]))
            repaired.add(p["roles"], p["texts"], letters)
            audit.append(letters)
    if now is not None:
        yield result()


def repair_conversations(conversations: DataFrame, costs: Costs = Costs(), piece: int = PIECE) -> DataFrame:
    """One row per conv_id of ``conversations``: its faults after ``damage``, the cheapest edits and the digest of what they leave.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    NULL conv_ids are one conversation; NULL turns come first and make no gap. Rows
    of one turn go by role, then by the SHA-256 of their text. A role without
    letters can be reroled or deleted, not kept. Further columns are ignored; an
    empty table gives no rows, a conversation without rows zeros and empty texts.

    Rows are sorted through all partitions, so a conversation of any length is
    spread: its pieces of ``piece`` rows become tables of costs and ranks in
    parallel, each partition's pieces one table, and a conversation's tables, at
    most one a partition, choose the path. Only its digest, which is one pass over
    the repaired text, reads the pieces of a long conversation one after another.
    """
    schema = f"{RESULT}, {PIECES}"
    sorted_rows = in_order(damage(conversations))
    found = cut(map_arrow(sorted_rows, lambda b: _batches(_pieces(b, costs, piece), schema, 1_024), schema), "conversation-pieces")
    names = [c.strip().split(" ")[0] for c in RESULT.split(",")]
    done = found.filter("part IS NULL").select(names)
    totals = found.filter("seq = -1").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "costs", "ranks", "ways"))).alias("totals"))
    ways = map_arrow(totals, lambda b: _batches(_choose(b, costs), schema, 1_024), schema)
    pieces = found.filter("seq >= 0").unionByName(ways).repartition("conv").sortWithinPartitions("conv", "part", "seq")
    long = map_arrow(pieces, lambda b: _batches(_assemble(b), RESULT, 1_024), RESULT)
    kind = conversations.schema["conv_id"].dataType
    return done.unionByName(long).select(F.col("conv").cast(kind).alias("conv_id"), *names[1:])
