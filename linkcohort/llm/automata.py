"""Probabilistic automata inferred from strings by merging states of their prefix tree."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from heapq import heappop, heappush

SYMBOLS = 11  # digits, four sorts of letters, some signs


def symbols(text: str) -> str:
    """A symbol for each character: d digits, h and H letters to f, l and L later ones, signs as they are."""
    out = []
    for c in text:
        if c.isdigit():
            out.append("d")
        elif c.isalpha():
            kind = "h" if c.lower() <= "f" else "l"
            out.append(kind if c.islower() else kind.upper())
        else:
            out.append(c)
    return "".join(out)


@dataclass
class State:
    n: int = 0  # strings that came here
    ends: int = 0
    counts: dict[str, int] = field(default_factory=dict)
    to: dict[str, int] = field(default_factory=dict)


class Automaton:
    """States are compatible if ends and next symbols are as frequent, within Hoeffding's bound, and so are all states after them."""

    def __init__(self, strings: Iterable[str], alpha: float = 0.05):
        self.states: list[State] = [State()]
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.alphabet: set[str] = set()
        for s in strings:
            self._add(symbols(s))
        self._infer()

    @classmethod
    def of_tree(cls, nodes: Mapping[str, Mapping[str, int]], alpha: float = 0.05) -> Automaton:
        """Inferred from counted nodes of a prefix tree, by their symbols: how often each symbol comes next, the empty one for ends.

        A node that is left out, with all below it, is too rare to be told from any
        other state; like those that one string comes to, it is taken for the first state.
        """
        out = cls((), alpha)
        nodes = nodes or {"": {}}
        place = {prefix: i for i, prefix in enumerate(sorted(nodes))}
        out.states = [
            State(sum(n.values()), n.get("", 0), {c: k for c, k in sorted(n.items()) if c}, {c: place[prefix + c] for c in sorted(n) if c and prefix + c in place})
            for prefix, n in sorted(nodes.items())
        ]
        out._infer()
        for state in out.states:
            state.to = {c: state.to.get(c, 0) for c in state.counts}
        out.alphabet = {c for state in out.states for c in state.counts}
        return out

    def steps(self, word: str) -> Iterator[tuple[int, str]]:
        """The states that symbols come to, and what comes next; the empty symbol at the end."""
        at = 0
        for c in word:
            yield at, c
            at = self.states[at].to.get(c, 0)
        yield at, ""

    def counted(self, counts: Mapping[tuple[int, str], int]) -> Automaton:
        """The same states with the counts of the ``steps`` of all strings."""
        out = type(self)(())
        out.bound, out.states = self.bound, [State(to=dict(state.to)) for state in self.states]
        for (at, c), n in sorted(counts.items()):
            state = out.states[at]
            state.n += n
            if c:
                state.counts[c] = n
                state.to.setdefault(c, 0)
                out.alphabet.add(c)
            else:
                state.ends = n
        return out

    def _add(self, word: str) -> None:
        at = self.states[0]
        at.n += 1
        for c in word:
            self.alphabet.add(c)
            at.counts[c] = at.counts.get(c, 0) + 1
            if c not in at.to:
                at.to[c] = len(self.states)
                self.states.append(State())
            at = self.states[at.to[c]]
            at.n += 1
        at.ends += 1

    def _differ(self, x: int, n: int, y: int, m: int) -> bool:
        return abs(x / n - y / m) > self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            p, q = (self.states[i] for i in todo.pop())
            if self._differ(p.ends, p.n, q.ends, q.n):
                return False
            for c in p.counts.keys() | q.counts.keys():
                if self._differ(p.counts.get(c, 0), p.n, q.counts.get(c, 0), q.n):
                    return False
                if c in p.to and c in q.to and p.to[c] != q.to[c]:
                    todo.append((p.to[c], q.to[c]))
        return True

    def _fold(self, into: int, tree: int) -> list[tuple[int, str]]:
        """Add a state of the tree, with all below it, to another state; returns the states and symbols that lead on anew."""
        todo, new = [(into, tree)], []
        while todo:
            a, b = todo.pop()
            p, q = self.states[a], self.states[b]
            p.n += q.n
            p.ends += q.ends
            for c, n in q.counts.items():
                p.counts[c] = p.counts.get(c, 0) + n
            for c, below in q.to.items():
                if c in p.to:
                    todo.append((p.to[c], below))
                else:
                    p.to[c] = below
                    new.append((a, c))
        return new

    def _infer(self) -> None:
        """Settled states in order; a state next to them is merged with the first compatible one, or settles."""
        settled, place = [0], {0: 0}
        todo = [(0, c) for c in sorted(self.states[0].to)]
        while todo:
            at, c = heappop(todo)
            source = settled[at]
            b = self.states[source].to[c]
            if b in place:
                continue
            for r in settled:
                if self._compatible(r, b):
                    self.states[source].to[c] = r
                    for a, d in self._fold(r, b):
                        if a in place:
                            heappush(todo, (place[a], d))
                    break
            else:
                place[b] = len(settled)
                settled.append(b)
                for d in self.states[b].to:
                    heappush(todo, (place[b], d))
        self._keep(settled)

    def _keep(self, settled: list[int]) -> None:
        """Only the states that are left, in order: all others were merged into them."""
        number = {old: new for new, old in enumerate(settled)}
        self.states = [self.states[old] for old in settled]
        for state in self.states:
            state.to = {c: number[to] for c, to in state.to.items()}

    def log_likelihood(self, text: str, floor: float = 0.05) -> float:
        """Of a string, ending included. Unseen symbols and ends have a small share each; after an unseen symbol all of the alphabet are as likely."""
        return self.likelihood_of_symbols(symbols(text), floor)

    def likelihood_of_symbols(self, word: str, floor: float = 0.05) -> float:
        kinds = max(len(self.alphabet) + 1, SYMBOLS)  # a small alphabet does not make other strings likelier
        unseen = -math.log(kinds + 1)
        at, total = self.states[0], 0.0
        for i, c in enumerate(word):
            total += math.log((at.counts.get(c, 0) + floor) / (at.n + floor * (kinds + 1)))
            if c not in at.to:
                strange = math.log(floor / (self.states[0].n + floor * (kinds + 1)))
                return total + sum(unseen if d in self.alphabet else strange for d in word[i + 1 :])
            at = self.states[at.to[c]]
        return total + math.log((at.ends + floor) / (at.n + floor * (kinds + 1)))


def shape_of(text: str) -> str:
    """numbers, capitals, letters or runs: strings without letters, of capitals only, of other letters only, and the others."""
    if text.isalpha():
        return "capitals" if text.isupper() else "letters"
    return "runs" if any(c.isalpha() for c in text) else "numbers"


@dataclass
class Formats:
    """An automaton for each kind of string, and one for each shape of ordinary strings, as all in one tree would blur each other."""

    kinds: dict[str, Automaton]
    ordinary: dict[str, Automaton]
    false_rate_at: float = -math.inf  # the score that one in so many held-out ordinary strings exceeds

    @classmethod
    def learn(cls, labelled: dict[str, Sequence[str]], words: Sequence[str], held_out: Sequence[str] = (), one_in: int = 1_000) -> Formats:
        """``held_out`` are ordinary strings too: scored by what the others give, if they are enough to tell, then learned from as well."""
        kinds = {k: Automaton(v) for k, v in sorted(labelled.items()) if v}

        def ordinary(strings: Sequence[str]) -> dict[str, Automaton]:
            by_shape: dict[str, list[str]] = {}
            for s in strings:
                by_shape.setdefault(shape_of(s), []).append(s)
            return {k: Automaton(v) for k, v in sorted(by_shape.items())}

        rate_at = -math.inf
        if words and len(held_out) >= one_in:
            scores = sorted(map(cls(kinds, ordinary(words)).score, held_out), reverse=True)
            rate_at = scores[len(scores) // one_in]
        return cls(kinds, ordinary([*words, *held_out]), rate_at)

    def score(self, text: str) -> float:
        """The best log-likelihood of the kinds, less the best of ordinary strings."""
        return self.score_of_symbols(symbols(text))

    def score_of_symbols(self, word: str) -> float:
        if not self.kinds or not self.ordinary:
            return -math.inf
        return max(a.likelihood_of_symbols(word) for a in self.kinds.values()) - max(a.likelihood_of_symbols(word) for a in self.ordinary.values())
