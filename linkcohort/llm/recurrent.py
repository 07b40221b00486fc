"""A gated recurrent language model in numpy: class-factored output, truncated backpropagation, state carried over windows."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

WIDTH = 12  # of the state and of a symbol's vector
CLASSES = 20  # of words; each tail of rarer words is one class more
LANES = 512  # documents read side by side, at most
EACH = 2_048  # tokens of a lane that make another one worth while
WINDOW = 16  # tokens of a lane that errors run back over
ROWS = 1_024  # states whose classes are worked out at once
READ = 4 * WINDOW  # tokens of a lane that are scored at once
PIECE = 4_096  # tokens of a document that are learned from in a row; what follows begins with an empty state
SPAN = 64 * WINDOW  # tokens of a lane laid out at once
RATE, BETA1, BETA2 = 0.01, 0.9, 0.99
CLIP = 1.0  # of a gradient's norm


class Layout:
    """Symbols: ``words`` words by falling count, then ``tails`` classes of rarer words. Their counts, end symbol and classes."""

    def __init__(self, counts: np.ndarray, tail_mass: np.ndarray, end: int):
        self.words, self.tails, self.end = len(counts), len(tail_mass), end
        mass = counts.astype(np.float64) + 1
        weight = np.cumsum(np.sqrt(mass))
        edges = np.searchsorted(weight, np.linspace(0, weight[-1], CLASSES + 1)[1:-1]) + 1 if self.words else []
        self.edges = np.unique(np.concatenate([[0], edges, [self.words]])).astype(np.int64)  # class k has words edges[k] to edges[k + 1]
        n = len(self.edges) - 1
        self.class_of = np.concatenate([np.repeat(np.arange(n), np.diff(self.edges)), n + np.arange(self.tails)]).astype(np.int64)
        self.classes = n + self.tails
        self.word_start = np.log(mass).astype(np.float32)
        self.class_start = np.log(np.concatenate([np.add.reduceat(mass, self.edges[:-1]) if n else [], tail_mass])).astype(np.float32)

    def shapes(self) -> dict[str, tuple[int, ...]]:
        return {
            "vectors": (self.words + self.tails, WIDTH), "inward": (WIDTH, 3 * WIDTH), "bias": (3 * WIDTH,), "back": (WIDTH, 3 * WIDTH),
            "to_class": (WIDTH, self.classes), "class_bias": (self.classes,), "to_word": (WIDTH, self.words), "word_bias": (self.words,),
        }

    def start(self) -> np.ndarray:
        """The first weights: random vectors and gates; the output gives the counts' shares whatever the state."""
        rng, size = np.random.default_rng(13), {k: int(np.prod(s)) for k, s in self.shapes().items()}
        parts = {k: np.zeros(n, np.float32) for k, n in size.items()}
        parts["vectors"] = rng.normal(0, 0.5, size["vectors"]).astype(np.float32)
        for k in ("inward", "back"):
            parts[k] = rng.normal(0, WIDTH**-0.5, size[k]).astype(np.float32)
        parts["bias"][:WIDTH] = 1  # states are kept at first
        parts["class_bias"], parts["word_bias"] = self.class_start.copy(), self.word_start.copy()
        return np.concatenate(list(parts.values()))


def _chances(x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The natural log of each row's share of its ``own`` column, and the rows' sums; ``x`` becomes its exponential."""
    high, low = float(x.max()), float(x.min())
    x -= np.float32(high) if high - low < 80 else x.max(1, keepdims=True)  # either way no row's sum is 0 or infinite
    mine = x[np.arange(len(own)), own].astype(np.float64)
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], np.float32)
    return mine - np.log(total.astype(np.float64)), total


class Model:
    def __init__(self, layout: Layout, weights: np.ndarray):
        self.layout, self.flat = layout, weights.astype(np.float32, copy=True)
        self.w = self.views(self.flat)

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.layout.shapes().items():
            n = int(np.prod(shape))
            out[name] = flat[at : at + n].reshape(shape)
            at += n
        return out

    def run(self, given: np.ndarray, stays: np.ndarray, h: np.ndarray, table: np.ndarray | None = None) -> tuple[np.ndarray, list]:
        """States after each of the ``given`` symbols (time, lane); ``stays`` is 0 where a document begins.

        With the ``table`` of all symbols' inputs, nothing is kept for the way back.
        """
        w, d = self.w, WIDTH
        into = w["vectors"][given] @ w["inward"] + w["bias"] if table is None else table[given]
        states, trace = np.empty((*given.shape, d), np.float32), []
        for t in range(len(given)):
            prev = h * stays[t]
            g = prev @ w["back"]
            gates = np.tanh((into[t, :, : 2 * d] + g[:, : 2 * d]) * np.float32(0.5))
            gates += 1
            gates *= np.float32(0.5)
            z, r, gn = gates[:, :d], gates[:, d:], g[:, 2 * d :]
            new = np.tanh(into[t, :, 2 * d :] + r * gn)
            h = states[t] = new + z * (prev - new)
            if table is None:
                trace.append((prev, z, r, gn, new))
        return states, trace

    def back(self, given: np.ndarray, stays: np.ndarray, trace: list, errors: np.ndarray, grad: dict[str, np.ndarray]) -> None:
        """Gradients of the recurrent part from the ``errors`` of the states, back to the window's first token."""
        w, d = self.w, WIDTH
        d_in = np.empty((*given.shape, 3 * d), np.float32)
        d_back = np.empty_like(d_in)
        carry = np.float32(0)
        for t in range(len(given) - 1, -1, -1):
            prev, z, r, gn, new = trace[t]
            e = errors[t] + carry
            a, b = d_in[t], d_back[t]
            keep = e * z
            a[:, 2 * d :] = (e - keep) * (1 - new * new)
            a[:, :d] = (prev - new) * keep * (1 - z)
            a[:, d : 2 * d] = a[:, 2 * d :] * gn * r * (1 - r)
            b[:, : 2 * d] = a[:, : 2 * d]
            b[:, 2 * d :] = a[:, 2 * d :] * r
            carry = (keep + b @ w["back"].T) * stays[t]
        flat = d_in.reshape(-1, 3 * d)
        grad["back"][:] = np.concatenate([x[0] for x in trace]).T @ d_back.reshape(-1, 3 * d)
        ids = given.ravel()
        grad["inward"][:] = w["vectors"][ids].T @ flat
        grad["bias"][:] = flat.sum(0)
        order = np.argsort(ids, kind="stable")
        starts = np.flatnonzero(np.diff(ids[order], prepend=-1))
        grad["vectors"][ids[order][starts]] = np.add.reduceat((flat @ w["inward"].T)[order], starts)

    def output(self, h: np.ndarray, target: np.ndarray, grad: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each target symbol, and the errors of the states: first its class, then the word in it."""
        w, lay = self.w, self.layout
        n, kind = len(target), lay.class_of[target]
        logp, errors = np.empty(n), None if grad is None else np.empty_like(h)
        for at in range(0, n, ROWS):
            part = slice(at, at + ROWS)
            p = h[part] @ w["to_class"]
            p += w["class_bias"]
            logp[part], total = _chances(p, kind[part])
            if grad is not None:
                p *= (np.float32(1 / n) / total)[:, None]
                p[np.arange(len(p)), kind[part]] -= np.float32(1 / n)
                grad["to_class"] += h[part].T @ p
                grad["class_bias"] += p.sum(0)
                errors[part] = p @ w["to_class"].T
        order = np.argsort(kind, kind="stable")
        ends = np.searchsorted(kind[order], np.arange(len(lay.edges)))
        for k in range(len(lay.edges) - 1):
            at, lo, hi = order[ends[k] : ends[k + 1]], lay.edges[k], lay.edges[k + 1]
            if len(at) == 0 or hi - lo == 1:
                continue
            hk, own = h[at], target[at] - lo
            q = hk @ w["to_word"][:, lo:hi]
            q += w["word_bias"][lo:hi]
            share, total = _chances(q, own)
            logp[at] += share
            if grad is not None:
                q *= (np.float32(1 / n) / total)[:, None]
                q[np.arange(len(at)), own] -= np.float32(1 / n)
                grad["to_word"][:, lo:hi] = hk.T @ q
                grad["word_bias"][lo:hi] = q.sum(0)
                errors[at] += q @ w["to_word"][:, lo:hi].T
        return logp, errors


def lanes(docs: list[np.ndarray], end: int, window: int = WINDOW) -> Iterator[np.ndarray]:
    """Windows over documents laid end to end in lanes: (4, time, lane) of given symbol, target, document and 1 where one begins.

    The longest documents are dealt first, to the emptiest lane. Lanes are in order
    of length, so those that have ended are the last; past its end a lane's target is -1.
    """
    heap = [(0, k) for k in range(min(LANES, len(docs), max(32, sum(map(len, docs)) // EACH)))]
    dealt: list[list[int]] = [[] for _ in heap]
    for i in sorted(range(len(docs)), key=lambda i: (-len(docs[i]), i)):
        if len(docs[i]):
            size, k = heap[0]
            heapq.heapreplace(heap, (size + len(docs[i]), k))
            dealt[k].append(i)
    streams = [(np.concatenate([docs[i] for i in own]), np.repeat(np.array(own, np.int32), [len(docs[i]) for i in own])) for own in dealt if own]
    streams.sort(key=lambda x: -len(x[0]))
    sizes = -np.array([len(x) for x, _ in streams])
    for at in range(0, -sizes[0] if streams else 0, SPAN):
        active = int(np.searchsorted(sizes, -at))
        out = np.zeros((4, SPAN, active), np.int32)
        given, target, whose, first = out
        target[:] = whose[:] = first[0] = -1
        for k in range(active):
            symbols, own = streams[k]
            n = min(SPAN, len(symbols) - at)
            target[:n, k], whose[:n, k] = symbols[at : at + n], own[at : at + n]
            if at:
                given[0, k], first[0, k] = symbols[at - 1], own[at - 1]
        given[1:], first[1:] = target[:-1], whose[:-1]
        first[:] = whose != first
        given[(first == 1) | (given < 0)] = end
        whose[whose < 0] = 0
        for w in range(0, min(SPAN, -sizes[0] - at), window):
            yield out[:, w : w + window, : int(np.searchsorted(sizes, -at - w))]


def log_likelihoods(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each document's symbols."""
    total, h = np.zeros(len(docs)), None
    table = model.w["vectors"] @ model.w["inward"] + model.w["bias"]
    for given, target, whose, first in lanes(docs, model.layout.end, READ):
        n = given.shape[1]
        h = np.zeros((n, WIDTH), np.float32) if h is None else h[:n]
        states, _ = model.run(given, (1 - first).astype(np.float32)[..., None], h, table)
        h, real = states[-1], target >= 0
        logp, _ = model.output(states[real], target[real])
        total += np.bincount(whose[real], logp, len(docs))
    return total


class Trainer:
    """Adam over windows of lanes; errors run back over a window, states run on."""

    def __init__(self, layout: Layout, weights: np.ndarray):
        self.model, self.tokens, self.steps = Model(layout, weights), 0, 0
        self.grad = np.zeros_like(self.model.flat)
        self.parts = self.model.views(self.grad)
        self.mean, self.square = np.zeros_like(self.grad), np.zeros_like(self.grad)

    def learn(self, docs: list[np.ndarray]) -> None:
        """From all tokens of the documents; long ones are cut into pieces, so that no lane outlasts the others by far."""
        m, h = self.model, None
        docs = [d[at : at + PIECE] for d in docs for at in range(0, len(d), PIECE)]
        for given, target, _, first in lanes(docs, m.layout.end):
            n = given.shape[1]
            h = np.zeros((n, WIDTH), np.float32) if h is None else h[:n]
            stays, real = (1 - first).astype(np.float32)[..., None], target >= 0
            states, trace = m.run(given, stays, h)
            h = states[-1]
            self.grad[:] = 0
            _, errors = m.output(states[real], target[real], self.parts)
            full = np.zeros_like(states)
            full[real] = errors
            m.back(given, stays, trace, full, self.parts)
            self.step()
            self.tokens += int(real.sum())

    def step(self) -> None:
        g = self.grad
        norm = float(np.sqrt(g @ g))
        if norm > CLIP:
            g *= np.float32(CLIP / norm)
        self.steps += 1
        self.mean += np.float32(1 - BETA1) * (g - self.mean)
        self.square += np.float32(1 - BETA2) * (g * g - self.square)
        rate = RATE * (1 - BETA2**self.steps) ** 0.5 / (1 - BETA1**self.steps)
        self.model.flat -= np.float32(rate) * self.mean / (np.sqrt(self.square) + np.float32(1e-7))
