"""A small causal self-attention language model in numpy.

One head over the last tokens: queries, keys and values come from tables by token id, a
learned bias says how much a distance counts, and masked softmax weighs the earlier tokens.
The attended state and the current token give the weights of ``mixes`` output distributions,
and the next token's probability is their weighted sum, so every conditional distribution
sums to one over the whole vocabulary without a softmax over it at each position.

Training alternates: the responsibilities of the output distributions are computed, the
distributions are re-estimated from them (expectation-maximisation with a running memory),
and everything below follows the gradient (Adagrad, only rows that were touched). ``tally`` is
the last step of that alternation over a whole corpus, in its hard form: a token counts for the
one distribution that most likely emitted it. Copies of a
model that were trained apart are averaged row by row (``rows``, ``take_rows``).

Texts are scored in overlapping windows of ``LENGTH`` tokens that move by ``STRIDE``; a window
scores its last ``STRIDE`` tokens, so each token is scored once with at least
``LENGTH - STRIDE`` tokens of context, where the text has them.
"""

from __future__ import annotations

import copy
from dataclasses import dataclass, field

import numpy as np

LENGTH, STRIDE = 24, 16
_BATCH = 256
_CONTEXT = LENGTH - STRIDE
#: The distance of context token j from scored token i of a window, and what is causal.
_BACK = np.arange(STRIDE)[:, None] + _CONTEXT - np.arange(LENGTH)[None, :]
_CAUSAL = _BACK >= 0
_BACK_AT = np.abs(_BACK).ravel()
_LENGTH_ONES = np.ones(LENGTH, np.float32)


def _rows(values: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and the sums of their rows of ``values``; ids below 0 are left out."""
    # As unsigned numbers -1 comes last, and 16 bits are sorted by radix.
    order = np.argsort(ids.astype(np.uint16 if ids.max(initial=0) < 0xFFFF else np.uint32), kind="stable")
    order = order[: np.count_nonzero(ids >= 0)]
    if not len(order):
        return ids[:0], values[:0]
    ids, rows = ids.take(order), values.take(order, axis=0)
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    # Two numbers are added at once, as a complex one.
    pairs = rows.view(np.complex64) if rows.dtype == np.float32 and rows.shape[1] % 2 == 0 else rows
    return ids.take(first), np.add.reduceat(pairs, first, axis=0).view(rows.dtype)


def windows(flat: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, text number of each window) of token sequences, each ended by ``end``.

    ``flat`` has the tokens of all texts, ``sizes`` their numbers. Inputs begin with ``end`` as
    the start mark. -1 stands before a text and after it.
    """
    n = np.asarray(sizes, np.int64) + 1
    count = -(-n // STRIDE)
    begin = np.cumsum(count) - count
    total = int(count.sum())
    targets = np.full(total * STRIDE, -1, np.int32)
    stop = np.cumsum(n - 1)
    targets[np.arange(len(flat)) + np.repeat(begin * STRIDE - (stop - (n - 1)), n - 1)] = flat
    targets[begin * STRIDE + n - 1] = end
    shifted = np.full(total * STRIDE, -1, np.int32)
    shifted[1:] = targets[:-1]
    shifted[begin * STRIDE] = end
    shifted[targets < 0] = -1
    own = shifted.reshape(total, STRIDE)
    inputs = np.full((total, LENGTH), -1, np.int32)
    inputs[:, _CONTEXT:] = own
    first = np.zeros(total, bool)
    first[begin] = True
    same = np.flatnonzero(~first)
    inputs[same, :_CONTEXT] = own[same - 1, STRIDE - _CONTEXT :]
    return inputs, targets.reshape(total, STRIDE), np.repeat(np.arange(len(n)), count)


def _hide(a: np.ndarray, inputs: np.ndarray) -> None:
    """No attention to what stands before a text or after it."""
    ragged = np.flatnonzero((inputs[:, 0] < 0) | (inputs[:, -1] < 0))
    if len(ragged):
        a[ragged] += np.where(inputs[ragged] >= 0, np.float32(0), np.float32(-1e9))[:, None, :]


def _exp(x: np.ndarray, low: bool = False) -> None:
    """In place, of at most 60; ``low`` says that none is greater."""
    if not low and x.max(initial=0) > 60:
        np.minimum(x, 60, out=x)
    np.exp(x, out=x)


@dataclass
class AttentionModel:
    """``now`` has the query, the state and the mixture logits of a token, ``past`` its key and value."""

    vocabulary: int
    width: int = 8
    mixes: int = 16
    seed: int = 2
    tables: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        v, d, k = self.vocabulary, self.width, self.mixes
        normal = lambda *shape, s: (s * rng.standard_normal(shape)).astype(np.float32)
        self.tables = {"now": normal(v, 2 * d + k, s=0.3), "past": normal(v, 2 * d, s=0.3), "top": normal(d, k, s=0.35), "distance": np.zeros(LENGTH, np.float32)}
        self.squares = {n: np.full_like(t, 1e-3) for n, t in self.tables.items()}
        self.emitted = np.full((v, k), 1.0 / v, np.float32)

    def _forward(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        """What training needs of each window; ``e`` has the mixture weights, not yet divided by their sums."""
        t, d, n = self.tables, self.width, len(inputs)
        own = t["now"].take(inputs[:, _CONTEXT:].reshape(-1), axis=0, mode="clip")  # -1 reads row 0, masked below
        past = t["past"].take(inputs, axis=0, mode="clip")
        q, k, v = (own[:, :d] * np.float32(1 / np.sqrt(d))).reshape(n, STRIDE, d), past[..., :d], past[..., d:]
        a = np.matmul(q, k.transpose(0, 2, 1))
        a += np.where(_CAUSAL, t["distance"][np.abs(_BACK)], np.float32(-1e9))
        _hide(a, inputs)
        _exp(a)
        total = np.maximum(a @ _LENGTH_ONES, np.float32(1e-30))
        o = np.matmul(a, v)
        o *= (1 / total)[..., None]
        h = o.reshape(-1, d) + own[:, d : 2 * d]
        np.tanh(h, out=h)
        e = h @ t["top"]
        e += own[:, 2 * d :]
        _exp(e)
        return {"q": q, "k": k, "v": v, "a": a, "total": total, "o": o, "h": h, "e": e}

    def probabilities(self, inputs: np.ndarray) -> np.ndarray:
        """The weights of the output distributions at every position."""
        e = self._forward(inputs)["e"]
        return e / e.sum(axis=1, keepdims=True)

    def mass(self, flags: np.ndarray) -> np.ndarray:
        """The probability of the flagged tokens in each output distribution."""
        return self.emitted[flags].sum(axis=0)

    def scoring_only(self) -> AttentionModel:
        """The model without what only training needs."""
        out = copy.copy(self)
        out.squares = {}
        return out

    def _adagrad(self, name: str, grad: np.ndarray, rate: float, rows: np.ndarray | None = None) -> None:
        table, squares = self.tables[name], self.squares[name]
        if rows is None:
            squares += grad * grad
            table -= np.float32(rate) * grad / np.sqrt(squares)
            return
        sums = squares.take(rows, axis=0)
        sums += grad * grad
        squares[rows] = sums
        np.sqrt(sums, out=sums)
        np.divide(grad, sums, out=sums)
        sums *= np.float32(-rate)
        sums += table.take(rows, axis=0)
        table[rows] = sums

    def begin(self, targets: np.ndarray) -> np.ndarray:
        """Random expected counts near the tokens' frequencies; the output distributions follow them."""
        rng = np.random.default_rng(self.seed)
        seen = np.bincount(targets[targets >= 0], minlength=self.vocabulary) + 0.5
        base = (seen / seen.sum())[:, None]
        counts = (base * rng.gamma(1.0, 1.0, (self.vocabulary, self.mixes)) * 2000).astype(np.float32)
        self._emit(counts)
        return counts

    def learn(self, inputs: np.ndarray, targets: np.ndarray, counts: np.ndarray, steps: int, batch: int = 512, rate: float = 0.15, last_rate: float = 0.03, memory: float = 8.0) -> None:
        """``steps`` gradient steps over the windows in a fixed random order; ``counts`` goes along."""
        if not len(inputs) or not steps:
            return
        rng = np.random.default_rng(self.seed)
        order = np.concatenate([rng.permutation(len(inputs)) for _ in range(-(-steps * batch // len(inputs)))])
        sums = counts.sum(axis=0, dtype=float)
        scale = 1.0  # what is remembered of the counts at all; they are multiplied by it at the end
        for step in range(steps):
            pick = order[step * batch : (step + 1) * batch]
            ids, resp = self._step(inputs[pick], targets[pick], rate + (last_rate - rate) * step / steps)
            scale *= 1 - 1 / (memory + 0.25 * step)
            resp *= np.float32(1 / scale)
            sums += resp.sum(axis=0)
            resp += counts.take(ids, axis=0)
            counts[ids] = resp
            if step % 4 == 3:  # the rows that the next four steps read
                soon = targets[order[(step + 1) * batch : (step + 5) * batch]]
                self._emit_rows(np.flatnonzero(np.bincount(soon.reshape(-1) + 1, minlength=1)[1:]), counts, sums, scale)
            if scale < 1e-6:
                counts *= np.float32(scale)
                sums, scale = sums * scale, 1.0
        counts *= np.float32(scale)
        self._emit(counts)

    def gather(self, inputs: np.ndarray, targets: np.ndarray, total: np.ndarray) -> None:
        """Add the responsibilities of the output distributions for every target to ``total``."""
        for at in range(0, len(inputs), 2 * _BATCH):
            flat = targets[at : at + 2 * _BATCH].reshape(-1)
            joint = self._forward(inputs[at : at + 2 * _BATCH])["e"]
            joint *= self.emitted.take(flat, axis=0, mode="clip")
            joint /= np.maximum(joint.sum(axis=1, keepdims=True), np.float32(1e-30))
            ids, resp = _rows(joint, flat)
            total[ids] += resp

    def settle(self, total: np.ndarray) -> None:
        """Output distributions from the counts of all training tokens."""
        self._emit(total)

    def _emit(self, counts: np.ndarray) -> None:
        self.emitted = np.empty(counts.shape, np.float32)
        self._emit_rows(slice(None), counts, counts.sum(axis=0, dtype=float), 1.0)

    def _emit_rows(self, rows: slice | np.ndarray, counts: np.ndarray, sums: np.ndarray, scale: float, prior: float = 200.0) -> None:
        """Some rows of the output distributions from ``scale`` times the counts, whose sums by distribution are ``sums``."""
        own = counts[rows] * scale
        base = (own.sum(axis=1, dtype=float) + 0.5) / (sums.sum() * scale + 0.5 * len(counts))
        self.emitted[rows] = (own + prior * base[:, None]) / (sums * scale + prior)

    def _step(self, inputs: np.ndarray, targets: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        d, n, flat = self.width, len(inputs), targets.reshape(-1)
        norm = np.float32(1 / np.sqrt(max(1, np.count_nonzero(flat >= 0))))
        now = np.empty((n * STRIDE, 2 * d + self.mixes), np.float32)
        past, gamma = np.empty((n, LENGTH, 2 * d), np.float32), np.empty((n * STRIDE, self.mixes), np.float32)
        dense = {name: np.zeros_like(self.tables[name]) for name in ("top", "distance")}
        for at in range(0, n, _BATCH):  # what a block computes stays in the processor's cache
            some, own = slice(at, at + _BATCH), slice(at * STRIDE, (at + _BATCH) * STRIDE)
            top, distance = self._gradient(inputs[some], flat[own], norm, now[own], past[some], gamma[own])
            dense["top"] += top
            dense["distance"] += distance
        for name, grad, ids in (("now", now, inputs[:, _CONTEXT:]), ("past", past.reshape(-1, 2 * d), inputs)):
            rows, sums = _rows(grad, ids.reshape(-1))
            self._adagrad(name, sums, rate, rows)
        for name, grad in dense.items():
            self._adagrad(name, grad, rate)
        return _rows(gamma, flat)

    def _gradient(self, inputs: np.ndarray, flat: np.ndarray, norm: np.float32, now: np.ndarray, past: np.ndarray, gamma: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The gradients of "top" and "distance"; those of each position and the responsibilities go to the last three arguments."""
        top, d, n = self.tables["top"], self.width, len(inputs)
        f = self._forward(inputs)
        a, e, h, ones = f["a"], f["e"], f["h"], np.ones(self.mixes, np.float32)
        # The responsibilities, and by how much the weights exceed them.
        np.multiply(e, self.emitted.take(flat, axis=0, mode="clip"), out=gamma)
        sums = e @ ones
        gamma *= (1 / np.maximum(gamma @ ones, np.float32(1e-30) * sums))[:, None]
        e *= (1 / sums)[:, None]
        e -= gamma
        e *= np.where(flat >= 0, norm, np.float32(0))[:, None]
        now[:, 2 * d :] = e
        dtop = h.T @ e
        dh = e @ top.T
        h *= h
        np.subtract(np.float32(1), h, out=h)
        dh *= h
        now[:, d : 2 * d] = dh
        # Attention is a / total: the division is made once on what it is multiplied by.
        dh *= np.repeat(1 / f["total"].reshape(-1), d).reshape(-1, d)
        do = dh.reshape(n, STRIDE, d)
        np.matmul(a.transpose(0, 2, 1), do, out=past[..., d:])
        ds = np.matmul(do, f["v"].transpose(0, 2, 1))
        dh *= f["o"].reshape(-1, d)
        ds -= (dh @ np.ones(d, np.float32)).reshape(n, STRIDE, 1)
        ds *= a
        np.matmul(ds, f["k"], out=now.reshape(n, STRIDE, -1)[..., :d])
        now[:, :d] *= np.float32(1 / np.sqrt(d))
        np.matmul(ds.transpose(0, 2, 1), f["q"], out=past[..., :d])
        by_place = np.ones(n, np.float32) @ ds.reshape(n, -1)
        return dtop, np.bincount(_BACK_AT, by_place * _CAUSAL.ravel(), LENGTH).astype(np.float32)

    # Rows of a model: one for each token, then the dense tables cut to the same width.

    @property
    def row_width(self) -> int:
        return 4 * self.width + self.mixes

    def rows(self) -> np.ndarray:
        t, w = self.tables, self.row_width
        dense = np.concatenate([t[n].ravel() for n in ("top", "distance")])
        dense = np.pad(dense, (0, -len(dense) % w)).reshape(-1, w)
        return np.concatenate([np.concatenate([t["now"], t["past"]], axis=1), dense])

    def take_rows(self, rows: np.ndarray) -> None:
        t, v, split = self.tables, self.vocabulary, 2 * self.width + self.mixes
        t["now"], t["past"] = np.ascontiguousarray(rows[:v, :split], np.float32), np.ascontiguousarray(rows[:v, split:], np.float32)
        dense, at = rows[v:].ravel(), 0
        for n in ("top", "distance"):
            size = t[n].size
            t[n] = dense[at : at + size].reshape(t[n].shape).astype(np.float32)
            at += size

    def row_uses(self, inputs: np.ndarray) -> np.ndarray:
        """How often each row takes part in the windows."""
        uses = np.bincount(inputs[inputs >= 0], minlength=self.vocabulary)
        return np.concatenate([uses, np.full(len(self.rows()) - self.vocabulary, len(inputs))])


class Reader:
    """A model that only reads: its tables are cut for the look-ups, and its buffers are used again."""

    def __init__(self, model: AttentionModel) -> None:
        d, k, f = model.width, model.mixes, np.float32
        now, past = model.tables["now"], model.tables["past"]
        self.mixes, self.width, self.emitted, self.top = k, d, model.emitted, model.tables["top"]
        self.query, self.state = np.ascontiguousarray(now[:, :d] * f(1 / np.sqrt(d))), np.ascontiguousarray(now[:, d:])
        # The last row is of what stands before a text or after it: its value and its share of the sum (the last column) are nil.
        self.key, self.value = np.zeros((len(past) + 1, d), f), np.zeros((len(past) + 1, d + 1), f)
        self.key[:-1], self.value[:-1, :d], self.value[:-1, d] = past[:, :d], past[:, d:], 1
        self.bias = np.where(_CAUSAL, model.tables["distance"][np.abs(_BACK)], -1e9).astype(f)
        self.ones = np.ones(k, f)
        # No exponent can pass 60 where these bounds don't.
        size = lambda t: float(np.sqrt((t * t).sum(axis=1).max()))
        self.low = size(self.query) * size(self.key) + float(self.bias.max()) < 59, float(self.state[:, d:].max() + np.abs(self.top).sum(axis=0).max()) < 59
        sizes = {"q": (_BATCH * STRIDE, d), "s": (_BATCH * STRIDE, d + k), "k": (_BATCH, LENGTH, d), "v": (_BATCH, LENGTH, d + 1), "a": (_BATCH, STRIDE, LENGTH), "o": (_BATCH, STRIDE, d + 1), "h": (_BATCH * STRIDE, d), "e": (_BATCH * STRIDE, k), "t": (_BATCH * STRIDE, k)}
        self.buffers = {name: np.empty(shape, f) for name, shape in sizes.items()}

    def weights(self, inputs: np.ndarray) -> np.ndarray:
        """The mixture weights of at most ``_BATCH`` windows, not yet divided by their sums; valid until the next call."""
        n, d, b = len(inputs), self.width, self.buffers
        now = inputs[:, _CONTEXT:].reshape(-1)
        q = self.query.take(now, axis=0, mode="clip", out=b["q"][: n * STRIDE]).reshape(n, STRIDE, d)
        s = self.state.take(now, axis=0, mode="clip", out=b["s"][: n * STRIDE])
        k = self.key.take(inputs, axis=0, mode="wrap", out=b["k"][:n])
        v = self.value.take(inputs, axis=0, mode="wrap", out=b["v"][:n])
        a = np.matmul(q, k.transpose(0, 2, 1), out=b["a"][:n])
        a += self.bias
        _exp(a, self.low[0])
        o = np.matmul(a, v, out=b["o"][:n]).reshape(-1, d + 1)
        h = np.divide(o[:, :d], np.maximum(o[:, d:], np.float32(1e-30)), out=b["h"][: n * STRIDE])
        h += s[:, :d]
        np.tanh(h, out=h)
        e = np.matmul(h, self.top, out=b["e"][: n * STRIDE])
        e += s[:, d:]
        _exp(e, self.low[1])
        return e

    def each_log10(self, inputs: np.ndarray, targets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the probability of every target, in the texts' order, and of any of ``starts`` there.

        ``starts`` has the summed output probabilities of those tokens (see ``mass``).
        """
        flat = targets.reshape(-1)
        p, start = np.empty((2, len(flat)), np.float32)
        both = np.stack([self.ones, starts.astype(np.float32)], axis=1)
        for at in range(0, len(inputs), _BATCH):
            own = slice(at * STRIDE, (at + _BATCH) * STRIDE)
            e = self.weights(inputs[at : at + _BATCH])
            sums = e @ both
            e *= self.emitted.take(flat[own], axis=0, mode="clip", out=self.buffers["t"][: len(e)])
            np.divide(e @ self.ones, sums[:, 0], out=p[own])
            np.divide(sums[:, 1], sums[:, 0], out=start[own])
        scored = flat >= 0
        return np.log10(np.maximum(p[scored], np.float32(1e-30))), np.log10(np.maximum(start[scored], np.float32(1e-30)))

    def tally(self, inputs: np.ndarray, targets: np.ndarray, total: np.ndarray) -> None:
        """Count every target in ``total`` for the output distribution that most likely emitted it."""
        flat = targets.reshape(-1)
        best = np.empty(len(flat), np.int64)
        for at in range(0, len(inputs), _BATCH):
            own = slice(at * STRIDE, (at + _BATCH) * STRIDE)
            e = self.weights(inputs[at : at + _BATCH])
            e *= self.emitted.take(flat[own], axis=0, mode="clip", out=self.buffers["t"][: len(e)])
            e.argmax(axis=1, out=best[own])
        best += flat.astype(np.int64) * self.mixes
        total += np.bincount(best[flat >= 0], minlength=total.size).reshape(total.shape)
