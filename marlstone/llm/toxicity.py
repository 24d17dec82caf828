"""Toxicity by a factorization machine over hashed terms.

Terms are the lower-cased words of a text and the words' beginnings of 4, 5 and 6 bytes
(insults are inflected), each hashed to 64 bits. Those whose presence depends on the label
beyond chance (chi square, at most ``features`` of them) are the machine's inputs: a bias, a
linear weight each, and a vector of ``factors`` each whose products are the weights of pairs,
so two harmless terms can be harmful together and an insult can be quoted without harm. The
screen looks at single terms: a pair of which both terms say nothing alone isn't found.

Scale: the machine is fitted on a bounded sample (``sample`` labelled rows; see labelled.py)
and scores whole texts where they lie.

Defined cases: a score of exactly one half is predicted as 1; a null or empty text gets the bias
alone; a very long text is scored whole; without labels of both classes the
score is the share of label 1 in the sample (one half of a pseudo-count added); repeated
documents score alike; an empty table gives an empty result; columns of the same names as the
added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.labelled import fold, labelled_sample
from marlstone.llm.textmap import append_columns, span_hashes, text_bytes

FOLDS, HELD_OUT = 5, 0
PREFIXES = (4, 5, 6)
SAMPLE = 8000

_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[0x41:0x5B] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x61:0x7B] = True
_IN_WORD[0x80:] = True


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, term hash) of every term occurrence."""
    data, off = text_bytes(texts)
    data = _FOLDED[data]
    word = _IN_WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], word.view(np.int8), [0]])))
    starts, ends = edge[::2], edge[1::2]
    inner = off[1:-1]
    cut = inner[(inner > 0) & (inner < len(data))]
    cut = cut[word[cut] & word[cut - 1]] if len(cut) else cut  # two texts whose words touch
    starts, ends = np.unique(np.concatenate([starts, cut])), np.unique(np.concatenate([ends, cut]))
    owner = np.searchsorted(off, starts, "right") - 1
    who, what = [owner], [span_hashes(data, starts, ends)]
    for k in PREFIXES:
        longer = ends - starts > k
        who.append(owner[longer])
        what.append(span_hashes(data, starts[longer], starts[longer] + k))
    return np.concatenate(who), np.concatenate(what)


@dataclass
class Machine:
    """A fitted factorization machine; ``terms`` are sorted."""

    terms: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def inputs(self, texts: pa.Array) -> np.ndarray:
        """Presence of each input term in each text."""
        x = np.zeros((len(texts), len(self.terms)), np.float32)
        if len(self.terms):
            who, what = terms(texts)
            small = np.zeros(1 << 16, bool)
            small[self.terms & np.uint64(0xFFFF)] = True
            maybe = small[what & np.uint64(0xFFFF)]
            who, what = who[maybe], what[maybe]
            at = np.minimum(np.searchsorted(self.terms, what), len(self.terms) - 1)
            hit = self.terms[at] == what
            x[who[hit], at[hit]] = 1
        return x

    def logits(self, x: np.ndarray) -> np.ndarray:
        s = x @ self.factors
        return self.bias + x @ self.linear + 0.5 * ((s * s).sum(axis=1) - x @ (self.factors**2).sum(axis=1))

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(self.inputs(texts)).astype(float), -50, 50)))


def _informative(sample: list[tuple[str, int]], features: int, least_chi: float = 25.0) -> np.ndarray:
    """Sorted hashes of the terms whose presence depends most on the label."""
    counts = {}
    for label in (0, 1):
        texts = [t for t, y in sample if y == label]
        seen: list[np.ndarray] = []
        for at in range(0, len(texts), 200):
            who, what = terms(pa.array(texts[at : at + 200], pa.string()))
            order = np.lexsort((what, who))
            who, what = who[order], what[order]
            new = np.concatenate([[True], (who[1:] != who[:-1]) | (what[1:] != what[:-1])]) if len(what) else np.zeros(0, bool)
            seen.append(what[new])
        counts[label] = np.unique(np.concatenate(seen) if seen else np.zeros(0, np.uint64), return_counts=True), len(texts)
    (h0, c0), n0 = counts[0]
    (h1, c1), n1 = counts[1]
    every = np.union1d(h0, h1)
    a = np.zeros(len(every))
    b = np.zeros(len(every))
    a[np.searchsorted(every, h1)] = c1
    b[np.searchsorted(every, h0)] = c0
    n, df = n0 + n1, a + b
    chi = n * (a * n0 - b * n1) ** 2 / np.maximum(1, n1 * n0 * df * (n - df))
    good = np.flatnonzero((chi >= least_chi) & (df >= 4))
    return np.sort(every[good[np.argsort(-chi[good], kind="stable")][:features]])


def fit(sample: list[tuple[str, int]], features: int = 512, factors: int = 4, rounds: int = 300, decay: float = 2e-4) -> Machine:
    """Logistic loss, Adam over the whole sample; the same sample gives the same machine."""
    y = np.array([v for _, v in sample], np.float32)
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Machine(np.zeros(0, np.uint64), base, np.zeros(0, np.float32), np.zeros((0, factors), np.float32))
    chosen = _informative(sample, features)
    rng = np.random.default_rng(5)
    m = Machine(chosen, base, np.zeros(len(chosen), np.float32), (0.05 * rng.standard_normal((len(chosen), factors))).astype(np.float32))
    x = np.concatenate([m.inputs(pa.array([t for t, _ in sample[at : at + 200]], pa.string())) for at in range(0, len(sample), 200)])
    params = [np.array([m.bias], np.float32), m.linear, m.factors]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, rounds + 1):
        m.bias, m.linear, m.factors = float(params[0][0]), params[1], params[2]
        error = (1 / (1 + np.exp(-np.clip(m.logits(x), -50, 50))) - y).astype(np.float32) / len(y)
        s = x @ m.factors
        grads = [
            np.array([error.sum()], np.float32),
            x.T @ error + decay * m.linear,
            x.T @ (error[:, None] * s) - (x.T @ error)[:, None] * m.factors + decay * m.factors,
        ]
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            params[k] = params[k] - 0.1 * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    m.bias, m.linear, m.factors = float(params[0][0]), params[1], params[2]
    return m


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with held_out, score (of being toxic) and predicted."""
    rows = labelled_sample(docs, labels, F.col("toxic"), FOLDS, HELD_OUT, sample)
    machine = docs.sparkSession.sparkContext.broadcast(fit(rows))

    def make():
        own = machine.value
        return lambda texts: [own.scores(texts)]

    out = append_columns(docs, "text", [T.StructField("score", T.DoubleType())], make)
    return out.withColumn("held_out", fold(FOLDS) == HELD_OUT).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that the machine doesn't reject, with their own columns in their order."""
    packed = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    return scored(packed, labels, sample).where("predicted = 0").select("_row.*")
