"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One score per text (hashed-text weights shared by all grades) is compared with ordered
thresholds: P(grade <= k) = logistic(threshold k - score). The expected grade ranks texts,
and the tail probability P(grade >= g) selects them.

Inputs, each hashed into ``2 ** BITS`` weights: a text's words with their share of the text,
and the binned statistics of quality_rules (how many symbols, repeats, capitals ... a word).

Scale: fitted on a bounded sample (``sample`` labelled rows; see labelled.py); whole texts are
scored where they lie.

Defined cases: a tail probability of exactly one half keeps; a null or empty text is scored by its statistics alone; without ratings all
grades are equally likely; a grade that isn't in the sample gets a small share; repeated
documents score alike; a very long text is scored whole; an empty table gives an empty result;
columns of the same names as the added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.labelled import fold, labelled_sample
from marlstone.llm.quality_rules import COUNTS, text_counts
from marlstone.llm.textmap import append_columns, mixed, span_hashes, text_bytes, word_spans

FOLDS, HELD_OUT = 5, 0
BITS = 18
SAMPLE = 8000
GRADES = 3
_CUTS = np.array([0.0, 0.005, 0.01, 0.02, 0.035, 0.05, 0.1, 0.15, 0.25, 0.4, 0.6, 0.9, 2, 4, 8, 16])


def rating(quality: Column, toxic: Column) -> Column:
    """Graded ratings from the labels: 0 poor, 1 good but toxic, 2 good."""
    return F.when(quality == 0, 0).when((quality == 1) & (toxic == 1), 1).when(quality == 1, 2)


def inputs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, weight number, value) of the inputs of each text."""
    data, off = text_bytes(texts)
    starts, ends, first = word_spans(data, off)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(len(texts)), n_words)
    mask = np.uint64((1 << BITS) - 1)
    where = (span_hashes(data, starts, ends) & mask).astype(np.int64)
    value = 1 / np.sqrt(np.maximum(1, n_words))[owner]
    counts = dict(zip(COUNTS, text_counts(texts), strict=True))
    who, what = [owner], [where]
    docs = np.arange(len(texts))
    sizes = np.digitize(counts["n_words"], [1, 10, 25, 50, 100, 200, 400, 1000, 4000, 20000])
    binned = [sizes]
    for top, bottom in (("word_chars", "n_words"), ("n_symbols", "n_words"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"), ("n_upper", "n_letters"), ("n_bang_words", "n_words"), ("n_stop_words", "n_words"), ("n_distinct", "n_words"), ("n_odd_words", "n_words")):
        binned.append(np.digitize(counts[top] / np.maximum(1, counts[bottom]), _CUTS))
    for k, b in enumerate(binned):
        who.append(docs)
        what.append((mixed((b + 1000 * (k + 1)).astype(np.uint64)) & mask).astype(np.int64))
    return np.concatenate(who), np.concatenate(what), np.concatenate([value, np.ones(len(docs) * len(binned))])


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def raw(self, texts: pa.Array) -> np.ndarray:
        who, what, value = inputs(texts)
        return np.bincount(who, self.weights[what] * value, minlength=len(texts))

    def grades(self, texts: pa.Array) -> np.ndarray:
        """P(grade) of each text, one column a grade."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - self.raw(texts)[:, None], -50, 50)))
        return np.diff(np.concatenate([np.zeros((len(below), 1)), below, np.ones((len(below), 1))], axis=1), axis=1)


def gradients(weights: np.ndarray, free: np.ndarray, batch: tuple[np.ndarray, np.ndarray, np.ndarray], target: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log likelihood of a batch, and its gradients by ``weights`` and by ``free``.

    The thresholds are free[0], then each one more by the exponential of the next of ``free``.
    """
    who, what, value = batch
    cuts = np.concatenate([[-np.inf], np.cumsum(np.concatenate([free[:1], np.exp(free[1:])])), [np.inf]])
    score = np.bincount(who, weights[what] * value, minlength=len(target))
    with np.errstate(over="ignore"):
        hi, lo = 1 / (1 + np.exp(-(cuts[target + 1] - score))), 1 / (1 + np.exp(-(cuts[target] - score)))
    p = np.maximum(hi - lo, 1e-9)
    d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
    by_text = (d_hi - d_lo) / len(target)
    by_weight = np.bincount(what, by_text[who] * value, minlength=len(weights))
    by_cut = np.array([(-d_hi[target == j].sum() + d_lo[target == j + 1].sum()) / len(target) for j in range(len(free))])
    by_free = np.array([by_cut.sum(), *[by_cut[j:].sum() * np.exp(free[j]) for j in range(1, len(free))]])
    return float(-np.log(p).mean()), by_weight, by_free


def fit(sample: list[tuple[str, int]], grades: int = GRADES, rounds: int = 12, rate: float = 0.1, decay: float = 1e-5) -> Ordinal:
    """Adagrad on the negative log likelihood, in small batches of a fixed order."""
    y = np.array([g for _, g in sample], int)
    share = np.bincount(y, minlength=grades)[:grades] + 0.5
    start = np.cumsum(share)[:-1] / share.sum()
    base = np.log(start / (1 - start))
    weights, squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-4)
    free = np.concatenate([base[:1], np.log(np.maximum(1e-3, np.diff(base)))])
    free_squares = np.full(len(free), 1e-2)
    rng = np.random.default_rng(10)
    order, batches = rng.permutation(len(sample)), []
    for a in range(0, len(sample), 64):
        own = order[a : a + 64]
        batches.append((inputs(pa.array([sample[k][0] for k in own], pa.string())), y[own]))
    for _ in range(rounds if len(set(y.tolist())) > 1 else 0):
        for k in rng.permutation(len(batches)):
            batch, target = batches[k]
            _, by_weight, by_free = gradients(weights, free, batch, target)
            used = np.unique(batch[1])
            g = by_weight[used] + decay * weights[used]
            squares[used] += g * g
            weights[used] -= rate * g / np.sqrt(squares[used])
            free_squares += by_free**2
            free = free - 0.05 * by_free / np.sqrt(free_squares)
    return Ordinal(weights, np.cumsum(np.concatenate([free[:1], np.exp(free[1:])])))


def graded(docs: DataFrame, labels: DataFrame, least_grade: int = 1, least: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with held_out, expected_grade, tail_probability (of ``least_grade`` or more) and kept."""
    rows = labelled_sample(docs, labels, rating(F.col("quality"), F.col("toxic")), FOLDS, HELD_OUT, sample)
    model = docs.sparkSession.sparkContext.broadcast(fit(rows))

    def make():
        own = model.value

        def run(texts: pa.Array) -> list:
            p = own.grades(texts)
            return [p @ np.arange(p.shape[1]), p[:, least_grade:].sum(axis=1)]

        return run

    out = append_columns(docs, "text", [T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_probability", T.DoubleType())], make)
    return out.withColumn("held_out", fold(FOLDS) == HELD_OUT).withColumn("kept", F.col("tail_probability") >= least)
