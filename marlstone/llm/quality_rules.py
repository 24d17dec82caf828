"""Quality rules by weak supervision.

Each rule looks at one statistic of a text and votes good, bad, or abstains. How far each
rule can be trusted is not given but learned: expectation-maximisation over the vote
patterns of all documents estimates, for each rule, how often it votes each way on good and
on bad texts, and the posterior probability of quality decides instead of "all must pass".

Scale: statistics are computed where the documents lie. What reaches the driver is the count
of each vote pattern, at most 3 ** (number of rules) rows at any corpus size; the posterior
of each pattern goes back as a table of the same bound.

Defined cases: a null or empty text has no words and fails the base rules; repeated documents
are judged each for itself; an empty table gives an empty result; an added column replaces
one of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.store import stored
from marlstone.llm.textmap import append_columns, mixed, span_hashes, text_bytes, word_spans

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_bang_words", "n_stop_words", "n_distinct", "n_odd_words")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = True
_ALNUM = _LETTER.copy()
_ALNUM[0x30:0x3A] = True
_ALNUM[0x80:] = True


def _sums(flags: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[hi] - total[lo]


def _repeated(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: whether its (group, value) occurs again, and whether it occurred before."""
    again, before = np.zeros(len(value), bool), np.zeros(len(value), bool)
    if len(value):
        order = np.lexsort((value, group))
        g, v = group[order], value[order]
        same = (g[1:] == g[:-1]) & (v[1:] == v[:-1])
        again[order[1:]] |= same
        again[order[:-1]] |= same
        before[order[1:]] = same
    return again, before


def text_counts(texts: pa.Array) -> list[np.ndarray]:
    """The statistics named in ``COUNTS`` of each text, from one pass over its bytes."""
    data, off = text_bytes(texts)
    docs = len(off) - 1
    starts, ends, first = word_spans(data, off)
    lo, hi = first[:-1], first[1:]
    n_words = hi - lo
    owner = np.repeat(np.arange(docs), n_words)
    hashes = span_hashes(data, starts, ends)

    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    word_chars = _sums(chars[ends] - chars[starts], lo, hi)

    covered = np.zeros(len(starts), bool)
    if len(starts) >= 3:
        three = mixed(hashes[:-2] * np.uint64(3) + mixed(hashes[1:-1] * np.uint64(5) + mixed(hashes[2:])))
        inside = owner[:-2] == owner[2:]
        again = np.zeros(len(three), bool)
        again[inside], _ = _repeated(owner[:-2][inside], three[inside])
        for k in range(3):
            covered[k : k + len(again)] |= again

    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.sort(np.concatenate([off[:-1], breaks + 1]))
    line_owner = np.repeat(np.arange(docs), 1 + np.searchsorted(breaks, off[1:]) - np.searchsorted(breaks, off[:-1]))
    line_ends = np.append(line_starts[1:] - 1, off[-1]) if docs else line_starts
    last = np.append(np.flatnonzero(np.diff(line_owner)), len(line_owner) - 1) if docs else np.zeros(0, int)
    line_ends[last] = off[1:]
    has_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    of, at, to = line_owner[has_word], line_starts[has_word], line_ends[has_word]
    _, before = _repeated(of, span_hashes(data, at, to))

    last_byte = data[ends - 1] if len(ends) else data[:0]
    _, seen = _repeated(owner, hashes)
    odd = ~_ALNUM[data[starts]] | _SYMBOL[last_byte]
    return [
        n_words,
        word_chars,
        _sums(_SYMBOL[data], off[:-1], off[1:]),
        np.bincount(of[before], minlength=docs),
        _sums(covered, lo, hi),
        np.bincount(of, minlength=docs),
        _sums(_UPPER[data], off[:-1], off[1:]),
        _sums(_LETTER[data], off[:-1], off[1:]),
        _sums(last_byte == 0x21, lo, hi),
        _sums((last_byte == 0x2E) | (last_byte == 0x3F), lo, hi),
        n_words - _sums(seen, lo, hi),
        _sums(odd, lo, hi),
    ]


def with_counts(docs: DataFrame) -> DataFrame:
    return append_columns(docs, "text", [T.StructField(n, T.LongType()) for n in COUNTS], lambda: text_counts)


def _ratio(top: str, bottom: str) -> Column:
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom))


def default_rules() -> dict[str, Column]:
    """name -> vote: 1 good, -1 bad, 0 abstains (also where the statistic doesn't exist)."""

    def vote(value: Column, good: Column, bad: Column) -> Column:
        return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)

    length, symbols, marks = _ratio("word_chars", "n_words"), _ratio("n_symbols", "n_words"), _ratio("n_symbols", "word_chars")
    odd, lines, repeats = _ratio("n_odd_words", "n_words"), _ratio("n_dup_lines", "n_lines"), _ratio("n_repeat_words", "n_words")
    upper, bangs, stops, distinct = _ratio("n_upper", "n_letters"), _ratio("n_bang_words", "n_words"), _ratio("n_stop_words", "n_words"), _ratio("n_distinct", "n_words")
    return {
        "word_length": vote(length, length.between(4, 8), (length < 2.5) | (length > 14)),
        "symbols": vote(symbols, symbols < 0.05, symbols > 0.1),
        "symbol_share": vote(marks, marks < 0.01, marks > 0.02),
        "odd_words": vote(odd, odd < 0.05, odd > 0.1),
        "sentence_ends": vote(stops, stops.between(0.03, 0.3), stops < 0.02),
        "capitals": vote(upper, upper < 0.2, upper > 0.35),
        "exclamations": vote(bangs, bangs < 0.05, bangs > 0.1),
        "repeated_lines": vote(lines, lines < 0.1, lines > 0.25),
        "repeated_words": vote(repeats, repeats < 0.1, repeats > 0.25),
        "distinct_words": vote(distinct, distinct > 0.35, distinct < 0.2),
    }


def fit_votes(patterns: Mapping[tuple[int, ...], int], rounds: int = 200, smoothing: float = 1.0) -> tuple[float, np.ndarray]:
    """Prior of quality and P(vote | class) as an array (class, rule, vote + 1), by EM.

    Class 1 is quality: at the start its probability is 0.95 without a bad vote and 0.45 less for
    each one (within 0.02 and 0.98); each rule's rates are smoothed, so the result is the same for
    the same counts.
    """
    votes = np.array(sorted(patterns), int)
    if not len(votes):
        return 0.5, np.zeros((2, 0, 3))
    weight = np.array([patterns[tuple(int(x) for x in v)] for v in votes], float)
    onehot = np.stack([votes == k for k in (-1, 0, 1)], axis=2).astype(float)
    bad = (votes < 0).sum(axis=1)
    post = np.clip(0.95 - 0.45 * bad, 0.02, 0.98)
    for _ in range(rounds):
        both = np.stack([weight * (1 - post), weight * post])
        rates = np.einsum("cn,nrk->crk", both, onehot) + smoothing
        rates /= rates.sum(axis=2, keepdims=True)
        prior = (both[1].sum() + smoothing) / (weight.sum() + 2 * smoothing)
        new = posterior(votes, prior, rates)
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return float(prior), rates


def posterior(votes: np.ndarray, prior: float, rates: np.ndarray) -> np.ndarray:
    logs = np.log(rates)
    rule = np.arange(votes.shape[1])
    odds = math.log(prior / (1 - prior)) + (logs[1, rule, votes + 1] - logs[0, rule, votes + 1]).sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def judged(docs: DataFrame, rules: Mapping[str, Column] | None = None, least: float = 0.5) -> DataFrame:
    """``docs`` (text replaced by its statistics) with quality (posterior), base_failed and kept."""
    rules = dict(default_rules() if rules is None else rules)
    spark = docs.sparkSession
    counted = stored(with_counts(docs).drop("text"), "quality-counts")
    code = sum(((v + 1) * 3**k for k, v in enumerate(rules.values())), F.lit(0))
    voted = counted.withColumn("votes", code.cast("int"))
    rows = voted.groupBy("votes").count().collect()  # 3 ** rules rows at most
    unpack = lambda c: tuple(c // 3**k % 3 - 1 for k in range(len(rules)))
    patterns = {unpack(r["votes"]): r["count"] for r in rows}
    prior, rates = fit_votes(patterns)
    known = sorted(patterns)
    quality = posterior(np.array(known, int), prior, rates) if known else []
    table = spark.createDataFrame([(sum((v + 1) * 3**k for k, v in enumerate(p)), float(q)) for p, q in zip(known, quality)], "votes int, quality double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        voted.drop("quality")
        .join(F.broadcast(table), "votes", "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    )
