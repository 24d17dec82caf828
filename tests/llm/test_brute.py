"""Methods against explicit sums, numeric derivatives and exhaustive search."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from fixtures import documents, prose
from marlstone.llm import pii, quality_ordinal, quality_rules, sharding, toxicity
from marlstone.llm.labelled import labelled_sample
from pyspark.sql import functions as F


def test_machine_is_the_explicit_sum_over_pairs():
    rng = np.random.default_rng(4)
    n = 12
    m = toxicity.Machine(np.arange(n, dtype=np.uint64), 0.3, rng.standard_normal(n).astype(np.float32), rng.standard_normal((n, 4)).astype(np.float32))
    x = (rng.random((20, n)) < 0.4).astype(np.float32)
    want = [0.3 + sum(m.linear[i] * r[i] for i in range(n)) + sum(m.factors[i] @ m.factors[j] * r[i] * r[j] for i in range(n) for j in range(i + 1, n)) for r in x]
    assert np.allclose(m.logits(x), want, atol=1e-4)


def test_terms_are_words_and_their_beginnings():
    who, what = toxicity.terms(pa.array(["Blockhead ab, x", "", "éclair blocks"]))
    got = set(zip(who.tolist(), what.tolist()))
    one = lambda t: int(toxicity.terms(pa.array([t]))[1][0])
    assert {(0, one("blockhead")), (0, one("bloc")), (0, one("block")), (0, one("blockh")), (0, one("ab")), (0, one("x")), (2, one("éclair")), (2, one("block"))} <= got and len(got) == 13


def test_ordinal_gradient():
    rng = np.random.default_rng(3)
    weights, free = rng.standard_normal(7), np.array([-0.4, 0.2, -0.3])
    batch = (np.repeat(np.arange(30), 3), rng.integers(0, 7, 90), rng.random(90))
    target = rng.integers(0, 4, 30)
    loss, by_weight, by_free = quality_ordinal.gradients(weights, free, batch, target)
    cuts = np.cumsum([free[0], *np.exp(free[1:])])
    score = np.bincount(batch[0], weights[batch[1]] * batch[2], minlength=30)
    below = np.concatenate([np.zeros((30, 1)), 1 / (1 + np.exp(score[:, None] - cuts)), np.ones((30, 1))], axis=1)
    assert abs(loss + np.log(np.diff(below, axis=1)[np.arange(30), target]).mean()) < 1e-9
    for values, grad, at in ((weights, by_weight, 0), (free, by_free, 1)):
        for k in range(len(values)):
            up, down = values.copy(), values.copy()
            up[k] += 1e-5
            down[k] -= 1e-5
            a, b = (quality_ordinal.gradients(*((v, free) if at == 0 else (weights, v)), batch, target)[0] for v in (up, down))
            assert abs((a - b) / 2e-5 - grad[k]) < 1e-5


def test_quality_posterior_is_bayes(docs):
    rules = quality_rules.default_rules()
    own = quality_rules.with_counts(docs)
    votes = [tuple(r) for r in own.select(*[v.alias(k) for k, v in rules.items()]).collect()]
    prior, rates = quality_rules.fit_votes({v: votes.count(v) for v in votes})
    want = []
    for v in votes:
        good, bad = prior, 1 - prior
        for k, x in enumerate(v):
            good, bad = good * rates[1, k, x + 1], bad * rates[0, k, x + 1]
        want.append(good / (good + bad))
    assert np.allclose(sorted(r.quality for r in quality_rules.judged(docs).collect()), sorted(want), atol=1e-9)
    assert np.allclose(rates.sum(axis=2), 1)


def feistel(left, right, a, b, tweak, key):
    """The permutation again, in Python."""
    for i in range(8):
        h = lambda side: int(hashlib.sha256("|".join([key, tweak, str(i), str(side)]).encode()).hexdigest()[:14], 16)
        if i % 2 == 0:
            left = (left + h(right) % a) % a
        else:
            right = (right + h(left) % b) % b
    return left, right


def test_pseudonyms_against_python(spark):
    rng = random.Random(6)

    def luhn(d):
        return sum(v - 9 * (v > 9) for v in (int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))))

    def card(d):
        inner = d[1:-1]
        half = len(inner) // 2
        l, r = feistel(int(inner[:half]), int(inner[half:]), 10**half, 10 ** (len(inner) - half), f"card:{len(inner)}", "k")
        body = d[0] + f"{l:0{half}d}" + f"{r:0{len(inner) - half}d}"
        return body + str(-luhn(body + "0") % 10)

    values = []
    while len(values) < 40:
        d = "".join(rng.choice("0123456789") for _ in range(rng.choice([13, 15, 16, 19])))
        values.append(d)
    ips = [".".join(str(rng.randrange(300)) for _ in range(4)) for _ in range(30)]

    def ip(t):
        o = [int(x) for x in t.split(".")]
        if max(o) > 255:
            return t
        l, r = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ipv4", "k")
        return f"{l // 256}.{l % 256}.{r // 256}.{r % 256}"

    rows = [(f"n {v} m",) for v in values] + [(f"at {t}",) for t in ips]
    want = [f"n {card(v) if luhn(v) % 10 == 0 else v} m" for v in values] + [f"at {ip(t)}" for t in ips]
    got = [r.text for r in pii.pseudonymised(spark.createDataFrame(rows, "text string"), key="k").collect()]
    assert sorted(got) == sorted(want) and sum(a != b[0] for a, b in zip(want, rows)) > 10


def test_patterns_against_python(spark):
    """What the whole expression finds, by Python's expressions over made-up neighbourhoods."""
    import regex

    rng = random.Random(8)
    parts = ["a@b.com", "x.y+z@mail-1.example.org.", "4111111111111111", "4111 1111 1111 1111", "1999-12-31", "31.12.1999", "12/25/2020", "123-45-6789", "10.0.0.1", "+1 (017) 555-7713", "017-555-7713", "GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00", "0f3ef4d6b2755a36d7d9c25bd72c4d5f", "7", "@", ".", "-", "v1", "é9"]
    texts = [rng.choice(["", " ", ",", "/"]).join(rng.choice(parts) for _ in range(rng.randrange(1, 6))) for _ in range(400)]
    found = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", F.regexp_extract_all("t", F.lit(pii.ANY), F.lit(0)).alias("f"))
    assert {r.k: r.f for r in found.collect()} == {k: [m[0] for m in regex.finditer(pii.ANY, t)] for k, t in enumerate(texts)}


def test_session_key(spark):
    df = spark.createDataFrame([("4111111111111111",)], "text string")
    one = lambda **k: pii.pseudonymised(df, **k).first().text
    assert one() == one() != "4111111111111111"
    spark.conf.set(pii.KEY_SETTING, "k")
    try:
        assert one() == one(key="k")
    finally:
        spark.conf.unset(pii.KEY_SETTING)


@pytest.mark.parametrize("seed", range(3))
def test_tree_cuts_at_weighted_medians(spark, seed):
    rng = random.Random(seed)
    atoms = [(rng.randrange(40) if seed else 5, rng.randrange(3), rng.randrange(1 << 60), rng.randrange(1, 50)) for _ in range(120)]
    atoms = sorted({a[:3]: a for a in atoms}.values())
    df = spark.createDataFrame(atoms, "d0 long, d1 long, tie long, bytes long")
    tree = sharding.build_tree(df, 2, 5, tolerance=0.0)
    spans = [max(1, max(a[k] for a in atoms) - min(a[k] for a in atoms)) for k in range(2)]

    def check(node, own):
        if node.count == 1:
            assert node.left is None
            return
        wide = [(max(a[k] for a in own) - min(a[k] for a in own)) / spans[k] for k in range(2)]
        assert node.dim == wide.index(max(wide))
        own = sorted(own, key=lambda a: (a[node.dim], a[2]))
        goal = sum(a[3] for a in own) * (node.count // 2) / node.count
        left = [a for a in own if (a[node.dim], a[2]) < (node.value, node.tie)]
        assert own[: len(left)] == left
        sums = np.cumsum([0] + [a[3] for a in own])
        assert abs(sums[len(left)] - goal) <= np.abs(sums - goal).min() + 1e-9
        check(node.left, left)
        check(node.right, own[len(left) :])

    check(tree, atoms)


def test_labelled_sample_is_bounded(spark):
    rows = [(k, prose(50, k)) for k in range(60)] + [(3, "other"), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(70)] + [(4, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    take = lambda **k: labelled_sample(docs, labels, F.col("toxic"), 5, 0, **{"most": 1000, **k})
    every = take()
    size = len(every)
    assert 40 < size < 60 and every == labelled_sample(docs.repartition(7), labels.repartition(5), F.col("toxic"), 5, 0, 1000)
    assert len(take(most=10)) <= 10
    few = take(most_bytes=2000)
    assert 1 <= len(few) < size and sum(len(t) for t, _ in few) <= 2000 and set(few) <= set(every)


def test_long_words_in_patterns():
    assert re.fullmatch(r".*\)\*\+", pii.EMAIL)  # the labels of an address match without recursion


def test_documents_have_the_awkward_cases():
    texts = [r[1] for r in documents()]
    assert None in texts and "" in texts and len(texts) > len(set(texts))
