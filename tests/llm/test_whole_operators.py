"""Operators over cases that a cut of their input would miss."""

import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
from fixtures import prose
from marlstone.llm import decontaminate, lm_scoring
from marlstone.llm.attention import LENGTH, STRIDE, AttentionModel, Reader, windows
from marlstone.llm.labelled import fold
from pyspark.sql import functions as F
from test_exact import contamination


def test_one_word_items(spark):
    rows = [(1, "zebra here"), (2, "a zebra here"), (3, "here a zebra"), (4, "zebra"), (5, "two words zebra two words"), (6, "none")]
    items = [(1, "Zebra"), (2, "two words"), (3, "words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = decontaminate.benchmark_hits(docs, spark.createDataFrame(items, "item_id int, text string"))
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in out.collect()) == contamination(rows, items)


def _learner(spark):
    contents, end, begins = lm_scoring._vocabulary(lm_scoring.MODEL)
    return spark.sparkContext.broadcast(contents), end, begins


def test_words():
    texts = [None, "", " A  b\x0bC\x0c\td\r\n", "Ä\x1fB c", "\n", "c c", "\u00a0x"]
    words, at, sizes = lm_scoring.words_of(pa.array(texts))
    want = [(t or "").encode().lower().split() for t in texts]
    assert [words[k] for k in at] == [w for own in want for w in own] and sizes.tolist() == list(map(len, want))
    assert lm_scoring.words_of(pa.array([], pa.string()))[0] == []


def test_windows_come_from_every_training_text(spark):
    rows = [(k, prose(30, k)) for k in range(12)] + [(k, prose(12000, k)) for k in (50, 51, 52)] + [(60, None), (61, "z" * 5000), (None, prose(9, 3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    proto, end, _ = _learner(spark)
    got = lm_scoring.training_windows(docs, proto, end).collect()
    inputs, targets = lm_scoring._arrays([r.inputs for r in got], [r.targets for r in got])
    training = [r.text or "" for r in docs.where(fold(lm_scoring.FOLDS) != lm_scoring.HELD_OUT).collect()]
    context = LENGTH - STRIDE
    openings = inputs[inputs[:, context] == end]
    cut = lm_scoring.Pieces(proto.value)
    first = {tuple(windows(*cut.ids(*cut.numbers(pa.array([t]))), end)[0][0].tolist()) for t in training if " " in t or not t}
    assert first <= {tuple(r) for r in openings.tolist()}
    assert len(got) >= sum(max(1, len(t) // lm_scoring.SPACING) for t in training if " " in t or not t)
    assert ((inputs[:, context:] >= 0) == (targets >= 0)).all()
    wide = inputs[:, 1:][:, context:]  # the next input is the target
    both = (wide >= 0) & (targets[:, :-1] >= 0)
    assert (wide[both] == targets[:, :-1][both]).all()


def test_counts_and_distributions_learn_from_all_training_texts(spark):
    rows = [(k, prose(30, k)) for k in range(12)] + [(k, prose(12000, k)) for k in (50, 51, 52)] + [(60, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    proto, end, _ = _learner(spark)
    training = [r.text or "" for r in docs.where(fold(lm_scoring.FOLDS) != lm_scoring.HELD_OUT).collect()]
    counts = Counter(w.decode() for t in training for w in t.encode().lower().split())
    model = lm_scoring.trained(docs, proto, end, starters=100, rounds=1)
    before = model.emitted.copy()
    found = lm_scoring.learnt(docs, model, proto, end)
    assert {r[0]: r[1] for r in found.where("n is not null").groupBy("word").agg(F.sum("n")).collect()} == {**counts, None: len(training)}
    total = np.zeros((model.vocabulary, model.mixes))
    cut = lm_scoring.Pieces(proto.value)
    for t in training:
        inputs, targets, _ = windows(*cut.ids(*cut.numbers(pa.array([t]))), end)
        Reader(model).tally(inputs, targets, total)
    one = lm_scoring.settled(found, model).emitted.copy()
    model.settle(total)
    assert np.allclose(one, model.emitted, rtol=1e-3, atol=1e-9) and not np.allclose(one, before, rtol=1e-2)
    assert np.allclose(one.sum(axis=0, dtype=float), 1, atol=1e-5)


def test_held_out_texts_score_above_the_base(spark):
    """Texts with an order that word counts don't show."""
    rng = random.Random(5)
    chains = [f"w{k}lo mu{k}ra kest{k} ona{k}".split() for k in range(30)]
    rows = [(k, " ".join(w for _ in range(40) for w in rng.choice(chains))) for k in range(300)]
    out = lm_scoring.scored(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    held = [r for r in out if r.held_out]
    assert len(held) > 25 and np.mean([(r.score - r.base_score) / r.n_tokens for r in held]) > 0.3
    assert all(r.score < 0 for r in out)


def test_long_texts_and_words(spark, tmp_path):
    """A megabyte without spaces, and an address with 100,000 labels."""
    from marlstone.llm import pii, quality_ordinal, quality_rules, sentencepieces, sharding, simhash, substrings, toxicity

    rng = random.Random(9)
    blob = "".join(rng.choice("ABCDEFGHabcdefgh0123456789+/") for _ in range(1 << 20))
    rows = [(1, blob), (2, "x a@" + "b." * 100_000 + "com end"), (3, "one plain text"), (4, "a " * (1 << 19))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(1, "one plain text"), (2, blob[:1000])]
    bench = spark.createDataFrame(items, "item_id int, text string")
    labels = spark.createDataFrame([(1, 0, 1), (3, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    began = time.monotonic()
    assert [r.n_hit for r in decontaminate.benchmark_hits(docs, bench).orderBy("doc_id").collect()] == [r[2] for r in contamination(rows, items)]
    assert [r.n_tokens for r in lm_scoring.scored(docs).orderBy("doc_id").collect()] == [2, 4, 4, (1 << 19) + 1]
    assert [r.n_removed for r in substrings.without_repeats(docs).orderBy("doc_id").collect()] == [0, 0, 0, (1 << 19) - 1]
    pieces = {r.doc_id: r for r in sentencepieces.encoded(docs).collect()}
    assert all(r.round_trip and len(r.alternatives) == 3 for k, r in pieces.items() if k != 3)
    assert toxicity.scored(docs, labels).count() == 4 and quality_ordinal.graded(docs, labels).count() == 4
    assert simhash.near_duplicates(docs).count() == 4 and quality_rules.judged(docs).count() == 4
    made = {r.doc_id: r.text for r in pii.pseudonymised(docs, key="k").collect()}
    assert made[2].startswith("x u") and made[2].endswith("@pseudonym.invalid end") and len(made[1]) == len(blob)
    assert sum(r["size"] for r in sharding.kd_shards(docs).collect()) == sum(len(t) + 16 for _, t in rows)
    assert time.monotonic() - began < 240


def test_gradient_learns_from_every_position(spark):
    """A word that stands in the middle of its text, where no starting window is, moves its rows of the model."""
    middle = " ".join(["the cat sat"] * 60) + " zebra " + " ".join(["on the mat"] * 60)
    docs = spark.createDataFrame([(k, middle) for k in range(12)], "doc_id long, text string").repartition(2)
    proto, end, _ = _learner(spark)
    ids = lm_scoring.Pieces(proto.value).cut([b"zebra"])[0]
    new = AttentionModel(end + 1).tables["past"][ids]
    learnt = lm_scoring.trained(docs, proto, end, starters=100).tables["past"][ids]
    assert (np.abs(learnt - new).max(axis=1) > 1e-4).all()
