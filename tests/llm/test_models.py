"""Learned operators: held-out accuracy, probabilities, and exact search."""

import math
import random
import zlib
from collections import Counter

import numpy as np
from fixtures import documents, prose
from marlstone.llm import lm_scoring, quality_ordinal, sentencepieces, toxicity
from marlstone.llm.attention import LENGTH, STRIDE, AttentionModel, Reader, windows
from pyspark.sql import functions as F


def labelled(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(900):
        text = prose(rng.randrange(5, 120), 1000 + i)
        toxic = int(rng.random() < 0.25)
        if toxic:
            words = text.split()
            words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "Nitwits", "nitwit!"]))
            text = " ".join(words)
        quality = int(rng.random() < 0.7)
        if not quality:
            text = " ".join(w + rng.choice(["###", "%%%"]) for w in text.split())
        docs.append((i, text, "en", "s", 0))
        labels.append((i, quality, toxic))
    return spark.createDataFrame(docs + documents(), "doc_id long, text string, lang string, source string, n_chars int"), spark.createDataFrame(labels[:800] + [(None, 1, 1), (5000, None, None)], "doc_id long, quality int, toxic int"), {i: (q, t) for i, q, t in labels}


def test_toxicity(spark, no_docs):
    docs, labels, truth = labelled(spark)
    rows = toxicity.scored(docs.withColumn("score", F.lit("clash")), labels).collect()
    held = [r for r in rows if r.doc_id in truth and r.held_out and r.n_chars == 0 and r.source == "s"]
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert len(rows) == docs.count() and np.mean([r.predicted == truth[r.doc_id][1] for r in held]) > 0.97
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in rows)
    none = toxicity.scored(docs, labels.limit(0)).select("score").distinct().collect()
    assert len(none) == 1 and toxicity.scored(no_docs, labels).count() == 0


def test_pairs_matter():
    rows = []
    rng = random.Random(2)
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((" ".join(["filler"] * 3 + ["alphas"] * a + ["betass"] * b), int(a and b)))
    rows = sorted(rows)
    m = toxicity.fit(rows)
    import pyarrow as pa

    got = m.scores(pa.array(["alphas", "betass", "alphas betass", ""]))
    assert got[2] > 0.5 > max(got[0], got[1], got[3])


def test_ordinal(spark, no_docs):
    docs, labels, truth = labelled(spark)
    rows = quality_ordinal.graded(docs, labels).collect()
    held = [r for r in rows if r.doc_id in truth and r.held_out and r.source == "s"]
    assert len(rows) == docs.count() and np.mean([r.kept == bool(truth[r.doc_id][0]) for r in held]) > 0.9
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in rows)
    assert quality_ordinal.graded(no_docs, labels.limit(0)).count() == 0
    m = quality_ordinal.fit([("good text here", 2), ("bad### text###", 0), ("mid text", 1)] * 30)
    assert m.thresholds[0] < m.thresholds[1]


def test_windows_score_each_token_once():
    seqs = [np.arange(1, n + 1) for n in (0, 1, 15, 16, 17, 50, 100)]
    inputs, targets, owner = windows(np.concatenate(seqs), [len(x) for x in seqs], 0)
    assert inputs.shape[1] == LENGTH and targets.shape[1] == STRIDE
    for k, s in enumerate(seqs):
        own = targets[owner == k].ravel()
        assert own[own >= 0].tolist() == [*s, 0]
        rows = inputs[owner == k]
        full = [0, *s]
        for w, row in enumerate(rows):
            at = np.arange(w * STRIDE + STRIDE - LENGTH, (w + 1) * STRIDE)
            assert row.tolist() == [full[p] if 0 <= p < len(full) else -1 for p in at]


def test_attention_probabilities():
    rng = np.random.default_rng(0)
    seqs = [np.array([1, 2, 3, 4] * 6 if rng.random() < 0.5 else [5, 6, 7, 8] * 6) for _ in range(200)]
    m = AttentionModel(9, mixes=8)
    pack = lambda seqs: (np.concatenate(seqs), [len(x) for x in seqs], 0)
    i, t, _ = windows(*pack(seqs))
    m.learn(i, t, m.begin(t), 160, batch=64)
    total = np.zeros((9, 8))
    m.gather(i, t, total)
    m.settle(total)
    assert np.allclose(m.emitted.sum(axis=0), 1, atol=1e-4)
    i, t, _ = windows(*pack(seqs[:20]))
    logs, start = Reader(m).each_log10(i, t, m.mass(np.ones(9, bool)))
    assert np.allclose(start, 0, atol=1e-4) and logs.mean() > -0.35
    pi = m.probabilities(i)
    p = (pi * m.emitted[np.maximum(t.ravel(), 0)]).sum(axis=1)[t.ravel() >= 0]
    assert np.allclose(logs, np.log10(p), atol=1e-4)
    counted = np.zeros((9, 8))
    Reader(m).tally(i, t, counted)
    best = (pi * m.emitted[np.maximum(t.ravel(), 0)]).argmax(axis=1)
    assert (counted == np.histogram2d(t.ravel()[t.ravel() >= 0], best[t.ravel() >= 0], (range(10), range(9)))[0]).all()
    i = i[i[:, -1] >= 0]
    late = i.copy()
    late[:, -1] = 3  # what comes later doesn't change what came before
    before = m.probabilities(i).reshape(len(i), STRIDE, -1)[:, :-1]
    assert np.allclose(before, m.probabilities(late).reshape(len(i), STRIDE, -1)[:, :-1], atol=1e-5)


def test_lm_scoring(spark, docs, no_docs):
    rows = lm_scoring.scored(docs, frequent=50).collect()
    own = documents()
    counts, ends = Counter(), 0
    for d, t, *_ in own:
        if zlib.crc32(str("" if d is None else d).encode()) % 7 != 2:
            counts.update((t or "").encode().lower().split())
            ends += 1
    total, low = sum(counts.values()) + ends, math.log10(sum(counts.values()) + ends + len(counts) + 2)
    want = sorted((str(d), len(w := (t or "").encode().lower().split()) + 1, sum(counts[x] > 0 for x in w) + 1, round(sum(math.log10(counts[x] + 1) - low for x in w) + math.log10(ends + 1) - low, 5)) for d, t, *_ in own)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 5)) for r in rows) == want
    assert all(r.train_tokens == total and r.score < 0 and math.isfinite(r.score) for r in rows)
    whole = {(str(r.doc_id), r.n_tokens, round(r.score, 3)) for r in lm_scoring.scored(docs).collect()}  # all words frequent
    assert {(str(r.doc_id), r.n_tokens, round(r.score, 3)) for r in rows} == whole
    assert lm_scoring.scored(no_docs).count() == 0


def test_sentencepiece_nbest():
    v = sentencepieces.load_vocabulary()

    def every(data, at=0):
        if at == len(data):
            yield 0.0, ()
            return
        end = at + 1
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        for j in range(end, len(data) + 1):
            if data[at:j] in v.pieces:
                i, s = v.pieces[data[at:j]]
                for s2, rest in every(data, j):
                    yield s + s2, (i, *rest)
        if data[at:end] not in v.pieces:
            for s2, rest in every(data, end):
                yield v.spelled + s2, (*[v.byte_ids[b] for b in data[at:end]], *rest)

    unit = sentencepieces.UNIT
    for text in ("the cat", "the the", "aé ▁b", "thon erth", "a\nb c", "  x", "ñ 世\U0001f600", "x" * 9):
        best = sorted(every((" " + text).encode()), key=lambda x: -x[0])
        chunk = (" " + text).encode()
        apart = sentencepieces.nbest(chunk, v, 5)
        assert [s for s, _ in apart] == [s for s, _ in best[:5]] and set(apart) <= set(best) and len(set(apart)) == len(apart)
        assert sentencepieces.best_of_chunks([chunk], v)[2].tolist() == list(apart[0][1])
        ids, score, more = sentencepieces.encode_batch([text], v, 5)[0]
        got = [(score, tuple(ids.tolist()))]
        for alt in more:
            own = ids.tolist()
            for e in sorted(alt["edits"], key=lambda e: -e["at"]):
                own[e["at"] : e["at"] + e["drop"]] = e["ids"]
            got.append((alt["score"], tuple(own)))
        best = [(s / unit, p) for s, p in best]
        assert [s for s, _ in got] == [s for s, _ in best[:5]]
        assert set(got) <= set(best) and len({p for _, p in got}) == len(got)
        assert all(sentencepieces.decode(p, v) == text for _, p in got)


def test_no_more_pieces_than_the_merges_give():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    v = sentencepieces.load_vocabulary()
    assert abs(sum(math.exp(s / sentencepieces.UNIT) for _, s in v.pieces.values()) - 1) < 1e-3
    plain = [
        "the old river mountain grew quietly under snow", "international tokenization", "It was the best of times, it was the worst of times.", "Large models are trained on trillions of tokens collected from the web.",
        "Counting the unusual characteristics of refrigerators requires patience and determination.", *[r[1] or "" for r in documents()],
    ]
    ours = [len(m[0]) for m in sentencepieces.encode_batch(plain, v, 1)]
    assert all(a <= b for a, b in zip(ours, map(len, library.encode(plain)))) and ours[0] == 8 and ours[1] == 3


def test_long_words_are_cut_like_short_ones():
    v = sentencepieces.load_vocabulary()
    rng = random.Random(1)
    for n in (300, 900):
        word = (" " + "".join(rng.choice("abcdeé") for _ in range(n))).encode()
        score, loss, ids, _ = sentencepieces.best_of_chunks([word], v)
        one, two = sentencepieces.nbest(word, v, 2)
        assert one == (score[0], tuple(ids.tolist())) and one[0] - two[0] == loss[0]
    same = sentencepieces.nbest(b"ab" * 2000, v, 4)
    assert len({p for _, p in same}) == 4 and sorted((s for s, _ in same), reverse=True) == [s for s, _ in same]


def test_sentencepiece_round_trip(docs, no_docs):
    out = sentencepieces.encoded(docs.withColumn("ids", F.lit("clash")))
    assert out.where("not round_trip").count() == 0
    back = sentencepieces.decoded(out.select("n_chars", "ids")).collect()
    texts = {r[4]: r[1] or "" for r in documents()}
    assert {r.n_chars: r.text for r in back} == texts
    empty = [r for r in out.collect() if not texts[r.n_chars]]
    assert all(r.ids == [] and r.alternatives == [] for r in empty) and sentencepieces.encoded(no_docs).count() == 0
    long = sentencepieces.encode_batch(["ab" * 400 + " end"], sentencepieces.load_vocabulary(), 3)[0]
    assert sentencepieces.decode(long[0].tolist(), sentencepieces.load_vocabulary()) == "ab" * 400 + " end" and len(long[2]) == 2
