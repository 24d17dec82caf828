"""Operator 2: ids are cut once, and the cheaper gradient step is the plain one."""

import numpy as np
import pyarrow as pa
from fixtures import prose
from marlstone.llm import lm_scoring
from marlstone.llm.attention import LENGTH, STRIDE, AttentionModel, _rows, windows


def test_rows_leave_out_what_is_no_token():
    rng = np.random.default_rng(1)
    for most in (5, 70_000):
        ids = rng.integers(-1, most, 400).astype(np.int32)
        values = rng.standard_normal((400, 6)).astype(np.float32)
        got, sums = _rows(values, ids)
        assert got.tolist() == sorted(set(ids.tolist()) - {-1})
        assert np.allclose(sums, [values[ids == i].sum(axis=0) for i in got], atol=1e-4)
    assert len(_rows(values, np.full(400, -1, np.int32))[0]) == 0


def test_gradient_of_every_position():
    """Each table's gradient against differences of the loss; masked and short windows are among them."""
    rng = np.random.default_rng(3)
    sizes = [40, 3, 0, 17]
    inputs, targets, _ = windows(rng.integers(0, 11, sum(sizes)).astype(np.int32), sizes, 11)
    m = AttentionModel(12, width=4, mixes=6)
    m.begin(targets)
    flat = targets.reshape(-1)

    def loss():
        p = (m.probabilities(inputs).astype(float) * m.emitted[np.maximum(flat, 0)]).sum(axis=1)
        return -np.log(p[flat >= 0]).sum()

    d, n = m.width, len(inputs)
    now, past, gamma = np.empty((n * STRIDE, 2 * d + m.mixes), np.float32), np.empty((n, LENGTH, 2 * d), np.float32), np.empty((n * STRIDE, m.mixes), np.float32)
    top, distance = m._gradient(inputs, flat, np.float32(1), now, past, gamma)
    dense = {"top": top, "distance": distance}
    for name, grad, ids in (("now", now, inputs[:, LENGTH - STRIDE :]), ("past", past.reshape(-1, 2 * d), inputs)):
        at, sums = _rows(grad, ids.reshape(-1))
        dense[name] = np.zeros_like(m.tables[name])
        dense[name][at] = sums
    for name, grad in dense.items():
        table = m.tables[name].reshape(-1)
        for k in rng.choice(len(table), min(len(table), 24), replace=False):
            kept, step = table[k], np.float32(0.02)
            table[k] = kept + step
            more = loss()
            table[k] = kept - step
            less = loss()
            table[k] = kept
            assert abs((more - less) / 0.04 - grad.reshape(-1)[k]) < 0.02, (name, k)


def test_ids_are_stored_once_for_all_passes(spark):
    texts = [prose(300, 1), "", None, "Ä\x0bzebra  ZEBRA", "x" * 5000, prose(5, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    contents, end, _ = lm_scoring._vocabulary(lm_scoring.MODEL)
    made = lm_scoring.encoded(docs, spark.sparkContext.broadcast(contents), end)
    rows = {r.doc_id: r for r in made.where("ids is not null").collect()}
    assert len(rows) == len(texts)
    cut = lm_scoring.Pieces(contents)
    for k, text in enumerate(texts):
        words, _ = cut.numbers(pa.array([text], pa.string()))
        want = cut.ids(words, np.array([len(words)]))[0]
        flat, sizes, begins = lm_scoring._ids(pa.array([rows[k].ids], pa.binary()), end)
        assert flat.tolist() == want.tolist() and sizes.tolist() == [len(want)] and begins.sum() == len(words) and rows[k].text == text
    assert lm_scoring.training_windows(made, None, end).count() == made.where("inputs is not null").count() > 0
