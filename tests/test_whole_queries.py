"""Catalogue queries over small tables against brute force over all of their rows."""

import re

from marlstone.operators import containment
from marlstone.plans import QUERIES
from marlstone.plans import views as V


def tables(spark, tmp_path, **frames):
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def normalized(t):
    return re.sub(r"\s+", " ", t or "").strip().lower().replace("ß", "ss")


def test_answer_containment(spark, tmp_path):
    docs = [(1, "The quick\n brown  fox jumps over"), (2, "unquick brown foxes, STRASSE"), (3, None), (4, "a b"), (5, ""), (6, "one two three four five six seven"), (7, "brown fox brown foxy quick brown fox")]
    items = [(10, "quick brown fox"), (12, "Brown FOX"), (13, "straße"), (19, None), (21, " "), (24, "ne two three four five si"), (30, "a b"), (33, "b"), (36, "quick brown fox"), (41, "two four")]
    want = sorted((d, i) for d, t in docs for i, w in items if normalized(w) and normalized(w) in normalized(t))
    assert len(want) > 12 and sum(d % 5 == i % 5 for d, i in want) < len(want)
    sf = tables(spark, tmp_path, documents=(docs, "doc_id long, text string"), benchmark=(items, "item_id long, text string"))
    assert sorted(map(tuple, QUERIES["answer_containment"](spark, sf).collect())) == want
    d, b = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    assert sorted(map(tuple, containment.contained(d, b, block_bytes=20).collect())) == want


def test_predictions_are_whole_texts(spark, tmp_path):
    texts = {k: f"Text {k} " + "word " * 100 + f"end{k}" for k in range(6)}
    sf = tables(spark, tmp_path, documents=(list(texts.items()), "doc_id long, text string"), labels=([(k,) for k in range(4)], "doc_id long"))
    scores = {(r.candidate_id, int(r.record_id)): r for r in QUERIES["det_scores"](spark, sf).collect()}
    assert len(scores) == 12
    for (c, k), r in scores.items():
        longer = k % 3 == int(c[-1])
        assert (r.cand_exact, r.cand_contains) == (not longer, True) and r.base_exact == (k < 4)
        assert r.cand_chars == len(texts[k]) + (len(" indeed") if longer else 1 + texts[k].count(" "))
    p = V.predictions(spark, sf)
    assert all(r.expected == texts[int(r.record_id)] and (r.side == "candidate" or r.answer == r.expected) for r in p.collect())


def test_token_estimates(spark, tmp_path):
    texts = ["plain text, here", "Grüße aus Köln – schön!", "数据 处理。", "naïve café x² ½ Ⅷ", "tab\x1cnext line end\x85.", "a‍b", "😀 ok", ""]
    sf = tables(spark, tmp_path, documents=(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: (r.n_tokens, r.n_characters, r.budget) for r in QUERIES["token_estimates"](spark, sf).collect()}
    assert got == {k: (len(re.findall(r"\w+|[^\w\s]", t)), len(t), max(1, len(t) // 3) + 512) for k, t in enumerate(texts)}


def test_growth_rates(spark, tmp_path):
    rows = [(e, e % 2, f"2024-01-01 00:00:{e:02d}", "click", float(v)) for e, v in enumerate([5, 1, 9, 4, 30, 2, 31, 8])]
    frame = spark.createDataFrame(rows, "event_id long, user_id long, ts string, event_type string, value double")
    frame.selectExpr("event_id", "user_id", "cast(ts as timestamp) as ts", "event_type", "value").write.parquet(f"{tmp_path}/events.parquet")
    want, last = {}, {}
    for e, d, _, _, v in rows:
        want[e] = round(max(0.0, v - last[d][1]) / (e - last[d][0]), 4) if d in last else 0.0
        last[d] = (e, v)
    assert {r.event_id: r.rate for r in QUERIES["growth_rates"](spark, str(tmp_path)).collect()} == want
