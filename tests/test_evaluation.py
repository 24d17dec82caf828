import json

from pyspark.sql import functions as F

from marlstone.functions import canon, text
from marlstone.operators import evalagg, evidence, judging, pairing, scoring


def preds(spark, rows):
    return spark.createDataFrame(rows, "candidate_id string, record_id string, side string, answer string, expected string, ordinal int").withColumn("canonical", F.concat_ws("|", "answer", "expected"))


def test_pairing_duplicates_conflicts(spark):
    p = preds(spark, [("c", "1", "baseline", "x", "X", 0), ("c", "1", "candidate", " x ", "X", 0), ("c", "1", "candidate", " x ", "X", 1), ("c", "2", "baseline", "y", "y", 0), ("c", "3", "candidate", "z", "q", 0), ("c", " ", "candidate", "z", "q", 0)])
    pairs = {r.record_id: r for r in pairing.pair_pivot(p).collect()}
    assert sorted(pairs) == ["1", "2", "3"] and pairs["1"].candidate_duplicate and not pairs["1"].baseline_duplicate
    assert pairing.conflicts(p).count() == 0 and pairing.invalid_ids(p).count() == 1
    bad = preds(spark, [("c", "1", "baseline", "x", "X", 0), ("c", "1", "baseline", "other", "X", 1)])
    assert pairing.conflicts(bad).count() == 1
    s = pairing.summary(pairing.pair_pivot(p)).first()
    assert (s.record_count, s.paired_count, s.missing_baseline_count, s.missing_candidate_count, s.duplicate_candidate_count) == (3, 1, 1, 1, 1)
    assert {r.record_id: r.missing for r in pairing.issues(pairing.pair_pivot(p)).collect()} == {"1": None, "2": "candidate", "3": "baseline"}


def test_scores(spark):
    p = preds(spark, [("c", "1", "baseline", "Die STRASSE", "die straße", 0), ("c", "1", "candidate", "in die\t straße hier", "die straße", 0)])
    r = scoring.deterministic_results(pairing.pair_pivot(p)).first()
    assert r.baseline.normalized_exact_match and not r.candidate.normalized_exact_match and r.candidate.expected_answer_containment and r.answer_changed
    one = spark.createDataFrame([("a-b, ü c",)], "t string").select(text.token_estimate(F.col("t")), text.normalize_training_answer(F.lit(" Straße "))).first()
    assert one[0] == 6 and one[1] == "straße"


def test_format(spark):
    rows = [("{}", "json"), ("[1", "json"), ("[1]", "json_object"), ("{}", "json_object"), (" ", "text"), ("x", None)]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, f string").select(canon.format_valid(F.col("a"), F.col("f"))).collect()]
    assert got == [True, False, False, True, False, None]


def test_denominators_and_gates(spark):
    p = preds(spark, [("c", "1", "baseline", "a", "a", 0), ("c", "1", "candidate", "a", "a", 0), ("c", "2", "candidate", "b", "b", 0)])
    results = scoring.deterministic_results(pairing.pair_pivot(p))
    ddl = "candidate_id string, decision string, regression boolean, basis string, reference_correctness double, evidence_faithfulness double, latency_seconds double, prompt_tokens long, completion_tokens long"
    none = evalagg.aggregate_candidates(results, spark.createDataFrame([], ddl), spark.createDataFrame([], "candidate_id string"))
    m = none.first()
    assert (m.record_count, m.paired_record_count, m.record_coverage, m.deterministic_accuracy, m.unjudgeable_rate, m.candidate_win_rate, m.invalid_judge_response_rate) == (2, 1, 0.5, 1.0, 1.0, 0.0, 0.0)
    assert m.judge_reference_correctness_mean is None
    assert evalagg.recommendations(none).first().recommendation == "insufficient_evidence"
    j = spark.createDataFrame([("c", "candidate_better", False, "evidence-grounded", 1.0, 1.0, 0.5, 10, 2)], ddl)
    good = evalagg.recommendations(evalagg.aggregate_candidates(results, j, spark.createDataFrame([("c",)], "candidate_id string")), {"minimum_record_coverage": 0.5, "require_human_approval": False})
    r = good.first()
    assert r.recommendation == "recommended_for_promotion" and r.failed_gates == [] and r.invalid_judge_response_rate == 0.5
    assert evalagg.downgraded(good, False, 2).first().recommendation == "manual_review_required"
    assert evalagg.recommendations(evalagg.aggregate_candidates(results, j, spark.createDataFrame([], "candidate_id string"))).first().failed_gates == ["minimum_record_coverage"]


def test_overlap_keeps_zero(spark):
    sets = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "2")], "candidate_id string, record_id string")
    c = spark.createDataFrame([("a", 0), ("b", 1), ("x", 2), ("y", 3)], "candidate_id string, ordinal int")
    got = {(r.left_id, r.right_id): r.overlap for r in evalagg.overlaps(sets, c).collect()}
    assert got[("a", "b")] == 0.5 and got[("a", "x")] == 0.0 and got[("x", "y")] == 1.0 and len(got) == 6
    assert evalagg.comparability(evalagg.overlaps(sets, c), 0.5).first().comparable is False


def test_evidence(spark):
    items = spark.createDataFrame([("1", "t"), ("2", "u"), (None, "v"), ("2", "w")], "evidence_id string, text string")
    rec = spark.createDataFrame([("a", ["2", "9", "1"]), ("b", [])], "record_id string, evidence_ids array<string>")
    got = {r.record_id: r for r in evidence.resolved(rec, evidence.lookup(items)).collect()}
    assert [x.evidence_id for x in got["a"].resolved_evidence] == ["2", "1"] and got["a"].missing_evidence_ids == ["9"] and got["b"].resolved_evidence == []
    assert [r.evidence_id for r in evidence.conflicting(items.where("evidence_id is not null")).collect()] == ["2"]


def test_judgments(spark):
    side = {d: 0.5 for d in judging.DIMENSIONS}
    ok = {"baseline": side, "candidate": side, "decision": "tie", "confidence": 1, "regression": False, "rationale": "r", "evidence_sufficiency": "sufficient"}
    cases = [ok, {**ok, "baseline": {**side, "relevance": True}}, {**ok, "confidence": 2}, {**ok, "failure_categories": "x"}, {**ok, "decision": None}, [1]]
    got = [r[0] for r in spark.createDataFrame([(json.dumps(c),) for c in cases], "t string").select(judging.judgment_error(F.col("t"))).collect()]
    assert got == [None, "baseline.relevance: not a number", "confidence: not a share", "failure_categories: not a list", "decision: unknown", "response: not a JSON object"]


def test_attempts(spark):
    pairs = spark.createDataFrame([("c", "1"), ("c", "2"), ("c", "3")], "candidate_id string, record_id string")
    req = spark.createDataFrame([("c", "1", 0), ("c", "2", 0), ("c", "2", 1), ("c", "2", 2)], "candidate_id string, record_id string, attempt int")
    rej = spark.createDataFrame([("c", "1", 0, "token_budget_exceeded")], "candidate_id string, record_id string, attempt int, reason string")
    got = {r.record_id: (r.next_attempt, r.terminal, r.interrupted) for r in judging.attempt_state(pairs, req, rej, 2).collect()}
    assert got == {"1": (1, True, 0), "2": (3, True, 3), "3": (0, False, 0)}


def test_judge_callable(spark):
    r = spark.createDataFrame([("1", "abc")], "request_id string, messages string")
    assert judging.judged(r, str.upper).first().response == "ABC"


def test_checksum_vectors(spark):
    r = spark.createDataFrame([('{"b": 1, "a": "ü", "c": null}', "a\"b\r\nü")], "j string, t string")
    import hashlib

    got = r.select(canon.stable_json(F.col("j")).alias("j"), canon.string_literal_checksum(F.col("t")).alias("t")).first()
    assert got.j == '{"a":"ü","b":1,"c":null}' and got.t == hashlib.sha256(json.dumps("a\"b\r\nü", ensure_ascii=False).encode()).hexdigest()
