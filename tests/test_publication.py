"""Published runs, searches, progress and streams."""

import json

import pytest
from pyspark.sql import functions as F

from marlstone import lineage
from marlstone.checks import ConstraintError
from marlstone.operators import evidence, pairing, publication, telemetry
from marlstone.sources import logs, publications, sinks
from marlstone.streaming import live


def test_identities():
    ids = lineage.lineage_ids({"a": 1}, "exp-1", "r1")
    assert ids.training_run_id == "trun-r1" and ids.adapter_id.startswith("adp-") and ids == lineage.lineage_ids({"a": 1}, "exp-1", "trun-r1")
    for bad in (("run-1", None), ("exp-/x", None), ("exp-1", "a b")):
        with pytest.raises(ValueError):
            lineage.lineage_ids({}, *bad)
    assert lineage.lineage_ids({}).experiment_id.startswith("exp-")


def test_publish_and_reuse(spark, tmp_path):
    root, bundle = str(tmp_path / "store"), tmp_path / "bundle"
    bundle.mkdir()
    (bundle / "adapter_config.json").write_text("{}")
    ids = lineage.lineage_ids({"a": 1}, "exp-1", "r1")
    rows = spark.createDataFrame([("2", "b"), ("1", None)], "dataset_record_id string, generated_answer string")
    publish = lambda: publications.publish_run(spark, root, ids, str(bundle), {"metrics": {"loss": 1.0}}, {"baseline": rows, "trained": rows.limit(1)})
    assert publications.completed_run(spark, root, ids) is None
    with pytest.raises(ConstraintError, match="adapter_model"):
        publish()
    assert publications.completed_run(spark, root, ids) is None  # nothing terminal before the bundle is whole
    for f in ("checksums.json", "adapter-manifest.json"):
        (bundle / f).unlink()
    (bundle / "adapter_model.safetensors").write_bytes(b"12345")
    terminal = publish()
    assert publications.completed_run(spark, root, ids) == terminal == publish()
    lines = [json.loads(r.value) for r in spark.read.text(terminal["baseline_predictions_uri"]).collect()]
    assert lines == [{"dataset_record_id": "1", "generated_answer": None}, {"dataset_record_id": "2", "generated_answer": "b"}]
    assert publications.put_experiment(spark, root, ids, {"name": "n"}) == publications.put_experiment(spark, root, ids, {"name": "n"})
    with pytest.raises(sinks.WriteConflict):
        publications.put_experiment(spark, root, ids, {"name": "other"})
    publications.put_variant(spark, root, ids, {"a": 1}, {"d": 2})
    publications.put_request(spark, root, ids, {"dataset_manifest_uri": "u"}, {"x": 1})
    (bundle / "adapter_model.safetensors").write_bytes(b"12346")
    with pytest.raises(ConstraintError, match="checksum_differs"):
        publications.completed_run(spark, root, ids)
    sums = publications.finalize_evaluation(spark, str(tmp_path / "ev"), {"config": str(bundle / "adapter_config.json")}, {"aggregate": {}})
    assert len(sums["config"]) == 64 and sinks.completed(spark, str(tmp_path / "ev"))["artifact_checksums"] == sums
    with pytest.raises(Exception):
        publications.finalize_evaluation(spark, str(tmp_path / "ev2"), {"config": str(bundle / "none.json")}, {})


def test_prediction_rows(spark):
    output = {"record_id": 7, "prompt": "p", "expected": "e", "generated": None, "exact_match": False, "metadata": {"recipe": None, "document_ids": [1, None, 1, 2]}, "provenance": {"recipe": "r", "probe_id": "q"}, "knowledge_unit_id": 3, "knowledge_unit_ids": "3"}
    df = spark.createDataFrame([("exp-1", "tvar-1", "trun-1", "adp-1", json.dumps(output))], "experiment_id string, training_variant_id string, training_run_id string, adapter_id string, output string")
    r = publication.prediction_rows(df, "baseline").first()
    assert r.adapter_id is None and r.dataset_record_id == "7" and r.recipe is None and r.probe_id == "q" and r.knowledge_unit_ids == ["3"] and r.document_ids == ["1", "2"] and r.exact_match is False and r.evidence_ids == []
    assert publication.prediction_rows(df, "trained").first().adapter_id == "adp-1" and len(r) == 29


def test_backfill():
    p = publication.backfill_payload({"status": "completed", "training_run_id": "trun-1", "adapter_uri": "u"}, {"loss": 1}, {"configuration": {"a": 1}, "started_at": "s"})
    assert p["identity"]["training_run_id"] == "trun-1" and p["run_metadata"]["original_started_at"] == "s" and p["parameters"] == {"a": 1}
    with pytest.raises(ValueError):
        publication.backfill_payload({"status": "failed"}, {}, {})


def test_checked_pairs_and_evidence(spark):
    ddl = "candidate_id string, record_id string, side string, answer string, expected string, canonical string, ordinal int"
    ok = [("c", "1", "candidate", "a", "e", "x", 1), ("c", "1", "candidate", "a", "e", "x", 0), ("c", "1", "baseline", None, "e", "y", 0)]
    pairs = pairing.pair_pivot(pairing.checked(spark.createDataFrame(ok, ddl))).collect()
    assert [(r.baseline_answer, r.candidate_answer, r.has_baseline, r.candidate_duplicate, r.baseline_duplicate) for r in pairs] == [(None, "a", True, True, False)]
    for bad in (("c", "\n", "candidate", "a", "e", "x", 0), ("c", "1", "candidate", "b", "e", "z", 2)):
        with pytest.raises(ConstraintError):
            pairing.checked(spark.createDataFrame([*ok, bad], ddl))
    items = evidence.lookup(spark.createDataFrame([("1", "t")], "evidence_id string, text string"))
    want = lambda *ids: spark.createDataFrame([(i,) for i in ids], "evidence_id string")
    assert evidence.checked_lookup(want("1"), items).first().text == "t"
    with pytest.raises(ConstraintError):
        evidence.checked_lookup(want("1", "2"), items)


def test_ranked_values(spark):
    rows = [("a", float(x)) for x in (5, -3, 0, 0, 7.5, 1e-9, -1e12, 2)] + [(None, 1.0), (None, 1.0), ("z", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.low, r.mid, r.top) for r in telemetry.ranked_values(df, "v", {"low": F.lit(0), "mid": F.floor((F.col("n") - 1) / 2), "top": F.col("n") - 1}, "k").collect()}
    assert got == {"a": (-1e12, 0.0, 7.5), None: (1.0, 1.0, 1.0)}
    s = {r.k: r for r in telemetry.latency_summary(df, "v", "k").collect()}
    assert s["a"].median_ms == 500 * 1e-9 and s["z"].sample_count == 0 and s["z"].p95_ms is None and telemetry.latency_summary(df, "v").first().sample_count == 10


def test_log_events(spark):
    lines = ["resumed at step 3/5", " \x1b[1mstep 4/5\x1b[0m done", "step 4 / 5", "X_MODEL_LOADED reused", "reused", "X_TRAINING_STARTED", "step 45/5x"]
    got = logs.step_events(spark.createDataFrame([(k, v) for k, v in enumerate(lines)], "k int, line string")).orderBy("k").collect()
    assert [r.step for r in got] == [None, 4, None, None, None, None, None] and [r.reused for r in got] == [k == 3 for k in range(7)] and got[5].started


def test_only_fresh_samples_stay(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id) as ts, id from range(20)").write.parquet(src)
    stream = live.fresh_only(spark.readStream.schema("ts timestamp, id long").parquet(src), "5 minutes", F.lit("2024-01-01 00:15:00").cast("timestamp"))
    assert sorted(r.id for r in live.run_to_end(stream, "append", "fresh").collect()) == list(range(10, 20))


def test_streams_resume_and_emit(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("c", "1"), ("c", "2")], "candidate_id string, record_id string").write.parquet(src)
    stream = spark.readStream.schema("candidate_id string, record_id string").parquet(src)
    committed = spark.createDataFrame([("c", "2", 1)], "candidate_id string, record_id string, x int")
    assert [r.record_id for r in live.run_to_end(live.unjudged(stream, committed), "append", "unjudged").collect()] == ["1"]
    seen = []
    q = live.emitted_every(stream, 0.2, lambda batch, n: seen.append(batch.count()), str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    assert sum(seen) == 2


def test_final_report():
    assert "No completed trials" in publications.final_report({})
    out = publications.final_report({"m": {"trial_id": "t", "training_seconds": 1.5, "completed_steps": 2, "power": None}})
    assert "- training_seconds: 1.5000" in out and "- completed_steps: 2" in out and "- power: unavailable" in out


def test_registry():
    from marlstone.registry import Registry

    r = Registry("backend")
    r.register("a", dict)
    r.register("b")(lambda x: x + 1)
    assert r.create("a", k=1) == {"k": 1} and r.create("b", 1) == 2 and r.names() == ["a", "b"]
    for bad in (lambda: r.register("a", list), lambda: r.create("c")):
        with pytest.raises(ValueError):
            bad()


def test_samplers(spark):
    from marlstone.sources.samplers import register_sampler

    name = register_sampler(spark, "fixture_sampler", lambda k: [(k, float(k) / 2), (k, None)], "n int, watts double")
    assert sorted(r.n for r in spark.read.format(name).option("samples", 3).load().collect()) == [0, 0, 1, 1, 2, 2]
    q = spark.readStream.format(name).option("samples", 3).load().writeStream.format("memory").queryName("sampled").start()
    q.processAllAvailable()
    q.stop()
    rows = spark.table("sampled").collect()
    assert {r.n for r in rows} <= {0, 1, 2} and len(rows) >= 2


def test_judges(spark):
    from marlstone.operators import judging

    class Client:
        def acquire(self):
            self.open = True

        def release(self):
            self.open = False

        def count_tokens(self, messages):
            return len(messages)

        def judge(self, messages):
            if messages == "bad":
                raise OSError(messages)
            return messages.upper() if self.open else ""

    r = spark.createDataFrame([("1", "abc"), ("2", "bad"), ("3", "x" * 50)], "request_id string, messages string")
    got = {x.request_id: (x.response, x.reason) for x in judging.judged_by(r, Client, 40, 10).collect()}
    assert got == {"1": ("ABC", None), "2": (None, "judge_request_failed"), "3": (None, "token_budget_exceeded")}
    body = '{"id":"i","model":"m","choices":[{"message":{"content":"c"},"finish_reason":"stop"}],"usage":{"prompt_tokens":3,"completion_tokens":4}}'
    f = spark.createDataFrame([(body,), ("{}",)], "b string").select(judging.response_fields(F.col("b")).alias("f")).select("f.*").collect()
    assert tuple(f[0]) == ("c", "m", "stop", "i", 3, 4, None) and f[1].error == "response without content"


def test_rendering_and_storage(spark):
    from marlstone.sources import uris

    text = sinks.render_nested({"run_id": "r", "gpu usage": [{"a": 1, "b_c": None}, {"a": 22}], "empty": {}, "none": [], "mixed": [1, {"x": [2]}]})
    assert text.splitlines() == ["Run id: r", "Gpu usage:", "  A   B c", "  --  ----", "  1   null", "  22  null", "Empty:", "  No fields.", "None:", "  No records.", "Mixed:", "  - 1", "  Record 2:", "    X:", "      - 2"]
    s = uris.Storage({"datasets": ("dataset", "main", "/data/")})
    assert s.locate(s.uri("datasets", "a/b")) == "/data/a/b" and s.locate("/x") == "/x"
    for bad in ("storage://main/x/a", "storage://other/datasets/a", "storage://main/datasets/../a", "storage://main"):
        with pytest.raises(ValueError):
            s.locate(bad)
    assert uris.resolved(spark.createDataFrame([(s.uri("datasets", "k"),)], "uri string"), s.table(spark)).first().failure is None


def test_configuration_rules():
    from marlstone import config as C

    good = C.TrainingConfig.from_mapping({"model_name": "m", "target_modules": ["a"], "max_examples": None})
    assert good.target_modules == ("a",)
    bad = [
        (C.TrainingConfig, {"lora_alpha": 0}), (C.TrainingConfig, {"learning_rate": 0}), (C.TrainingConfig, {"lora_dropout": 1}), (C.TrainingConfig, {"overlength": "cut"}), (C.TrainingConfig, {"run_id": "a", "training_run_id": "b"}),
        (C.TrainingConfig, {"run_id": "a/b"}), (C.TrainingConfig, {"experiment_id": "x"}), (C.TrainingConfig, {"tracking_backend": "table"}), (C.TrainingConfig, {"max_examples": 0}), (C.TrainingConfig, {"nope": 1}),
        (C.CapacityConfig, {"gpu_memory_limit_percent": 101}), (C.CapacityConfig, {"trial_timeout_seconds": 0}), (C.CapacityConfig, {"axes": ["lora_rank"]}), (C.CapacityConfig, {"batch_sizes": []}), (C.CapacityConfig, {"reuse_loaded_model": True, "restart_worker_after_oom": False}),
        (C.EvaluationConfig, {"evidence": {"required": True}}), (C.EvaluationConfig, {"judge": {"max_output_tokens": 40000}}), (C.EvaluationConfig, {"minimum_record_overlap": 0}), (C.EvaluationConfig, {"gates": {"maximum_regression_rate": 2}}),
    ]
    for cls, values in bad:
        with pytest.raises(ValueError):
            cls.from_mapping(values)
    r = C.resolve(C.TrainingConfig, {"lora_rank": 4, "seed": 1}, {"lora_rank": 16, "seed": None, "max_steps": 1})
    assert (r.sources["lora_rank"], r.sources["seed"], r.sources["lora_alpha"]) == ("--lora-rank", "file", "built-in")
    assert [(o["key"], o["previous"], o["effective"]) for o in r.overrides] == [("lora_rank", 4, 16)]
