import json

import pytest

from marlstone import config, lineage
from marlstone.sources import manifests, sinks
from marlstone.streaming import live


def test_write_once(spark, tmp_path):
    p = str(tmp_path / "m.json")
    assert sinks.put_json(spark, p, {"b": 1}) == sinks.put_json(spark, p, {"b": 1})
    with pytest.raises(sinks.WriteConflict):
        sinks.put_json(spark, p, {"b": 2})
    rows = spark.createDataFrame([(2, '{"x":2}'), (1, '{"x":1}')], "k int, line string")
    d = str(tmp_path / "rows")
    assert sinks.put_jsonl(rows, d, ["k"]) == sinks.put_jsonl(rows, d, ["k"])
    assert [r.value for r in spark.read.text(d + "/part-*").collect()] == ['{"x":1}', '{"x":2}']
    with pytest.raises(sinks.WriteConflict):
        sinks.put_jsonl(rows.limit(1), d, ["k"])
    assert sinks.file_checksums(spark, p).first().size_bytes == 7


def test_terminal_manifest_last(spark, tmp_path):
    root = str(tmp_path)
    assert sinks.completed(spark, root) is None
    with pytest.raises(sinks.WriteConflict):
        sinks.finalize(spark, root, {"a": "1"}, {"a": "2"}, {})
    assert sinks.completed(spark, root) is None
    sinks.finalize(spark, root, {"a": "1"}, {"a": "1"}, {"run": "r"})
    assert sinks.completed(spark, root)["run"] == "r"

    def fail():
        raise KeyError("x")

    with pytest.raises(KeyError):
        sinks.with_failure(spark, root, fail)
    assert json.loads((tmp_path / "failure.json").read_text())["error"] == "KeyError"


def test_attempts_and_tracking(spark, tmp_path):
    a = spark.createDataFrame([("q1", "c"), ("q2", "c")], "request_id string, candidate_id string")
    sinks.append_attempts(a.limit(1), str(tmp_path / "a"))
    sinks.append_attempts(a, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2
    t = sinks.Tracker(spark, str(tmp_path / "t"), "run")
    t.log_metrics({"loss": 1.5, "flag": True}, 3)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "t/metrics")).collect()] == [("run", "loss", 1.5, 3)]
    blocked = tmp_path / "file"
    blocked.write_text("")
    quiet = sinks.Tracker(spark, str(blocked), "run")
    quiet.log_metrics({"x": 1})
    assert not quiet.active
    with pytest.raises(Exception):
        sinks.Tracker(spark, str(blocked), "run", "error").log_metrics({"x": 1})


def test_text_outputs():
    assert sinks.render_table([]) == "No records."
    assert sinks.render_table([{"b": 1}, {"b": 22, "a": None}]).splitlines() == ["b   a", "1", "22"]
    assert sinks.to_toml({"a": "x", "b": None, "c": [1, 2]}) == 'a = "x"\nc = [1, 2]\n'


def test_unreadable_evidence(spark, tmp_path):
    (tmp_path / "d.jsonl").write_text(json.dumps({"evidence_id": "1", "text": "a"}))
    items, failures = manifests.evidence_items(spark, {"evidence_refs": [str(tmp_path / "d.jsonl"), str(tmp_path / "none.jsonl")]})
    assert items.count() == 1 and [f["category"] for f in failures] == ["unreadable"]


def test_ids_and_config(tmp_path):
    assert lineage.variant_id({"b": 1, "a": 2}) == lineage.variant_id({"a": 2, "b": 1})
    assert lineage.training_run_id("x") == "trun-x" and lineage.training_run_id("trun-x") == "trun-x"
    one = lineage.variant_identity({"target_modules": ["b", "a"], "output_dir": "x", "lora_alpha": 16}, {"recipe": "r", "uri": "u"}, {"name": "m"})
    assert one["training"]["target_modules"] == ["a", "b"] and one["training"]["lora_alpha"] == 16 and "output_dir" not in one["training"] and one["dataset"]["recipe"] == "r"
    ids = {lineage.variant_id(lineage.variant_identity(c, {}, m)) for c, m in (({}, {}), ({"lora_alpha": 1}, {}), ({"load_in_4bit": True}, {}), ({"backend": "x"}, {}), ({"data_order": "y"}, {}), ({}, {"name": "m"}))}
    assert len(ids) == 6  # each of these settings makes another variant
    assert config.EvaluationConfig.from_mapping({"candidates": ["a"], "gates": {"maximum_regression_rate": 0.1}}).gates.values["maximum_regression_rate"] == 0.1
    for bad in ({"candidates": ["a", "a"]}, {"judge": {"timeout_seconds": 0}}, {"gates": {"nope": 1}}):
        with pytest.raises(ValueError):
            config.EvaluationConfig.from_mapping(bad)
    assert config.dataset_mode("storage://a/b/c") == "manifest" and config.dataset_mode("x.jsonl") == "jsonl"
    with pytest.raises(ValueError):
        config.dataset_mode("x.jsonl", "manifest")
    assert config.storage_root(None, "c", "r") == "c"


def test_stream_line_splitter(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("p", 1, "a\rb"), ("p", 2, "c\nd")], "process string, ordinal int, text string").write.parquet(src)
    stream = spark.readStream.schema("process string, ordinal int, text string").parquet(src)
    assert sorted(r.line for r in live.run_to_end(live.split_lines(stream), "append", "lines").collect()) == ["a", "bc"]
    q = live.refreshed(stream, lambda batch, n: 1 / 0, str(tmp_path / "ck"))
    q.awaitTermination()
    assert q.exception() is None
