import json

from pyspark.sql import functions as F

from marlstone.operators import metrics, telemetry, trials
from marlstone.sources import logs, telemetry_csv, trial_files, uris


def test_rates(spark):
    df = spark.createDataFrame([("d", 0.0, 100.0), ("d", 2.0, 300.0), ("d", 4.0, 100.0), ("d", 4.0, 200.0)], "device string, t double, v double")
    got = [r.rate for r in telemetry.rates(df, "v", "v").orderBy("t", "v").collect()]
    assert got[:3] == [0.0, 100.0, 0.0] and got[3] > 0


def test_energy_rules(spark):
    df = spark.createDataFrame([("d", 0.0, 10.0), ("d", 1.0, None), ("d", 3.0, 20.0), ("d", 4.0, 5.0), ("n", 0.0, None)], "device string, t double, watts double")
    assert {r.device: r.joules for r in telemetry.energy(df).collect()} == {"d": 30.0, "n": None}
    assert {r.device: r.joules for r in telemetry.energy_of_active(df).collect()} == {"d": 50.0}


def test_latency(spark):
    df = spark.createDataFrame([("o", x) for x in (0.1, 0.2, 0.3)], "op string, s double")
    r = telemetry.latency_summary(df, "s", "op").first()
    assert round(r.average_ms, 6) == 200 and round(r.maximum_ms, 6) == 300 and round(r.p95_ms, 6) == 300 and round(r.median_ms, 6) == 200


def test_sustained_and_breaches(spark):
    df = spark.createDataFrame([("d", float(t), v) for t, v in enumerate([9, 1, 9, 9, 9, 1])], "device string, t double, v int")
    r = telemetry.sustained(df, F.col("v") >= 5, 2.0).first()
    assert (r.fired_at, r.since) == (4.0, 2.0)
    b = telemetry.breaches(df.withColumn("v", F.col("v").cast("double")).withColumn("w", F.lit(1.0)), {"v": 9.0, "w": None})
    assert b.count() == 4


def test_csv_and_bridge(spark):
    rows = [("0, RTX, 11200, 32607, 93, 450.00, 575.00, 72",), ("1, X, [N/A], 10, 1, 1, 0, 1",), ("short, row",)]
    got = telemetry_csv.gpu_rows(spark.createDataFrame(rows, "line string"), "line").orderBy("device_index").collect()
    assert len(got) == 2 and got[0].memory_used_bytes == 11200 << 20 and got[1].memory_used_bytes is None and got[1].power_percent_of_limit is None
    s = spark.createDataFrame([("2024-01-01 00:00:08", 1), ("2024-01-01 00:00:00", 1), ("2024-01-01 00:00:20", 1), ("2024-01-01 00:00:09", None)], "ts string, v int").withColumn("captured_at_utc", F.to_timestamp("ts"))
    fresh = telemetry_csv.bridge_samples(s, F.to_timestamp(F.lit("2024-01-01 00:00:10")), 5.0, ("v",)).collect()
    assert sorted(r.age_seconds for r in fresh) == [0.0, 2.0]


def test_output_lines_and_events(spark):
    df = spark.createDataFrame([(1, "step 1/4\rstep 2/4\r\nTRIAL_COMPLETED\n")], "p int, v string")
    lines = logs.split_output(df, "v", "p")
    assert [r.line for r in lines.orderBy("ordinal").collect()] == ["step 1/4", "step 2/4", "TRIAL_COMPLETED"]
    e = logs.step_events(lines).orderBy("ordinal").collect()
    assert [(r.step, r.of_steps, r.completed) for r in e] == [(1, 4, False), (2, 4, False), (None, None, True)]
    m = spark.createDataFrame([("36 35 98:0 / /mnt/d rw,noatime master:1 - 9p drvfs rw",), ("24 1 8:1 / / rw - ext4 /dev/sda rw",), ("bad",)], "line string")
    paths = spark.createDataFrame([("/mnt/d/models",), ("/mnt/data",)], "path string")
    assert {r.path: r.mount for r in trials.longest_prefix(paths, logs.mounts(m)).collect()} == {"/mnt/d/models": "/mnt/d", "/mnt/data": "/"}


def test_frontier_in_declared_order(spark):
    t = spark.createDataFrame([("8B", 8, "completed", 1), ("14B", 2, "completed", 2), ("14B", 8, "timeout", 3), ("8B", 2, "completed", 4)], "model string, batch int, status string, trial_number int")
    c = spark.createDataFrame([("batch", "2", 0), ("batch", "8", 1)], "axis string, value string, ordinal int")
    f = trials.capacity_frontier(t, ("batch",), c)
    assert {r.model: r.value for r in f.collect()} == {"8B": "8", "14B": "2"}
    assert trials.frontier_configurations(t, f, "batch").count() == 2
    assert trials.latest_safe(t, "batch").where("model = '8B'").first().trial_number == 4


def test_trial_files(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"trial_id": "trial-007-x", "status": "completed", "configuration": {"model_name": "m"}}))
    (tmp_path / "2.json").write_text("{broken")
    (tmp_path / "3.json").write_text(json.dumps({"trial_id": "trial-003", "status": "timeout", "configuration": {"model_name": "m"}}))
    assert [r.trial_number for r in trial_files.completed_results(spark, str(tmp_path)).collect()] == [7]
    configs = spark.createDataFrame([("trial-003",), ("trial-009",)], "trial_id string")
    assert {r.trial_id: r.status for r in trial_files.recovered(configs, trial_files.trial_results(spark, str(tmp_path)).drop("trial_number")).collect()} == {"trial-003": "timeout", "trial-009": "interrupted"}


def test_uris_and_metrics(spark):
    roles = spark.createDataFrame([("datasets", "dataset", "main")], "namespace string, role string, role_profile string")
    u = spark.createDataFrame([("storage://main/datasets/a/b",), ("storage://other/datasets/a",), ("storage://main/x/a",), ("file:///x",), (None,), ("storage://main/datasets/../x",)], "uri string")
    got = {r.uri: r.failure for r in uris.resolved(u, roles).collect()}
    assert got == {"storage://main/datasets/a/b": None, "storage://other/datasets/a": "profile_mismatch", "storage://main/x/a": "unknown_namespace", "file:///x": "unsupported_scheme", None: "missing_uri", "storage://main/datasets/../x": "unsafe_key"}
    assert uris.failures(uris.resolved(u, roles)).count() == 5
    flat = metrics.flattened(spark.createDataFrame([("r", '{"a": {"b": 1, "c": true, "d": [1]}, "e": null}')], "k string, j string"), "k", "j")
    assert {(r.name, r.value) for r in metrics.metric_values(flat).collect()} == {("a.b", 1.0)}
    assert {r.name for r in metrics.parameter_values(flat).collect()} == {"a.b", "a.c", "a.d"}
