"""Small operators and functions, each over a few rows with its awkward cases."""

import json
import time

from pyspark.sql import functions as F

from marlstone.functions import canon, text
from marlstone.operators import judging, metrics, records, telemetry
from marlstone.sources import sinks, telemetry_csv
from marlstone.streaming import live


def test_counters_and_hosts(spark):
    c = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", float("inf")), ("a", -5.0), ("a", 2.5), ("b", None)], "k string, value double")
    assert {r.k: r.total for r in telemetry_csv.counter_totals(c, "k").collect()} == {"a": 3.5}
    h = spark.createDataFrame([(1, "wsl", 5, 10), (1, "windows", 6, 20), (2, "linux", 7, 30), (2, "wsl", 8, 40)], "t int, scope string, used_bytes long, total_bytes long")
    assert {r.t: (r.scope, r.used_bytes) for r in telemetry_csv.preferred_host(h).collect()} == {1: ("windows", 6), 2: ("wsl", 8)}


def test_monitor_and_first_breach(spark):
    ddl = "device string, t double, cpu_percent double, ram_percent double, host string, read_bytes long, write_bytes long"
    m = telemetry.monitor_summary(spark.createDataFrame([("d", 0.0, 10.0, 1.0, "h0", 100, 5), ("d", 2.0, 30.0, None, "h2", 150, 5), ("d", 1.0, None, 3.0, "h1", 120, 5)], ddl)).first()
    assert (m.cpu_average, m.cpu_peak, m.ram_average, m.ram_peak, m.host, m.read_bytes_delta, m.write_bytes_delta) == (20.0, 30.0, 2.0, 3.0, "h2", 50, 0)
    f = spark.createDataFrame([("d", 5.0, 1, "late", True), ("d", 3.0, 2, "brief", False), ("d", 4.0, 2, "gpu", True), ("d", 4.0, 1, "trial_timeout", False)], "device string, t double, check int, key string, sustained boolean")
    b = telemetry.first_breach(f, ("trial_timeout",)).first().b if "b" in telemetry.first_breach(f, ("trial_timeout",)).columns else telemetry.first_breach(f, ("trial_timeout",)).first()
    assert b.key == "trial_timeout" and b.t == 4.0


def test_throughput(spark):
    t = telemetry.throughput(spark.createDataFrame([(0.0, 1, 2, 3), (2.0, 4, 6, None)], "elapsed double, steps int, examples int, tokens int")).orderBy("elapsed").collect()
    assert t[0].steps_per_second is None and (t[1].steps_per_second, t[1].examples_per_second, t[1].tokens_per_second) == (2.0, 3.0, None)


def test_texts(spark):
    df = spark.createDataFrame([("```json\n{}\n```",), (" {} ",), ("`x`",), ("``` json {} ```\n",), ("```{}",)], "t string")
    assert [r[0] for r in df.select(text.without_fences(F.col("t"))).collect()] == ["{}", "{}", "`x`", "{}", "```{}"]
    none = F.lit(None).cast("double")
    one = spark.range(1)
    assert one.select(text.loading_status(F.lit(19), F.lit(8267825971).cast("long"), F.lit(17), none, F.lit(52))).first()[0] == "19s | VRAM 7.7G | GPU 17% | 52C"
    assert one.select(text.progress_line(F.lit(1), F.lit(2), F.lit(0.5), none, none, none, none, none)).first()[0] == "step 1/2 | loss 0.5000 | GPU n/a"
    names = spark.createDataFrame([("a b//c",), ("..x..",), ("",), ("é" * 5,), ("n" * 200,)], "t string")
    assert [r[0] for r in names.select(text.metric_segment(F.col("t"))).collect()] == ["a_b_c", "x", "unnamed", "unnamed", "n" * 120]
    ids = spark.createDataFrame([("exp-1",), ("-x",), ("a/b",), (None,)], "t string")
    assert [r[0] for r in ids.select(canon.valid_lineage_id(F.col("t"))).collect()] == [True, False, False, False]


def test_records_and_metrics(spark):
    df = spark.createDataFrame([(1, None, 0)], "a int, b int, c int")
    assert df.select(records.split_counts_map({"a": F.col("a"), "b": F.col("b"), "c": F.col("c")})).first()[0] == {"a": 1, "c": 0}
    assert records.lineage_row(df, ("a", "z")).first().asDict() == {"a": 1, "z": None}
    m = spark.createDataFrame([("k", {"x y": 1.0, "b": 2.0})], "k string, v map<string,double>")
    assert {(r.name, r.value) for r in metrics.map_metrics(m, "k", "v").collect()} == {("x_y", 1.0), ("b", 2.0)}
    s = spark.createDataFrame([("exact recall", 0.5), ("none", None)], "suite string, accuracy double")
    assert [tuple(r) for r in metrics.suite_events(s).collect()] == [("exact_recall.accuracy", 0.5)]


def test_judge_messages(spark):
    r = spark.createDataFrame([('{"b": 1, "a": "ü"}',)], "body string").select(judging.judge_messages(F.col("body")).alias("m")).first()
    system, user = json.loads(r.m)
    assert (system["role"], user["role"], user["content"]) == ("system", "user", '{"a": "ü", "b": 1}')


def test_stage_and_markdown(spark, tmp_path):
    sinks.put_stage(spark, str(tmp_path), "pairs", 3, {"x": "y"}, ["b", "a"])
    assert json.loads((tmp_path / "stages" / "pairs.json").read_text()) == {"stage": "pairs", "rows": 3, "checksums": {"x": "y"}, "completed": ["a", "b"]}
    assert sinks.render_markdown([]) == "No records." and sinks.render_markdown([{"a": 1}, {"b": None}]).splitlines() == ["| a | b |", "| --- | --- |", "| 1 |  |", "|  |  |"]


def test_breaches_go_on_over_batches(spark, tmp_path):
    """Each file is a batch: a breach may begin in one and last into the next."""
    rows = {1: [(0, 9.0), (1, 1.0), (2, 9.0)], 2: [(3, 9.0), (4, 1.0), (5, 9.0)], 3: [(6, 9.0), (8, 9.0), (9, 1.0)], 4: [(20, 9.0), (30, 9.0)]}
    for n, own in rows.items():
        frame = spark.createDataFrame([(k, 1, v, f"2024-01-01 00:00:{k:02d}") for k, v in own], "event_id long, user_id long, value double, ts string")
        frame.selectExpr("event_id", "user_id", "value", "cast(ts as timestamp) as ts").coalesce(1).write.parquet(f"{tmp_path}/in/{n}.parquet")
    schema = spark.read.parquet(f"{tmp_path}/in/1.parquet").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    got = live.run_to_end(live.sustained_breaches(stream, 5.0, 3.0), "append", "breach").collect()
    base = 1704067200.0
    assert [(r.device, r.fired_at - base, r.since - base) for r in got] == [(1, 8.0, 5.0)]


def test_folding_one_letter_of_a_long_text(spark):
    """One sharp s doesn't make every other character of its text a look-up."""
    def seconds(letter):
        d = spark.range(0, 8, 1, 1).select(F.concat(F.repeat(F.lit("word \t "), 150_000), F.lit(letter), F.col("id").cast("string")).alias("t"))
        best = 1e9
        for _ in range(2):
            at = time.perf_counter()
            found = d.select(F.max(F.right(text.normalize_answer(F.col("t")), F.lit(3)))).first()[0]
            best = min(best, time.perf_counter() - at)
        return found, best

    (plain, a), (folded, b) = seconds("x"), seconds("ß")
    assert (plain, folded) == (" x7", "ss7")
    assert b < 2 * a + 1, (a, b)


def test_expected_answer_is_normalised_once(spark):
    """The plan of a match has two normalisations, one a side, not one for each use."""
    d = spark.createDataFrame([("a", " A"), ("", ""), (None, None), ("xab", "AB")], "a string, e string")
    for f, want in ((text.exact_match, [True, False, False, False]), (text.contains_expected, [True, False, False, True])):
        out = d.select(f(F.col("a"), F.col("e")).alias("x"))
        assert [r.x for r in out.collect()] == want
        assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 2
