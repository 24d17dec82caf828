"""The query catalogue over the test tables: reading checks, published runs, search and progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.operators import publication as pub
from marlstone.operators import records
from marlstone.operators import telemetry as tele
from marlstone.operators import trials as tr
from marlstone.plans import views as V
from marlstone.sources.digests import digests
from marlstone.streaming.live import checkpoint_location

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


@query(f"""WITH {V.RECORDS_SQL}, own AS (SELECT record_id, conv_id % 3 AS source_ordinal, split, research_role, training_eligible FROM (SELECT *, line_number AS conv_id FROM records)
  UNION ALL SELECT record_id, 0, split, research_role, training_eligible FROM records WHERE line_number % 50 = 7)
SELECT 'duplicate_record_id' AS rule, CAST(max(source_ordinal) AS INT) AS source_ordinal, record_id FROM own GROUP BY record_id HAVING count(*) > 1
UNION ALL SELECT 'evaluation_record_trainable', source_ordinal, record_id FROM own WHERE source_ordinal IN (1, 2) AND NOT coalesce(split = 'evaluation' AND training_eligible IS NOT DISTINCT FROM FALSE, FALSE)
UNION ALL SELECT 'evaluation_role_differs', source_ordinal, record_id FROM own WHERE source_ordinal IN (1, 2) AND research_role IS DISTINCT FROM CASE source_ordinal WHEN 1 THEN 'legacy_test' ELSE 'holdout' END
UNION ALL SELECT 'record_count_differs', 1, NULL FROM own WHERE source_ordinal = 1 HAVING count(*) <> 3""")
def reader_problems(spark, sf_dir):
    """A dataset and two evaluation sources, of which one has another count than it declares."""
    own = records.with_metadata(V.records(spark, sf_dir)).withColumn("source_ordinal", (F.col("line_number") % 3).cast("int"))
    again = own.where("line_number % 50 = 7").withColumn("source_ordinal", F.lit(0))
    counted = own.where("source_ordinal = 2").count()
    return records.read_problems(own.unionByName(again), {1: {"research_role": "legacy_test", "record_count": 3}, 2: {"research_role": "holdout", "record_count": counted}})


def _outputs(spark, sf_dir):
    """Outputs as JSON: keys in the output, its metadata and its provenance, some of them null."""
    d = V.table(spark, sf_dir, "documents")
    k, text = F.col("doc_id"), lambda c: F.to_json(F.array(c))  # noqa: E731  JSON text inside brackets
    bare = lambda c: F.substring(text(c), F.lit(2), F.length(text(c)) - 2)
    n = k.cast("string")
    meta = F.when(k % 4 == 0, F.lit("null")).when(k % 4 == 1, F.concat(F.lit('{"recipe":"m'), n, F.lit('","probe_id":"pm","evidence_ids":["a",null,"b","a"]}'))).otherwise(F.lit('{"recipe":null,"knowledge_unit_ids":["k1","k2"]}'))
    prov = F.when(k % 3 == 0, F.lit("{}")).otherwise(F.concat(F.lit('{"recipe":"p'), n, F.lit('","probe_class":"c","document_ids":"'), n, F.lit('"}')))
    extra = F.when(k % 5 == 0, F.lit(',"recipe":"o","knowledge_unit_id":"k2"')).when(k % 5 == 1, F.lit(',"knowledge_unit_id":"k9","probe_id":null')).otherwise("")
    body = F.concat(F.lit('{"record_id":"'), n, F.lit('","prompt":'), bare(F.col("source")), F.lit(',"expected":"e","generated":'), bare(F.substring("text", 1, 1)), F.lit(',"exact_match":true,"metadata":'), meta, F.lit(',"provenance":'), prov, extra, F.lit("}"))
    ids = [F.concat(F.lit(p), n).alias(c) for c, p in zip(pub.IDENTITIES, ("exp-", "tvar-", "trun-", "adp-"))]
    return d.select("doc_id", *ids, body.alias("output"))


@query("""WITH x AS (SELECT doc_id, source, text, CAST(doc_id AS VARCHAR) AS n, doc_id % 4 AS m, doc_id % 3 AS p, doc_id % 5 AS o FROM documents)
SELECT 'trun-' || n AS training_run_id, 'adp-' || n AS adapter_id, n AS dataset_record_id, source AS prompt, 'e' AS expected_answer, substring(text, 1, 1) AS generated_answer, TRUE AS exact_match,
  CASE o WHEN 0 THEN 'k2' WHEN 1 THEN 'k9' END AS knowledge_unit_id,
  CASE WHEN m IN (2, 3) THEN CASE o WHEN 1 THEN 'k9,k1,k2' ELSE 'k1,k2' END ELSE CASE o WHEN 0 THEN 'k2' WHEN 1 THEN 'k9' ELSE '' END END AS units,
  CASE WHEN m = 1 THEN 'a,b' ELSE '' END AS evidence, CASE WHEN p <> 0 THEN n ELSE '' END AS documents,
  CASE WHEN o = 0 THEN 'o' WHEN m = 1 THEN 'm' || n WHEN m IN (2, 3) THEN NULL WHEN p <> 0 THEN 'p' || n END AS recipe,
  CASE WHEN o = 1 THEN NULL WHEN m = 1 THEN 'pm' END AS probe_id, CASE WHEN p <> 0 THEN 'c' END AS probe_class, CAST(29 AS BIGINT) AS n_columns FROM x""")
def prediction_rows(spark, sf_dir):
    rows = pub.prediction_rows(_outputs(spark, sf_dir), "trained")
    joined = lambda c: F.array_join(c, ",")
    return rows.select(
        "training_run_id", "adapter_id", "dataset_record_id", "prompt", "expected_answer", "generated_answer", "exact_match", "knowledge_unit_id", joined("knowledge_unit_ids").alias("units"),
        joined("evidence_ids").alias("evidence"), joined("document_ids").alias("documents"), "recipe", "probe_id", "probe_class", F.lit(len(rows.columns)).cast("long").alias("n_columns"),
    )


def _bundles(spark, sf_dir):
    d = V.table(spark, sf_dir, "documents").select("source", "doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size_bytes"))
    name = F.when(F.col("doc_id") % 90 == 0, F.concat(F.lit("../"), F.col("doc_id").cast("string"))).otherwise(F.col("doc_id").cast("string"))
    return d.select(F.col("source").alias("manifest_uri"), name.alias("path"), "sha256", "size_bytes", "doc_id")


@query("""WITH f AS (SELECT source, doc_id, CASE WHEN doc_id % 90 = 0 THEN '../' ELSE '' END || doc_id AS path FROM documents)
SELECT source AS manifest_uri, 'required_file' AS rule, 'config' AS detail FROM documents GROUP BY source
UNION ALL SELECT source, 'path_escapes', path FROM f WHERE doc_id % 90 = 0 UNION ALL SELECT source, 'file_missing', path FROM f WHERE doc_id % 20 = 1
UNION ALL SELECT source, 'size_differs', path FROM f WHERE doc_id % 20 = 2 UNION ALL SELECT source, 'checksum_differs', path FROM f WHERE doc_id % 20 = 3
UNION ALL SELECT source, 'bundle_differs', 'sha256:other' FROM documents GROUP BY source""")
def bundle_problems(spark, sf_dir):
    """A bundle a source: files that leave it, are missing or differ, and none of the declared checksums."""
    f = _bundles(spark, sf_dir)
    k = F.col("doc_id") % 20
    stored = f.where(k != 1).withColumn("size_bytes", F.when(k == 2, -1).otherwise(F.col("size_bytes"))).withColumn("sha256", F.when(k == 3, "x").otherwise(F.col("sha256")))
    declared = f.select("manifest_uri", F.lit("sha256:other").alias("bundle_checksum")).distinct()
    return pub.bundle_problems(f.drop("doc_id"), stored.drop("doc_id"), declared, ("config",))


@query("""WITH m AS (SELECT c_custkey AS k, 'm' || c_custkey AS uri FROM customer)
SELECT uri AS manifest_uri, 'schema' AS rule, 'old' AS detail FROM m WHERE k % 7 = 0 UNION ALL SELECT uri, 'not_completed', 'running' FROM m WHERE k % 11 = 0
UNION ALL SELECT uri, 'training_run_id_missing', ' ' FROM m WHERE k % 13 = 0 UNION ALL SELECT max(uri), 'adapter_id_repeated', 'adp-' || (k // 2) FROM m GROUP BY k // 2 HAVING count(*) > 1
UNION ALL SELECT uri, 'uri', 'report_uri' FROM m WHERE k % 17 = 0 OR k % 19 = 0 UNION ALL SELECT uri, 'artifact_differs', 'metrics' FROM m WHERE k % 23 = 0""")
def candidate_problems(spark, sf_dir):
    k = F.col("c_custkey")
    c = V.table(spark, sf_dir, "customer")
    m = c.select(
        F.concat(F.lit("m"), k.cast("string")).alias("manifest_uri"), F.when(k % 7 == 0, "old").otherwise("v1").alias("schema_version"), F.when(k % 11 == 0, "running").otherwise("completed").alias("status"),
        F.when(k % 13 == 0, " ").otherwise(F.concat(F.lit("trun-"), k.cast("string"))).alias("training_run_id"), F.concat(F.lit("adp-"), F.floor(k / 2).cast("string")).alias("adapter_id"),
        F.when(k % 17 == 0, "file:/x").when(k % 19 != 0, "storage://p/n/x").alias("report_uri"),
    )
    artifacts = c.select(F.concat(F.lit("m"), k.cast("string")).alias("manifest_uri"), F.lit("metrics").alias("name"), F.lit("sha256:aa").alias("expected"), F.when(k % 23 == 0, "bb").otherwise("aa").alias("actual"))
    return pub.candidate_problems(m, artifacts, "v1", ("report_uri",))


@query("""SELECT source, string_agg(identity, ',' ORDER BY identity) AS identities FROM (SELECT DISTINCT source, '{"lang":' || CASE WHEN doc_id % 4 = 0 THEN 'null' ELSE '"' || lang || '"' END || '}' AS identity FROM documents) GROUP BY 1""")
def distinct_identities(spark, sf_dir):
    d = V.table(spark, sf_dir, "documents").select("source", F.when(F.col("doc_id") % 4 != 0, F.col("lang")).alias("lang"))
    return pub.distinct_identities(d, "lang", keys=("source",)).select("source", F.array_join("identities", ",").alias("identities"))


@query("SELECT p_brand AS model, CAST(sum(p_size * 1000) AS BIGINT) AS total, CAST(coalesce(sum(p_size * 1000) FILTER (WHERE p_partkey % 3 = 0), 0) AS BIGINT) AS trainable FROM part GROUP BY 1")
def parameter_counts(spark, sf_dir):
    p = V.table(spark, sf_dir, "part").select(F.col("p_brand").alias("model"), (F.col("p_size") * 1000).cast("long").alias("elements"), (F.col("p_partkey") % 3 == 0).alias("trainable"))
    return pub.parameter_counts(p)


@query("SELECT source, CAST(sum(strlen(text)) AS BIGINT) AS size_bytes, count(*) AS files FROM documents GROUP BY 1")
def directory_sizes(spark, sf_dir):
    return pub.directory_sizes(V.table(spark, sf_dir, "documents").select("source", F.octet_length("text").cast("long").alias("length")), "source")


@query("""SELECT user_id AS report_id, max(CASE WHEN event_id % 7 <> 0 THEN value END) AS gpu_memory_peak_percent, CASE WHEN user_id % 5 <> 0 THEN CAST(user_id AS DOUBLE) END AS ram_peak_percent FROM events GROUP BY user_id""")
def peak_percentages(spark, sf_dir):
    e = V.table(spark, sf_dir, "events")
    usage = F.collect_list(F.struct(F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("memory_peak_percent")))
    reports = e.groupBy(F.col("user_id").alias("report_id")).agg(usage.alias("gpu_usage")).withColumn("system_usage", F.struct(F.when(F.col("report_id") % 5 != 0, F.col("report_id").cast("double")).alias("system_ram_peak_percent")))
    return pub.peak_percentages(reports)


@query("SELECT DISTINCT 'jreq-' || (doc_id // 2) AS request_id FROM labels ORDER BY 1")
def attempt_rows(spark, sf_dir):
    """Attempts of which each was stored twice."""
    rows = V.table(spark, sf_dir, "labels").select(F.concat(F.lit("jreq-"), F.floor(F.col("doc_id") / 2).cast("string")).alias("request_id"))
    return pub.attempt_rows(rows)


@query("""SELECT 'jreq-' || (doc_id // 3) AS request_id, count(DISTINCT (quality, toxic)) AS contents, count(*) AS "rows" FROM labels WHERE doc_id IS NOT NULL GROUP BY 1 HAVING contents > 1""")
def attempt_conflicts(spark, sf_dir):
    """Requests that were stored up to three times, where what was stored differs."""
    labels = V.table(spark, sf_dir, "labels").where("doc_id is not null")
    rows = labels.select(F.concat(F.lit("jreq-"), F.expr("doc_id div 3").cast("string")).alias("request_id"), "quality", "toxic")
    return pub.conflicting_attempts(rows)


@query(f"""WITH {V.EVIDENCE_SQL} SELECT record_id, string_agg(evidence_id || ':' || content_sha256, ',' ORDER BY pos) AS stored FROM met WHERE content_sha256 IS NOT NULL GROUP BY record_id""")
def stored_evidence(spark, sf_dir):
    from marlstone.operators import evidence

    rec, items = V.evidence(spark, sf_dir)
    r = evidence.resolved(rec, evidence.lookup(items)).where(F.size("resolved_evidence") > 0)
    kept = F.transform(pub.stored_evidence(F.col("resolved_evidence")), lambda e: F.concat_ws(":", e["evidence_id"], e["content_sha256"]))
    return r.select("record_id", F.array_join(kept, ",").alias("stored"))


@query("""SELECT user_id AS run_id, 'baseline' AS phase, event_type AS suite, 'accuracy' AS name, round(avg(value), 6) AS value FROM events GROUP BY ALL
UNION ALL SELECT user_id, 'baseline', event_type, 'records', count(*) FROM events GROUP BY ALL""")
def suite_metrics_backfill(spark, sf_dir):
    e = V.table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.struct(F.round(F.avg("value"), 6).alias("accuracy"), F.count("*").alias("records"), F.lit(True).alias("flag"), F.lit("t").alias("text")).alias("m"))
    suites = e.groupBy(F.col("user_id").alias("run_id")).agg(F.map_from_entries(F.collect_list(F.struct("event_type", "m"))).alias("suite_metrics"))
    report = F.to_json(F.struct(F.struct(F.struct("suite_metrics").alias("baseline")).alias("evaluation")))
    out = pub.suite_rows(suites.select("run_id", report.alias("report")))
    return out.withColumn("value", F.round("value", 6))


@query("""WITH l AS (SELECT coalesce(conv_id // 100, -1) AS part, conv_id, turn, CAST(to_json({'conv_id': conv_id, 'turn': turn, 'role': role, 'text': text}) AS VARCHAR) AS line FROM conversations),
f AS (SELECT part, string_agg(line || chr(10), '' ORDER BY conv_id, turn NULLS FIRST, line) AS body, count(*) AS line_count FROM l GROUP BY part)
SELECT part, sha256(body) AS sha256, sha256(CAST(to_json(body) AS VARCHAR)) AS literal_sha256, CAST(strlen(body) AS BIGINT) AS size_bytes, line_count FROM f""")
def dataset_digests(spark, sf_dir):
    """Conversations written as JSONL datasets (a hundred conversations each), and the digests of what is stored."""
    line = F.to_json(F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"})
    lines = V.table(spark, sf_dir, "conversations").select(F.expr("coalesce(conv_id div 100, -1)").alias("part"), "conv_id", "turn", line.alias("value"))
    folder = checkpoint_location(spark, "datasets")
    lines.repartition("part").sortWithinPartitions("part", "conv_id", "turn", "value").select("part", "value").write.partitionBy("part").option("lineSep", "\n").text(folder)
    found = digests(spark, folder, by_folder=True)
    return found.select(F.regexp_extract("source_uri", "part=([^/]+)$", 1).cast("long").alias("part"), "sha256", "literal_sha256", "size_bytes", "line_count")


@query("""WITH p AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'model_loading' WHEN 1 THEN 'training' ELSE 'post_training' END AS phase, value, CASE WHEN event_id % 4 <> 0 THEN value * 2 END AS since FROM events)
SELECT event_id, 'model_loading_timeout_seconds' AS key, value, 50.0 AS "limit" FROM p WHERE phase = 'model_loading' AND value >= 50
UNION ALL SELECT event_id, 'trial_timeout_seconds', value, 60.0 FROM p WHERE phase = 'training' AND value >= 60 UNION ALL SELECT event_id, 'no_step_progress_timeout_seconds', since, 90.0 FROM p WHERE phase = 'training' AND since >= 90""")
def policy_timeouts(spark, sf_dir):
    e = V.table(spark, sf_dir, "events")
    k = F.col("event_id")
    phase = F.when(k % 3 == 0, "model_loading").when(k % 3 == 1, "training").otherwise("post_training")
    own = e.select("event_id", phase.alias("phase"), F.col("value").alias("phase_seconds"), F.when(k % 4 != 0, F.col("value") * 2).alias("seconds_since_step"))
    return tele.timeouts(own, {"model_loading": 50.0, "training": 60.0, "post_training": None}, 90.0).select("event_id", "key", "value", "limit")


@query(f"""WITH {V.SAMPLES_SQL}, s AS (SELECT *, CAST(event_id AS BIGINT) AS step FROM samples WHERE event_id % 3 = 0), g AS (SELECT *, t - lag(t) OVER (PARTITION BY device ORDER BY t, event_id) AS gap FROM s), n AS (SELECT max(t) AS now FROM samples)
SELECT device, max_by(step, (t, event_id)) AS completed_step, round(coalesce(max(gap), 0), 3) AS longest_step_seconds, round(any_value(now) - max(t), 3) AS seconds_since_step FROM g, n GROUP BY device""")
def step_progress(spark, sf_dir):
    s = V.samples(spark, sf_dir).withColumn("step", F.when(F.col("event_id") % 3 == 0, F.col("event_id")))
    now = s.agg(F.max("t")).first()[0]  # one value
    out = tele.step_progress(s, F.lit(now), "event_id")
    return out.select("device", "completed_step", F.round("longest_step_seconds", 3).alias("longest_step_seconds"), F.round("seconds_since_step", 3).alias("seconds_since_step"))


@query("""SELECT round(max(m), 4) AS gpu_memory_peak_percent, round(max(p), 4) AS gpu_power_peak_watts, round(max(r), 4) AS system_ram_peak_percent
  FROM (SELECT date_trunc('minute', ts) AS t, max(value) AS m, sum(value * 2) AS p, max(value / 2) AS r FROM events GROUP BY 1)""")
def device_peaks(spark, sf_dir):
    v = F.col("value")
    e = V.table(spark, sf_dir, "events").select(F.date_trunc("minute", "ts").alias("t"), v.alias("memory_used_percent"), v.alias("utilization_percent"), v.alias("temperature_celsius"), (v * 2).alias("power_draw_watts"), (v / 2).alias("ram_used_percent"))
    return tele.device_peaks(e).select(*[F.round(c, 4).alias(c) for c in ("gpu_memory_peak_percent", "gpu_power_peak_watts", "system_ram_peak_percent")])


@query("""SELECT model, size FROM (SELECT DISTINCT p_brand AS model FROM part), (SELECT DISTINCT p_size AS size FROM part) ORDER BY model, size LIMIT 25""")
def grid_capped(spark, sf_dir):
    from marlstone.plans.capacity import _grid

    return tr.capped(_grid(spark, sf_dir), 25).select("model", "size")


@query("""WITH e AS (SELECT event_id, value FROM events), x AS (SELECT event_id AS step, unnest(['live.steps', 'live.tokens', 'live.elapsed', 'live.steps_per_second', 'live.tokens_per_second']) AS name,
  unnest([CAST(event_id AS DOUBLE), CASE WHEN event_id % 5 <> 0 THEN value END, CAST(event_id % 7 AS DOUBLE), CASE WHEN event_id % 7 > 0 THEN event_id / (event_id % 7) END, CASE WHEN event_id % 7 > 0 AND event_id % 5 <> 0 THEN value / (event_id % 7) END]) AS value FROM e)
SELECT step, name, round(value, 6) AS value FROM x WHERE value IS NOT NULL""")
def live_metrics(spark, sf_dir):
    k = F.col("event_id")
    e = V.table(spark, sf_dir, "events").select(k.alias("step"), k.alias("steps"), F.lit(None).cast("double").alias("examples"), F.when(k % 5 != 0, F.col("value")).alias("tokens"), (k % 7).cast("double").alias("elapsed"))
    return tele.live_metrics(e).withColumn("value", F.round("value", 6))


@query("""WITH x AS (SELECT CASE WHEN doc_id % 8 <> 0 THEN source END AS s, quality, toxic, CASE WHEN doc_id % 3 = 0 THEN 'set' || (doc_id % 2) END AS id, lang FROM documents JOIN labels USING (doc_id)), y AS (SELECT coalesce(s, 'legacy_evaluation') AS suite, * FROM x)
SELECT suite, grouping(suite) = 1 AS overall, count(*) AS example_count, round(avg(quality), 9) AS exact_match_accuracy, round(avg(toxic), 9) AS contains_expected_accuracy,
  coalesce(array_to_string(list_sort(list_distinct(list(id || '/' || lang) FILTER (WHERE id IS NOT NULL))), ','), '') AS sets FROM y GROUP BY ROLLUP (suite)""")
def suite_report(spark, sf_dir):
    from marlstone.operators import evalagg

    rows = V.table(spark, sf_dir, "documents").join(V.table(spark, sf_dir, "labels"), "doc_id")
    k = F.col("doc_id")
    own = rows.select(
        F.when(k % 8 != 0, F.col("source")).alias("suite"), F.col("quality").alias("exact_match"), F.col("toxic").alias("contains_expected"), F.when(k % 3 == 0, F.concat(F.lit("set"), (k % 2).cast("string"))).alias("evaluation_set_id"), F.col("lang").alias("evaluation_set_version")
    )
    sets = F.array_join(F.transform("evaluation_sets", lambda e: F.concat_ws("/", e["evaluation_set_id"], e["evaluation_set_version"])), ",")
    r = evalagg.suite_report(own)
    return r.select("suite", "overall", "example_count", F.round("exact_match_accuracy", 9).alias("exact_match_accuracy"), F.round("contains_expected_accuracy", 9).alias("contains_expected_accuracy"), sets.alias("sets"))


@query("""SELECT CAST(count(*) // 4 AS BIGINT) AS train_steps, round(avg(value), 6) AS train_loss, CAST(count(*) * 2 AS BIGINT) AS examples_processed, CAST(sum(event_id) AS BIGINT) AS input_tokens_processed, CAST(sum(event_id // 2) AS BIGINT) AS target_tokens_processed, CAST(8 AS BIGINT) AS effective_batch_size FROM events""")
def training_totals(spark, sf_dir):
    e = V.table(spark, sf_dir, "events").select(F.lit(2).cast("long").alias("examples"), F.col("event_id").cast("long").alias("input_tokens"), F.floor(F.col("event_id") / 2).cast("long").alias("target_tokens"), F.col("value").alias("loss"))
    return records.training_totals(e, 2, 4).withColumn("train_loss", F.round("train_loss", 6))


@query("""SELECT event_id, 'step ' || event_id || '/100 | loss ' || printf('%.4f', event_id % 10 / 4) || CASE WHEN event_id % 3 > 0 THEN ' | CPU ' || (event_id % 3) || '%' ELSE '' END || ' | GPU ' || CASE WHEN event_id % 4 > 0 THEN (event_id % 50) || '%' ELSE 'n/a' END AS line FROM events""")
def progress_lines(spark, sf_dir):
    from marlstone.functions.text import progress_line

    k, none = F.col("event_id"), F.lit(None).cast("double")
    line = progress_line(k, F.lit(100), k % 10 / 4, F.when(k % 3 > 0, k % 3), none, F.when(k % 4 > 0, k % 50), none, none)
    return V.table(spark, sf_dir, "events").select("event_id", line.alias("line"))


@query("""WITH u AS (SELECT c_custkey AS k, CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'file:///x' WHEN 2 THEN 'storage://main' WHEN 3 THEN 'storage://main/datasets/../x' WHEN 4 THEN 'storage://main/none/x' WHEN 5 THEN 'storage://other/datasets/x' ELSE 'storage://main/datasets/x' END AS uri FROM customer)
SELECT k, CASE k % 7 WHEN 0 THEN 'missing_uri' WHEN 1 THEN 'unsupported_scheme' WHEN 2 THEN 'malformed_uri' WHEN 3 THEN 'unsafe_key' WHEN 4 THEN 'unknown_namespace' ELSE 'profile_mismatch' END AS category FROM u WHERE k % 7 < 6""")
def uri_failures(spark, sf_dir):
    from marlstone.sources import uris

    k = F.col("c_custkey")
    found = F.when(k % 7 == 1, "file:///x").when(k % 7 == 2, "storage://main").when(k % 7 == 3, "storage://main/datasets/../x").when(k % 7 == 4, "storage://main/none/x").when(k % 7 == 5, "storage://other/datasets/x").when(k % 7 == 6, "storage://main/datasets/x")
    own = V.table(spark, sf_dir, "customer").select(k.alias("k"), found.alias("uri"))
    roles = uris.Storage({"datasets": ("dataset", "main", "/data")}).table(spark)
    return uris.resolved(own, roles).where("failure is not null").select("k", F.col("failure").alias("category"))
