"""The query catalogue over the test tables: records, predictions, judgments and evidence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import canon, numbers, text
from marlstone.operators import containment, evalagg, evidence, judging, metrics, pairing, records, scoring
from marlstone.plans import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

_NORM = "lower(trim(regexp_replace(coalesce({0}, ''), '\\s+', ' ', 'g')))"


def norm(column: str) -> str:
    return f"replace({_NORM.format(column)}, 'ß', 'ss')"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.with_metadata(V.records(spark, sf_dir))


# --- records ---------------------------------------------------------------------------------


@query(f"WITH {V.RECORDS_SQL} SELECT record_id, split, research_role, training_eligible, CASE WHEN raw_split IN ('test', 'validation') THEN raw_split END AS original_split, CAST(len(messages) AS INT) AS n_messages, trainable FROM records")
def records_normalized(spark, sf_dir):
    r = _records(spark, sf_dir)
    return r.select("record_id", "split", "research_role", "training_eligible", "original_split", F.size("messages").alias("n_messages"), records.is_trainable().alias("trainable"))


@query(f"WITH {V.RECORDS_SQL} SELECT split, count(*) AS n, CAST(count(*) FILTER (WHERE trainable) AS BIGINT) AS trainable FROM records GROUP BY split")
def records_split_counts(spark, sf_dir):
    return _records(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"), F.count_if(records.is_trainable()).alias("trainable"))


@query(f"WITH {V.RECORDS_SQL} SELECT coalesce(research_role, 'legacy_evaluation') AS suite, count(*) AS n FROM records WHERE NOT trainable GROUP BY 1")
def suite_counts(spark, sf_dir):
    return records.suite_counts(_records(spark, sf_dir))


@query(f"""WITH {V.RECORDS_SQL}, s AS (SELECT coalesce(research_role, 'legacy_evaluation') AS suite, count(*) AS n FROM records WHERE NOT trainable GROUP BY 1)
SELECT count(*) AS total_records, count(*) FILTER (WHERE trainable) AS training_records, count(*) FILTER (WHERE NOT trainable) AS evaluation_records, (SELECT string_agg(suite || '=' || n, ',' ORDER BY suite) FROM s) AS suites FROM records""")
def dataset_statistics(spark, sf_dir):
    entries = F.array_sort(F.transform(F.map_entries("suites"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))))
    return records.statistics(_records(spark, sf_dir)).withColumn("suites", F.array_join(entries, ","))


@query(f"WITH {V.RECORDS_SQL} SELECT record_id, line_number FROM records WHERE trainable AND n_tokens <= 3000 ORDER BY line_number LIMIT 25")
def trainable_selection(spark, sf_dir):
    return records.selected_training(_records(spark, sf_dir), "n_tokens", 3000, 25).select("record_id", "line_number")


@query(f"WITH {V.RECORDS_SQL} SELECT record_id, n_tokens FROM records WHERE trainable AND n_tokens > 3000 ORDER BY line_number LIMIT 10")
def skip_samples(spark, sf_dir):
    return records.skip_samples(_records(spark, sf_dir), "n_tokens", 3000).select("record_id", F.col("n_tokens").cast("long").alias("n_tokens"))


@query(f"""WITH {V.RECORDS_SQL} SELECT count(*) AS total_records, count(*) FILTER (WHERE trainable) AS trainable_records, count(*) FILTER (WHERE NOT trainable) AS evaluation_records,
  count(*) FILTER (WHERE trainable AND n_tokens > 3000) AS skipped_overlength, max(CASE WHEN trainable THEN n_tokens END) AS longest_training, max(CASE WHEN NOT trainable THEN n_tokens END) AS longest_evaluation,
  least(count(*) FILTER (WHERE trainable AND n_tokens <= 3000), 30) AS accepted_examples, least(count(*) FILTER (WHERE trainable), 30) AS selected_candidates FROM records""")
def preflight_stats(spark, sf_dir):
    return records.preflight(_records(spark, sf_dir).withColumn("n_tokens", F.col("n_tokens").cast("long")), "n_tokens", 3000, 30)


@query("SELECT CAST(md5(text) AS VARCHAR) AS record_id, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_ids(spark, sf_dir):
    return records.duplicate_ids(V.table(spark, sf_dir, "documents").select(F.md5("text").alias("record_id")))


@query(f"WITH {V.RECORDS_SQL} SELECT record_id, 'no assistant message' AS rule FROM records WHERE NOT list_contains(list_transform(messages, lambda m: m.role), 'assistant')")
def constraint_violations(spark, sf_dir):
    return records.violations(_records(spark, sf_dir))


@query("""SELECT CAST(conv_id AS VARCHAR) AS record_id, max_by(text, turn) FILTER (WHERE role = 'user') AS question, max_by(text, turn) FILTER (WHERE role = 'assistant') AS answer FROM conversations GROUP BY conv_id""")
def last_turn_pairs(spark, sf_dir):
    m = F.col("messages")
    return V.records(spark, sf_dir).select("record_id", records.last_message(m, "user").alias("question"), records.last_message(m, "assistant").alias("answer"))


@query("SELECT CAST(conv_id AS VARCHAR) AS record_id, CAST(sum(length(text)) AS BIGINT) AS n_ids, CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant' AND k > 1), 0) AS BIGINT) AS n_labels FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations) GROUP BY conv_id")
def message_mask_lengths(spark, sf_dir):
    """Code points as tokens; labels only for what assistant turns after the first turn added."""
    r = V.records(spark, sf_dir)
    joined = F.aggregate("messages", F.lit(""), lambda a, m: F.concat(a, m["content"]))
    ends = F.transform("messages", lambda _, i: F.aggregate(F.slice("messages", F.lit(1), i + 1), F.lit(0), lambda n, m: n + F.char_length(m["content"])))
    ids = F.transform(F.sequence(F.lit(1), F.char_length(joined)), lambda i: i)
    labels = records.prefix_labels(ends, F.transform("messages", lambda m: m["role"]), ids)
    return r.select("record_id", F.size(ids).cast("long").alias("n_ids"), F.size(F.filter(labels, lambda x: x != -100)).cast("long").alias("n_labels"))


@query("""WITH x AS (SELECT conv_id // 4 AS batch_id, conv_id, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT batch_id, conv_id, CAST(max(n) OVER (PARTITION BY batch_id) AS BIGINT) AS padded, CAST(n AS BIGINT) AS kept FROM x""")
def batch_padding(spark, sf_dir):
    c = V.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.col("turn").cast("int"))).alias("input_ids"))
    b = c.withColumn("batch_id", F.floor(F.col("conv_id") / 4)).withColumn("labels", F.col("input_ids"))
    out = records.padded(b, pad=-1)
    return out.select("batch_id", "conv_id", F.size("input_ids").cast("long").alias("padded"), F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("long").alias("kept"))


@query("""WITH x AS (SELECT conv_id, turn, role FROM conversations) SELECT CAST(count(DISTINCT conv_id) AS BIGINT) AS examples, CAST(count(*) AS BIGINT) AS input_tokens, CAST(count(*) FILTER (WHERE role = 'assistant') AS BIGINT) AS target_tokens FROM x""")
def training_counters(spark, sf_dir):
    c = V.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role")).alias("x"))
    ids = F.transform("x", lambda m: m["turn"].cast("int"))
    own = c.select(ids.alias("input_ids"), records.masked_labels(ids, F.transform("x", lambda m: (m["role"] == "assistant").cast("int"))).alias("labels"))
    return records.token_totals(own)


# --- predictions -----------------------------------------------------------------------------


@query(f"WITH {V.PREDICTIONS_SQL} SELECT candidate_id, record_id, md5(baseline_answer) AS baseline_md5, md5(candidate_answer) AS candidate_md5, has_baseline, has_candidate, baseline_duplicate, candidate_duplicate FROM pairs")
def pair_full_outer(spark, sf_dir):
    p = V.predictions(spark, sf_dir)
    out = pairing.pair_full_outer(p.where("side = 'baseline'"), p.where("side = 'candidate'"))
    return out.select("candidate_id", "record_id", F.md5("baseline_answer").alias("baseline_md5"), F.md5("candidate_answer").alias("candidate_md5"), "has_baseline", "has_candidate", "baseline_duplicate", "candidate_duplicate")


@query(f"WITH {V.PREDICTIONS_SQL} SELECT candidate_id, record_id, md5(baseline_answer) AS baseline_md5, md5(candidate_answer) AS candidate_md5, has_baseline, has_candidate FROM pairs")
def pair_pivot(spark, sf_dir):
    out = pairing.pair_pivot(V.predictions(spark, sf_dir))
    return out.select("candidate_id", "record_id", F.md5("baseline_answer").alias("baseline_md5"), F.md5("candidate_answer").alias("candidate_md5"), "has_baseline", "has_candidate")


@query(f"""WITH {V.PREDICTIONS_SQL} SELECT candidate_id, count(*) AS record_count, count(*) FILTER (WHERE has_baseline AND has_candidate) AS paired_count, count(*) FILTER (WHERE NOT has_baseline) AS missing_baseline_count,
  count(*) FILTER (WHERE NOT has_candidate) AS missing_candidate_count, count(*) FILTER (WHERE baseline_duplicate) AS duplicate_baseline_count, count(*) FILTER (WHERE candidate_duplicate) AS duplicate_candidate_count FROM pairs GROUP BY 1""")
def pair_summary(spark, sf_dir):
    return pairing.summary(pairing.pair_pivot(V.predictions(spark, sf_dir)))


@query(f"""WITH {V.PREDICTIONS_SQL} SELECT candidate_id, record_id, CASE WHEN NOT has_baseline THEN 'baseline' WHEN NOT has_candidate THEN 'candidate' END AS missing, baseline_duplicate, candidate_duplicate
  FROM pairs WHERE NOT has_baseline OR NOT has_candidate OR baseline_duplicate OR candidate_duplicate""")
def pair_issues(spark, sf_dir):
    return pairing.issues(pairing.pair_pivot(V.predictions(spark, sf_dir)))


@query("SELECT source AS candidate_id, lang AS record_id, 'candidate' AS side FROM documents GROUP BY source, lang HAVING count(DISTINCT n_chars) > 1")
def dedup_conflicts(spark, sf_dir):
    d = V.table(spark, sf_dir, "documents")
    p = d.select(F.col("source").alias("candidate_id"), F.col("lang").alias("record_id"), F.lit("candidate").alias("side"), F.col("doc_id").alias("ordinal"), F.lit("").alias("answer"), F.lit("").alias("expected"), F.col("n_chars").cast("string").alias("canonical"))
    return pairing.conflicts(p)


_SCORED = f"""scored AS (SELECT *, coalesce({norm('expected')} <> '' AND {norm('baseline_answer')} = {norm('expected')}, FALSE) AS base_exact, coalesce({norm('expected')} <> '' AND {norm('candidate_answer')} = {norm('expected')}, FALSE) AS cand_exact,
  {norm('expected')} <> '' AND contains({norm('candidate_answer')}, {norm('expected')}) AS cand_contains, {norm('baseline_answer')} <> {norm('candidate_answer')} AS changed FROM pairs)"""


@query(f"""WITH {V.PREDICTIONS_SQL}, {_SCORED} SELECT candidate_id, record_id, base_exact, cand_exact, cand_contains, changed, {norm('baseline_answer')} = '' AS base_empty,
  CAST(length(coalesce(candidate_answer, '')) AS BIGINT) AS cand_chars FROM scored""")
def det_scores(spark, sf_dir):
    r = scoring.deterministic_results(pairing.pair_pivot(V.predictions(spark, sf_dir)))
    return r.select(
        "candidate_id", "record_id", F.col("baseline.normalized_exact_match").alias("base_exact"), F.col("candidate.normalized_exact_match").alias("cand_exact"),
        F.col("candidate.expected_answer_containment").alias("cand_contains"), F.col("answer_changed").alias("changed"), F.col("baseline.empty_answer").alias("base_empty"), F.col("candidate.response_characters").alias("cand_chars"),
    )


@query(f"""WITH {V.PREDICTIONS_SQL}, {_SCORED} SELECT candidate_id, record_id, CASE WHEN cand_exact <> (candidate_answer = expected) THEN 'exact_match_mismatch' ELSE '' END AS warnings FROM scored WHERE has_candidate""")
def det_integrity_warnings(spark, sf_dir):
    p = pairing.pair_pivot(V.predictions(spark, sf_dir)).where("has_candidate")
    a, e = F.col("candidate_answer"), F.col("expected")
    w = scoring.integrity_warnings({"exact_match": a == e}, {"exact_match": text.exact_match(a, e)})
    return p.select("candidate_id", "record_id", F.array_join(w, ",").alias("warnings"))


@query(r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]')) AS BIGINT) AS n_tokens,
  CAST(length(text) AS BIGINT) AS n_characters, CAST(greatest(1, length(text) // 3) + 512 AS BIGINT) AS budget FROM documents""")
def token_estimates(spark, sf_dir):
    d = V.table(spark, sf_dir, "documents")
    return d.select("doc_id", text.token_estimate(F.col("text")).alias("n_tokens"), text.characters(F.col("text")).alias("n_characters"), text.char_budget_tokens(F.char_length("text")).alias("budget"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 1 THEN json_valid(props) WHEN 2 THEN json_valid(props) AND json_type(CASE WHEN json_valid(props) THEN props END) = 'OBJECT' WHEN 3 THEN trim(props) <> '' END AS valid FROM events""")
def format_validity(spark, sf_dir):
    e = V.table(spark, sf_dir, "events")
    need = F.when(F.col("event_id") % 4 == 0, F.lit(None)).when(F.col("event_id") % 4 == 1, "json").when(F.col("event_id") % 4 == 2, "json_object").otherwise("text")
    return e.select("event_id", canon.format_valid(F.col("props"), need).alias("valid"))


@query(f"WITH d AS (SELECT doc_id, {norm('text')} AS t FROM documents), b AS (SELECT item_id, {norm('text')} AS t FROM benchmark) SELECT doc_id, item_id FROM d, b WHERE b.t <> '' AND contains(d.t, b.t)")
def answer_containment(spark, sf_dir):
    """Every document against every item."""
    return containment.contained(V.table(spark, sf_dir, "documents"), V.table(spark, sf_dir, "benchmark"))


@query(f"WITH {V.PREDICTIONS_SQL} SELECT max(greatest(1, (length(coalesce(baseline_answer, '')) + length(coalesce(candidate_answer, ''))) // 3) + 512) AS max_input_tokens FROM pairs")
def estimated_input_tokens(spark, sf_dir):
    p = pairing.pair_pivot(V.predictions(spark, sf_dir))
    return evalagg.max_input_tokens(p, text.characters(F.col("baseline_answer")) + text.characters(F.col("candidate_answer")))


# --- evidence --------------------------------------------------------------------------------


def _resolved(spark, sf_dir):
    rec, items = V.evidence(spark, sf_dir)
    return rec, evidence.resolved(rec, evidence.lookup(items))


@query(f"""WITH {V.EVIDENCE_SQL} SELECT record_id, coalesce(string_agg(evidence_id, ',' ORDER BY pos) FILTER (WHERE content_sha256 IS NOT NULL), '') AS found, coalesce(string_agg(evidence_id, ',' ORDER BY pos) FILTER (WHERE content_sha256 IS NULL), '') AS missing FROM met GROUP BY record_id
  UNION ALL SELECT CAST(doc_id AS VARCHAR), '', '' FROM documents WHERE doc_id % 11 = 0""")
def evidence_found_missing(spark, sf_dir):
    _, r = _resolved(spark, sf_dir)
    return r.select("record_id", F.array_join(F.transform("resolved_evidence", lambda x: x["evidence_id"]), ",").alias("found"), F.array_join("missing_evidence_ids", ",").alias("missing"))


@query(f"""WITH {V.EVIDENCE_SQL} SELECT record_id, CASE WHEN n_ids > 0 AND n_found > 0 AND n_missing = 0 THEN 'evidence-grounded' ELSE 'reference-only' END AS basis_reference,
  CASE WHEN n_ids > 0 AND n_found > 0 AND n_missing = 0 THEN 'evidence-grounded' ELSE 'unjudgeable' END AS basis_strict FROM per""")
def evidence_basis(spark, sf_dir):
    rec, r = _resolved(spark, sf_dir)
    found, missing = F.size("resolved_evidence"), F.size("missing_evidence_ids")
    return r.select("record_id", evidence.basis(found + missing, found, missing, "reference-only").alias("basis_reference"), evidence.basis(found + missing, found, missing, "unjudgeable").alias("basis_strict"))


@query(f"WITH {V.EVIDENCE_SQL} SELECT DISTINCT evidence_id FROM ids ANTI JOIN items USING (evidence_id)")
def evidence_anti(spark, sf_dir):
    rec, items = V.evidence(spark, sf_dir)
    return evidence.unresolved_ids(rec.select(F.explode("evidence_ids").alias("evidence_id")).distinct(), items)


@query(f"WITH {V.EVIDENCE_SQL} SELECT DISTINCT evidence_id FROM ids SEMI JOIN items USING (evidence_id)")
def evidence_semi(spark, sf_dir):
    rec, items = V.evidence(spark, sf_dir)
    return evidence.resolved_ids(rec.select(F.explode("evidence_ids").alias("evidence_id")).distinct(), items)


@query(f"""WITH {V.EVIDENCE_SQL} SELECT 'cand-' || (CAST(record_id AS BIGINT) % 3) AS candidate_id, count(*) AS records, CAST(sum(n_found) AS BIGINT) AS resolved, CAST(sum(n_missing) AS BIGINT) AS missing, bool_and(n_missing = 0) AS all_resolvable FROM per GROUP BY 1""")
def evidence_summary(spark, sf_dir):
    _, r = _resolved(spark, sf_dir)
    own = r.select(F.concat(F.lit("cand-"), (F.col("record_id").cast("long") % 3).cast("string")).alias("candidate_id"), F.size("resolved_evidence").alias("n_found"), F.size("missing_evidence_ids").alias("n_missing"))
    return evidence.summary(own)


@query("SELECT CAST(item_id % 7 AS VARCHAR) AS evidence_id, CAST(count(DISTINCT sha256(text)) AS BIGINT) AS contents FROM benchmark GROUP BY 1 HAVING count(DISTINCT sha256(text)) > 1")
def evidence_conflicts(spark, sf_dir):
    """Items under too few ids, so that ids come with different contents."""
    b = V.table(spark, sf_dir, "benchmark").select((F.col("item_id") % 7).cast("string").alias("evidence_id"), "text")
    return evidence.conflicting(b)


# --- judgments and candidates ------------------------------------------------------------------


def _judge_json(spark, sf_dir):
    j = V.table(spark, sf_dir, "labels")
    score = F.when(F.col("doc_id") % 9 == 0, "1.5").when(F.col("doc_id") % 9 == 1, "true").otherwise("0.5")
    side = F.concat(F.lit("{"), F.array_join(F.transform(F.array(*[F.lit(d) for d in judging.DIMENSIONS]), lambda d: F.concat(F.lit('"'), d, F.lit('":'), score)), ","), F.lit("}"))
    decision = F.when(F.col("doc_id") % 9 == 2, "maybe").otherwise("tie")
    body = F.concat(F.lit('{"baseline":'), side, F.lit(',"candidate":'), side, F.lit(',"decision":"'), decision, F.lit('","regression":'), F.when(F.col("doc_id") % 9 == 3, '"no"').otherwise("false"),
                    F.lit(',"confidence":'), F.when(F.col("doc_id") % 9 == 4, "-1").otherwise("1"), F.lit(',"rationale":"'), F.when(F.col("doc_id") % 9 == 5, " ").otherwise("ok"), F.lit('","evidence_sufficiency":"sufficient"}'))
    return j.select("doc_id", F.when(F.col("doc_id") % 9 == 6, "[1]").when(F.col("doc_id") % 9 == 7, "{").otherwise(body).alias("response"))


@query("""SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN 'baseline.reference_correctness: not a share' WHEN 1 THEN 'baseline.reference_correctness: not a number' WHEN 2 THEN 'decision: unknown' WHEN 3 THEN 'regression: not a boolean'
  WHEN 4 THEN 'confidence: not a share' WHEN 5 THEN 'rationale: empty' WHEN 6 THEN 'response: not a JSON object' WHEN 7 THEN 'response: not a JSON object' END AS error FROM labels""")
def judge_validation(spark, sf_dir):
    return _judge_json(spark, sf_dir).select("doc_id", judging.judgment_error(F.col("response")).alias("error"))


_JUDGED = """judged AS (SELECT candidate_id, count(*) AS judged, round(avg(reference_correctness), 9) AS correctness, round(avg(evidence_faithfulness), 9) AS faithfulness, round(avg((decision = 'candidate_better')::INT), 9) AS win, round(avg((decision = 'baseline_better')::INT), 9) AS lose,
  round(avg((decision = 'tie')::INT), 9) AS tie, round(avg(regression::INT), 9) AS regression, round(avg((decision = 'unjudgeable')::INT), 9) AS unjudgeable, round(avg((basis = 'evidence-grounded')::INT), 9) AS grounded, round(avg(latency_seconds), 9) AS latency,
  CAST(sum(prompt_tokens) AS BIGINT) AS input_tokens, CAST(sum(completion_tokens) AS BIGINT) AS output_tokens FROM judgments GROUP BY 1)"""


@query(f"WITH {V.JUDGMENTS_SQL}, {_JUDGED} SELECT * FROM judged")
def judge_rates(spark, sf_dir):
    m = evalagg.judgment_metrics(V.judgments(spark, sf_dir))
    r = lambda c, n: F.round(c, 9).alias(n)
    return m.select("candidate_id", "judged", r("judge_reference_correctness_mean", "correctness"), r("judge_evidence_faithfulness_mean", "faithfulness"), r("candidate_win_rate", "win"), r("baseline_win_rate", "lose"), r("tie_rate", "tie"),
                    r("regression_rate", "regression"), r("unjudgeable_rate", "unjudgeable"), r("evidence_grounded_coverage", "grounded"), r("average_latency_seconds", "latency"), "input_tokens", "output_tokens")


def _metrics(spark, sf_dir):
    results = scoring.deterministic_results(pairing.pair_pivot(V.predictions(spark, sf_dir)))
    rejected = V.judgments(spark, sf_dir).where("latency_seconds = 0.875").select("candidate_id")
    return evalagg.aggregate_candidates(results, V.judgments(spark, sf_dir), rejected)


_METRICS = f"""WITH {V.PREDICTIONS_SQL}, {_SCORED}, {V.JUDGMENTS_SQL}, {_JUDGED},
det AS (SELECT candidate_id, count(*) AS record_count, count(*) FILTER (WHERE has_baseline AND has_candidate) AS paired, count(*) FILTER (WHERE has_baseline AND has_candidate AND cand_exact) AS ce, count(*) FILTER (WHERE has_baseline AND has_candidate AND base_exact) AS be FROM scored GROUP BY 1),
rej AS (SELECT candidate_id, count(*) AS rejected FROM judgments WHERE latency_seconds = 0.875 GROUP BY 1),
m AS (SELECT candidate_id, record_count, paired, round(paired / record_count, 9) AS coverage, round(ce / paired, 9) AS accuracy, round(be / paired, 9) AS baseline_accuracy, round(ce / paired - be / paired, 9) AS delta, ce < be AS deterministic_regression,
  coalesce(win, 0) AS win_rate, coalesce(regression, 0) AS regression_rate, coalesce(unjudgeable, 1) AS unjudgeable_rate, correctness, faithfulness, round(coalesce(rejected, 0) / (coalesce(judged, 0) + coalesce(rejected, 0)), 9) AS invalid_rate
  FROM det LEFT JOIN judged USING (candidate_id) LEFT JOIN rej USING (candidate_id))"""


@query(_METRICS + " SELECT * FROM m")
def candidate_aggregate(spark, sf_dir):
    r = lambda c, n: F.round(c, 9).alias(n)
    return _metrics(spark, sf_dir).select("candidate_id", "record_count", F.col("paired_record_count").alias("paired"), r("record_coverage", "coverage"), r("deterministic_accuracy", "accuracy"), r("baseline_deterministic_accuracy", "baseline_accuracy"),
        r("paired_exact_match_delta", "delta"), "deterministic_regression", r("candidate_win_rate", "win_rate"), r("regression_rate", "regression_rate"), r("unjudgeable_rate", "unjudgeable_rate"), r("judge_reference_correctness_mean", "correctness"),
        r("judge_evidence_faithfulness_mean", "faithfulness"), r("invalid_judge_response_rate", "invalid_rate"))


@query(_METRICS + """, g AS (SELECT candidate_id, ['minimum_record_coverage' , 'minimum_candidate_win_rate', 'maximum_regression_rate', 'minimum_reference_correctness', 'minimum_evidence_faithfulness', 'maximum_unjudgeable_rate', 'require_deterministic_non_regression'] AS names,
  [coverage >= 0.3, win_rate >= 0.5, regression_rate <= 0.5, coalesce(correctness >= 0.75, FALSE), coalesce(faithfulness >= 0.75, FALSE), unjudgeable_rate <= 0.1, NOT deterministic_regression] AS ok, coverage, unjudgeable_rate FROM m),
f AS (SELECT candidate_id, coverage, unjudgeable_rate, list_sort(list_filter(list_transform(range(1, 8), lambda i: CASE WHEN NOT ok[i] THEN names[i] END), lambda x: x IS NOT NULL)) AS failed FROM g)
SELECT candidate_id, array_to_string(failed, ',') AS failed_gates, CASE WHEN coverage = 0 OR unjudgeable_rate = 1 THEN 'insufficient_evidence' WHEN len(failed) > 0 THEN 'not_recommended' ELSE 'manual_review_required' END AS recommendation FROM f""")
def gate_recommendation(spark, sf_dir):
    r = evalagg.recommendations(_metrics(spark, sf_dir), {"minimum_record_coverage": 0.3, "minimum_candidate_win_rate": 0.5, "maximum_regression_rate": 0.5})
    return r.select("candidate_id", F.array_join("failed_gates", ",").alias("failed_gates"), "recommendation")


@query(f"""WITH {V.JUDGMENTS_SQL}, c AS (SELECT * FROM (VALUES ('cand-0', 0), ('cand-1', 1), ('cand-2', 2), ('cand-9', 3)) t(candidate_id, ordinal)),
n AS (SELECT c.candidate_id, ordinal, count(j.record_id) AS n FROM c LEFT JOIN judgments j USING (candidate_id) GROUP BY 1, 2)
SELECT l.candidate_id AS left_id, r.candidate_id AS right_id, (SELECT count(*) FROM judgments a JOIN judgments b USING (record_id) WHERE a.candidate_id = l.candidate_id AND b.candidate_id = r.candidate_id) AS shared,
  CASE WHEN greatest(l.n, r.n) = 0 THEN 1.0 ELSE round((SELECT count(*) FROM judgments a JOIN judgments b USING (record_id) WHERE a.candidate_id = l.candidate_id AND b.candidate_id = r.candidate_id) / greatest(l.n, r.n), 9) END AS overlap
FROM n l JOIN n r ON l.ordinal < r.ordinal""")
def candidate_overlap(spark, sf_dir):
    c = spark.createDataFrame([("cand-0", 0), ("cand-1", 1), ("cand-2", 2), ("cand-9", 3)], "candidate_id string, ordinal int")
    return evalagg.overlaps(V.judgments(spark, sf_dir), c).withColumn("overlap", F.round("overlap", 9))


@query(_METRICS + " SELECT candidate_id, CAST(row_number() OVER (ORDER BY win_rate DESC, accuracy DESC, candidate_id) AS INT) AS place FROM m")
def candidate_ranking(spark, sf_dir):
    from pyspark.sql import Window

    m = _metrics(spark, sf_dir).withColumn("ordinal", F.col("candidate_id"))
    order = [F.round("candidate_win_rate", 9).desc(), F.round("deterministic_accuracy", 9).desc(), F.asc("ordinal")]
    return evalagg.ranking(m).select("candidate_id", F.row_number().over(Window.orderBy(*order)).alias("place"))  # a row a candidate


@query(f"WITH {V.PREDICTIONS_SQL}, {V.JUDGMENTS_SQL} SELECT candidate_id, record_id FROM pairs p WHERE NOT EXISTS (SELECT 1 FROM judgments j WHERE j.candidate_id = p.candidate_id AND j.record_id = p.record_id)")
def resume_remaining(spark, sf_dir):
    p = pairing.pair_pivot(V.predictions(spark, sf_dir)).select("candidate_id", "record_id")
    return judging.remaining(p, V.judgments(spark, sf_dir).select("candidate_id", "record_id"))


@query("""WITH p AS (SELECT doc_id, doc_id % 4 AS k FROM labels), a AS (SELECT doc_id, unnest(range(0, k)) AS attempt, k FROM p),
u AS (SELECT doc_id, count(*) AS used, count(*) FILTER (WHERE (doc_id + attempt) % 3 <> 0) AS interrupted, coalesce(bool_or((doc_id + attempt) % 3 = 0 AND doc_id % 10 = 0), FALSE) AS over_budget FROM a GROUP BY 1)
SELECT 'c' AS candidate_id, CAST(p.doc_id AS VARCHAR) AS record_id, CAST(coalesce(used, 0) AS INT) AS next_attempt, coalesce(over_budget, FALSE) OR coalesce(used, 0) > 2 AS terminal, coalesce(interrupted, 0) AS interrupted FROM p LEFT JOIN u USING (doc_id)""")
def next_attempt(spark, sf_dir):
    p = V.table(spark, sf_dir, "labels").select(F.lit("c").alias("candidate_id"), F.col("doc_id").cast("string").alias("record_id"), "doc_id")
    k = (F.col("doc_id") % 4).cast("int")
    a = p.select("*", F.explode(F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>"))).alias("attempt"))
    rejected = a.where((F.col("doc_id") + F.col("attempt")) % 3 == 0).withColumn("reason", F.when(F.col("doc_id") % 10 == 0, "token_budget_exceeded").otherwise("malformed_judge_response"))
    return judging.attempt_state(p, a, rejected, 2)


@query("SELECT source AS suite, count(*) AS n, round(avg(quality), 9) AS accuracy FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def suite_accuracy(spark, sf_dir):
    return suite_accuracy_rollup(spark, sf_dir).where("not overall").drop("overall")


@query("SELECT source AS suite, grouping(source) = 1 AS overall, count(*) AS n, round(avg(quality), 9) AS accuracy FROM documents JOIN labels USING (doc_id) GROUP BY ROLLUP (source)")
def suite_accuracy_rollup(spark, sf_dir):
    rows = V.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("suite")).join(V.table(spark, sf_dir, "labels"), "doc_id").select("suite", F.col("quality").alias("correct"))
    return evalagg.suite_accuracy(rows).withColumn("accuracy", F.round("accuracy", 9))


@query("WITH x AS (SELECT source AS suite, avg(quality) AS q, avg(1 - toxic) AS t FROM documents JOIN labels USING (doc_id) GROUP BY 1) SELECT suite, round(t - q, 9) AS delta FROM x")
def metric_delta(spark, sf_dir):
    rows = V.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("suite")).join(V.table(spark, sf_dir, "labels"), "doc_id")
    acc = lambda c: rows.groupBy("suite").agg(F.count("*").alias("n"), F.avg(c).alias("accuracy"))
    return evalagg.deltas(acc(F.col("quality")), acc(1 - F.col("toxic"))).withColumn("delta", F.round("delta", 9))


# --- identities, hashes, metrics -----------------------------------------------------------------


@query("SELECT doc_id, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS size_bytes FROM documents")
def content_hashes(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size_bytes"))


@query("""SELECT doc_id, 'adp-' || substring(sha256(source || chr(31) || doc_id), 1, 24) AS adapter_id, 'jreq-' || substring(sha256(source || chr(31) || lang || chr(31) || doc_id || chr(31) || '0'), 1, 24) AS request_id,
  'tvar-' || substring(sha256(text), 1, 20) AS variant_id, sha256(lang || chr(31) || doc_id) AS row_key FROM documents""")
def derived_ids(spark, sf_dir):
    c = F.col
    return V.table(spark, sf_dir, "documents").select("doc_id", canon.adapter_id(c("source"), c("doc_id")).alias("adapter_id"), canon.request_id(c("source"), c("lang"), c("doc_id"), F.lit(0)).alias("request_id"),
        canon.variant_id(c("text")).alias("variant_id"), canon.row_key(c("lang"), c("doc_id")).alias("row_key"))


def _files(spark, sf_dir):
    d = V.table(spark, sf_dir, "documents")
    return d.select("source", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size_bytes"), "doc_id")


@query("""SELECT source, sha256('[' || string_agg('{"path":"' || path || '","sha256":"' || sha || '","size_bytes":' || size || '}', ',' ORDER BY path) || ']') AS checksum, count(*) AS files
  FROM (SELECT source, source || '/' || doc_id AS path, sha256(text) AS sha, strlen(text) AS size FROM documents) GROUP BY source""")
def bundle_checksum(spark, sf_dir):
    return metrics.bundle_checksum(_files(spark, sf_dir), "source")


@query("SELECT source || '/' || doc_id AS path, CASE doc_id % 20 WHEN 0 THEN 'missing' WHEN 1 THEN 'unexpected' WHEN 2 THEN 'size' ELSE 'sha256' END AS why FROM documents WHERE doc_id % 20 < 4")
def checksum_mismatch(spark, sf_dir):
    f, k = _files(spark, sf_dir), F.col("doc_id") % 20
    expected = f.where(k != 1).withColumn("size_bytes", F.when(k == 2, 0).otherwise(F.col("size_bytes")))
    actual = f.where(k != 0).withColumn("sha256", F.when(k == 3, "x").otherwise(F.col("sha256")))
    return metrics.checksum_mismatches(expected, actual)


@query("SELECT lang AS value, min(doc_id) AS first_at FROM documents GROUP BY lang")
def ordered_distinct(spark, sf_dir):
    return metrics.ordered_distinct(V.table(spark, sf_dir, "documents").select(F.col("lang").alias("value"), "doc_id"), "value", "doc_id")


@query("SELECT event_id, 'run.metrics.value' AS name, value FROM events UNION ALL SELECT event_id, 'run.user', CAST(user_id AS DOUBLE) FROM events")
def metric_flatten(spark, sf_dir):
    e = V.table(spark, sf_dir, "events")
    body = F.to_json(F.struct(F.struct(F.struct("value", F.lit(True).alias("flag")).alias("metrics"), F.col("user_id").alias("user"), F.array(F.lit(1)).alias("list"), F.col("event_type").alias("type")).alias("run")))
    return metrics.metric_values(metrics.flattened(e.select("event_id", body.alias("body")), "event_id", "body"))


@query(r"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '<redacted>' ELSE url END AS value, 'https://host/p?token=%3Credacted%3E&page=' || page_id AS uri FROM pages""")
def redaction(spark, sf_dir):
    p = V.table(spark, sf_dir, "pages")
    key = F.when(F.col("page_id") % 3 == 0, "db_password").otherwise("url")
    uri = F.concat(F.lit("https://me:pw@host/p?token=abc"), F.lit("&page="), F.col("page_id").cast("string"))
    return p.select("page_id", text.redacted(key, F.col("url")).alias("value"), text.redacted_uri(uri).alias("uri"))


@query("SELECT doc_id, n_chars AS before, n_chars + 1 AS after FROM documents WHERE doc_id % 4 = 0")
def override_diff(spark, sf_dir):
    d = V.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("name"), F.col("n_chars").alias("value"))
    changed = d.withColumn("value", F.when(F.col("name") % 4 == 0, F.col("value") + 1).otherwise(F.col("value")))
    return metrics.override_diff(d, changed).withColumnRenamed("name", "doc_id")


@query("SELECT doc_id, CASE WHEN n_chars % 5 > 0 THEN round(n_chars / (n_chars % 5), 9) ELSE 0 END AS ratio, TRY_CAST(trim(lang) AS DOUBLE) AS number FROM documents")
def guarded_numbers(spark, sf_dir):
    d = V.table(spark, sf_dir, "documents")
    return d.select("doc_id", F.round(numbers.ratio(F.col("n_chars"), F.col("n_chars") % 5), 9).alias("ratio"), numbers.number(F.col("lang")).alias("number"))
