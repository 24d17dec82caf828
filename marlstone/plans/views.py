"""Views of the test tables in the shapes that the operators read (SQL that both engines run)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record a conversation; turns in order; conv_id % 10 picks the split."""
    c = table(spark, sf_dir, "conversations")
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    k = F.col("conv_id") % 10
    split = F.when(k == 0, "test").when(k == 1, "validation").when(k == 2, "eval").when(k == 3, " Train ").otherwise("train")
    own = c.groupBy("conv_id").agg(F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages"))
    return own.select(
        F.col("conv_id").cast("string").alias("record_id"),
        split.alias("split"),
        "messages",
        F.when(k == 4, "holdout").when(k == 5, "training").alias("research_role"),
        F.when(k == 6, False).when(k == 7, True).alias("training_eligible"),
        F.lit(0).alias("source_ordinal"),
        F.col("conv_id").alias("line_number"),
        F.aggregate("messages", F.lit(0), lambda n, m: n + F.char_length(m["content"])).alias("n_tokens"),
    )


RECORDS_SQL = """
r0 AS (SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS messages FROM conversations GROUP BY conv_id),
r1 AS (SELECT CAST(conv_id AS VARCHAR) AS record_id, conv_id AS line_number, messages, conv_id % 10 AS k,
  CASE WHEN conv_id % 10 = 0 THEN 'test' WHEN conv_id % 10 = 1 THEN 'validation' WHEN conv_id % 10 = 2 THEN 'eval' ELSE 'train' END AS raw_split,
  CASE WHEN conv_id % 10 IN (0, 1, 2) THEN 'evaluation' ELSE 'train' END AS split,
  CASE WHEN conv_id % 10 = 0 THEN 'legacy_test' WHEN conv_id % 10 = 1 THEN 'legacy_validation' WHEN conv_id % 10 = 4 THEN 'holdout' WHEN conv_id % 10 = 5 THEN 'training' END AS research_role,
  CASE WHEN conv_id % 10 IN (0, 1, 6) THEN FALSE WHEN conv_id % 10 = 7 THEN TRUE END AS training_eligible,
  CAST(list_sum(list_transform(messages, lambda m: length(m.content))) AS BIGINT) AS n_tokens FROM r0),
records AS (SELECT *, (split = 'train' AND (research_role IS NULL OR research_role = 'training') AND training_eligible IS DISTINCT FROM FALSE) AS trainable FROM r1)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two candidates' predictions on documents, the baseline's on labelled ones, with repeats.

    Answers and expected texts are whole texts; a third of a candidate's has one word more.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    expected = F.col("text")
    key = F.col("doc_id").cast("string").alias("record_id")
    ids = F.explode(F.array(F.lit(0), F.lit(1)))
    base = d.join(labelled, "doc_id").select(ids.alias("c"), key, F.lit("baseline").alias("side"), F.col("text").alias("answer"), expected.alias("expected"), "doc_id")
    cand = d.select("doc_id", "text", key, ids.alias("c"))
    answer = F.when(F.col("doc_id") % 3 == F.col("c"), F.concat(F.col("text"), F.lit(" indeed"))).otherwise(F.concat(F.lit(" "), F.replace(expected, F.lit(" "), F.lit("  "))))
    cand = cand.select("c", "record_id", F.lit("candidate").alias("side"), answer.alias("answer"), expected.alias("expected"), "doc_id")
    both = base.unionByName(cand)
    repeats = F.explode(F.when(F.col("doc_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = both.select(F.concat(F.lit("cand-"), F.col("c").cast("string")).alias("candidate_id"), "record_id", "side", "answer", "expected", repeats.alias("ordinal"))
    return rows.withColumn("canonical", F.sha2(F.concat_ws(chr(31), "record_id", "answer", "expected"), 256))


PREDICTIONS_SQL = """
ids AS (SELECT unnest([0, 1]) AS c),
base AS (SELECT c, CAST(doc_id AS VARCHAR) AS record_id, text AS answer, text AS expected, doc_id FROM documents JOIN labels USING (doc_id), ids),
cand AS (SELECT c, CAST(doc_id AS VARCHAR) AS record_id, CASE WHEN doc_id % 3 = c THEN text || ' indeed' ELSE ' ' || replace(text, ' ', '  ') END AS answer, text AS expected, doc_id FROM documents, ids),
pairs AS (SELECT 'cand-' || coalesce(b.c, k.c) AS candidate_id, coalesce(b.record_id, k.record_id) AS record_id, b.answer AS baseline_answer, k.answer AS candidate_answer,
  coalesce(k.expected, b.expected) AS expected, b.c IS NOT NULL AS has_baseline, k.c IS NOT NULL AS has_candidate,
  coalesce(b.doc_id % 10 = 0, FALSE) AS baseline_duplicate, coalesce(k.doc_id % 10 = 0, FALSE) AS candidate_duplicate
  FROM base b FULL JOIN cand k ON b.c = k.c AND b.record_id = k.record_id)"""


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three candidates judged on overlapping labelled records."""
    own = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k")).where("doc_id % 4 <> k")
    q, t = F.col("quality"), F.col("toxic")
    decision = F.when((q == 1) & (t == 0), "candidate_better").when((q == 1) & (t == 1), "tie").when(t == 0, "baseline_better").otherwise("unjudgeable")
    return own.select(
        F.concat(F.lit("cand-"), F.col("k").cast("string")).alias("candidate_id"),
        F.col("doc_id").cast("string").alias("record_id"),
        decision.alias("decision"),
        (t == 1).alias("regression"),
        F.when(F.col("doc_id") % 5 == 0, "reference-only").otherwise("evidence-grounded").alias("basis"),
        ((F.col("doc_id") % 5) / 4).alias("reference_correctness"),
        ((F.col("doc_id") % 3) / 2).alias("evidence_faithfulness"),
        ((F.col("doc_id") % 8) / 8).alias("latency_seconds"),
        (F.col("doc_id") % 100).alias("prompt_tokens"),
        (F.col("doc_id") % 7).alias("completion_tokens"),
    )


JUDGMENTS_SQL = """
judgments AS (SELECT 'cand-' || k AS candidate_id, CAST(doc_id AS VARCHAR) AS record_id,
  CASE WHEN quality = 1 AND toxic = 0 THEN 'candidate_better' WHEN quality = 1 AND toxic = 1 THEN 'tie' WHEN toxic = 0 THEN 'baseline_better' ELSE 'unjudgeable' END AS decision,
  toxic = 1 AS regression, CASE WHEN doc_id % 5 = 0 THEN 'reference-only' ELSE 'evidence-grounded' END AS basis,
  (doc_id % 5) / 4.0 AS reference_correctness, (doc_id % 3) / 2.0 AS evidence_faithfulness, (doc_id % 8) / 8.0 AS latency_seconds,
  doc_id % 100 AS prompt_tokens, doc_id % 7 AS completion_tokens
  FROM labels, (SELECT unnest([0, 1, 2]) AS k) WHERE doc_id % 4 <> k)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry samples from events: a device a user, seconds since the epoch."""
    e = table(spark, sf_dir, "events")
    t = F.unix_micros(F.col("ts").cast("timestamp")) / 1000000
    return e.select(F.col("user_id").alias("device"), t.alias("t"), "event_id", "event_type", "value", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("watts"))


SAMPLES_SQL = "samples AS (SELECT user_id AS device, epoch_us(ts) / 1000000 AS t, event_id, event_type, value, CASE WHEN event_id % 7 <> 0 THEN value END AS watts FROM events)"


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capacity trials from parts."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        F.concat(F.lit("trial-"), F.lpad(k.cast("string"), 6, "0")).alias("trial_id"),
        F.col("p_brand").alias("model"),
        F.col("p_size").alias("size"),
        F.col("p_type").alias("kind"),
        k.cast("int").alias("trial_number"),
        F.when(k % 5 == 0, "timeout").when(k % 5 == 1, "threshold_reached").otherwise("completed").alias("status"),
        (k % 3 == 0).alias("model_weights_reused"),
        "p_retailprice",
    )


TRIALS_SQL = """
trials AS (SELECT 'trial-' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS trial_id, p_brand AS model, p_size AS size, p_type AS kind, CAST(p_partkey AS INT) AS trial_number,
  CASE WHEN p_partkey % 5 = 0 THEN 'timeout' WHEN p_partkey % 5 = 1 THEN 'threshold_reached' ELSE 'completed' END AS status, p_partkey % 3 = 0 AS model_weights_reused, p_retailprice FROM part)"""


def evidence(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(records with evidence_ids, evidence items)."""
    d = table(spark, sf_dir, "documents")
    rec = d.select(F.col("doc_id").cast("string").alias("record_id"), F.when(F.col("doc_id") % 11 == 0, F.array().cast("array<string>")).otherwise(F.array((F.col("doc_id") % 260).cast("string"), (F.col("doc_id") % 7).cast("string"))).alias("evidence_ids"))
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("evidence_id"), "text")
    return rec, items


EVIDENCE_SQL = """
ids AS (SELECT CAST(doc_id AS VARCHAR) AS record_id, 0 AS pos, CAST(doc_id % 260 AS VARCHAR) AS evidence_id FROM documents WHERE doc_id % 11 <> 0
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 1, CAST(doc_id % 7 AS VARCHAR) FROM documents WHERE doc_id % 11 <> 0),
items AS (SELECT CAST(item_id AS VARCHAR) AS evidence_id, text, sha256(text) AS content_sha256 FROM benchmark),
met AS (SELECT ids.*, content_sha256 FROM ids LEFT JOIN items USING (evidence_id)),
per AS (SELECT CAST(doc_id AS VARCHAR) AS record_id, count(m.evidence_id) AS n_ids, count(content_sha256) AS n_found, count(m.evidence_id) - count(content_sha256) AS n_missing
  FROM documents d LEFT JOIN met m ON m.record_id = CAST(d.doc_id AS VARCHAR) GROUP BY 1)"""
