"""The query catalogue over the test tables: keyed merges, and judgments that survive a kill and a replay."""

from __future__ import annotations

import json
import logging

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryException

from marlstone.operators.judging import DIMENSIONS
from marlstone.plans import views as V
from marlstone.sources.keyed import KeyedTable
from marlstone.streaming import judgments as jd
from marlstone.streaming.live import checkpoint_location

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

_EVIDENCE = T.StructType([T.StructField("evidence_id", T.LongType()), T.StructField("content_sha256", T.StringType()), T.StructField("text", T.StringType())])

_PUTS_SQL = """
brought AS (SELECT 1 AS put, doc_id AS evidence_id, sha256(coalesce(text, '')) AS content FROM documents
  UNION ALL SELECT 2, doc_id * 2, sha256(coalesce(text, '')) FROM documents UNION ALL SELECT 2, doc_id, sha256(coalesce(text, '')) FROM documents),
kept AS (SELECT evidence_id, arg_min(content, (put, content)) AS content FROM brought GROUP BY 1)"""


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def _evidence_puts(spark, sf_dir):
    """A table after two puts (all documents, then all again and all under twice their id), and the second's conflicts."""
    d = V.table(spark, sf_dir, "documents")
    item = lambda key: d.select(key.alias("evidence_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_sha256"), "text")
    stored = KeyedTable(spark, checkpoint_location(spark, "evidence"), _EVIDENCE, ("evidence_id",))
    stored.put(item(F.col("doc_id")), ["content_sha256"])
    return stored, stored.put(item(F.col("doc_id") * 2).unionByName(item(F.col("doc_id"))), ["content_sha256"])


@query(f"WITH {_PUTS_SQL} SELECT evidence_id, content AS content_sha256 FROM kept")
def evidence_put(spark, sf_dir):
    return _evidence_puts(spark, sf_dir)[0].rows().select("evidence_id", "content_sha256")


@query(f"""WITH {_PUTS_SQL} SELECT b.evidence_id, k.content AS stored_sha256, count(DISTINCT b.content) AS contents, count(*) AS "rows"
FROM brought b JOIN kept k USING (evidence_id) WHERE b.put = 2 AND b.content <> k.content GROUP BY ALL""")
def evidence_put_conflicts(spark, sf_dir):
    """What a second put brought for stored keys with another content."""
    stored, conflicts = _evidence_puts(spark, sf_dir)
    now = stored.rows().select("evidence_id", F.col("content_sha256").alias("stored_sha256"))
    return conflicts.groupBy("evidence_id").agg(F.count("*").alias("contents"), F.sum("brought").alias("rows")).join(now, "evidence_id").select("evidence_id", "stored_sha256", "contents", "rows")


@query(f"WITH {_PUTS_SQL}, w AS (SELECT DISTINCT doc_id * 3 AS evidence_id FROM documents) SELECT w.evidence_id, content AS content_sha256 FROM w LEFT JOIN kept k ON k.evidence_id = w.evidence_id")
def evidence_get(spark, sf_dir):
    """Stored evidence of wanted keys, of which some aren't stored."""
    stored = _evidence_puts(spark, sf_dir)[0]
    wanted = V.table(spark, sf_dir, "documents").select((F.col("doc_id") * 3).alias("evidence_id"))
    return stored.get(wanted).select("evidence_id", "content_sha256")


def _verdict(decision: str) -> str:
    side = dict.fromkeys(DIMENSIONS, 0.5)
    return json.dumps({"baseline": side, "candidate": side, "decision": decision, "regression": False, "confidence": 0.5, "rationale": "r", "failure_categories": [], "evidence_sufficiency": "sufficient"})


class _Killed(RuntimeError):
    """Stands for a driver that is lost between a round's requests and its outcomes."""


@query("""WITH p AS (SELECT DISTINCT 'cand-' || (doc_id % 3) AS candidate_id, CAST(doc_id AS VARCHAR) AS record_id, doc_id FROM labels WHERE doc_id IS NOT NULL),
o AS (SELECT *, 0 AS attempt, 'interrupted_judge_attempt' AS reason FROM p
  UNION ALL SELECT *, 1, CASE WHEN doc_id % 10 = 0 THEN 'token_budget_exceeded' WHEN (doc_id + 1) % 3 = 0 THEN 'malformed_judge_response' END FROM p
  UNION ALL SELECT *, 2, NULL FROM p WHERE doc_id % 10 <> 0 AND (doc_id + 1) % 3 = 0)
SELECT candidate_id, record_id, attempt, reason, CASE WHEN reason IS NULL THEN 'tie' END AS decision, 'jreq-' || substring(sha256('run' || chr(31) || candidate_id || chr(31) || record_id || chr(31) || attempt), 1, 24) AS request_id FROM o""")
def judgments_exactly_once(spark, sf_dir):
    """All outcomes of a stream that is killed once after its requests were stored, resumed, and then replayed from the beginning."""
    where = checkpoint_location(spark, "judgments")
    schema = V.table(spark, sf_dir, "labels").schema
    labels = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/labels.parquet*").where("doc_id is not null")
    pairs = labels.select(F.concat(F.lit("cand-"), (F.col("doc_id") % 3).cast("string")).alias("candidate_id"), F.col("doc_id").cast("string").alias("record_id"), F.col("doc_id").cast("string").alias("messages"))

    def answers(asked):
        number = F.col("messages").cast("long")
        over = number % 10 == 0
        text = F.when((number + F.col("attempt")) % 3 == 0, "no JSON").otherwise(_verdict("tie"))
        return asked.select("request_id", F.when(~over, text).alias("response"), F.when(over, "token_budget_exceeded").alias("reason"), F.lit(None).cast("string").alias("detail"))

    def killed(asked):
        raise _Killed

    start = lambda judge, query: jd.judge_stream(pairs, judge, f"{where}/rows", f"{where}/{query}", query, "run").awaitTermination()
    try:
        start(killed, "first")
    except StreamingQueryException:
        logging.getLogger(__name__).info("killed as planned")
    start(answers, "first")
    start(answers, "replay")
    return jd.outcomes(spark, f"{where}/rows").select("candidate_id", "record_id", "attempt", "reason", F.get_json_object("response", "$.decision").alias("decision"), "request_id")
