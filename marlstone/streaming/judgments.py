"""Judgments of streamed pairs, each request answered once whatever is killed and repeated.

A batch of pairs (candidate_id, record_id, messages) is judged in rounds. A round takes the next unused
attempt of every pair that has no result and isn't given up, and writes

1. its requests, committed by one rename, before the judge is asked;
2. their outcomes (a response, or a reason and detail), committed by one rename, after all were answered.

Both lie in folders named by query, batch and round; what a folder doesn't show in its place doesn't exist.
If the driver or an executor is lost between 1 and 2, the stream brings the batch again: the open round
gets ``interrupted_judge_attempt`` as the outcome of all its requests, whose attempts are spent, and the
next round goes on. If it is lost after 2, the batch finds its pairs settled. Another query that reads
the same pairs (a replay from the beginning) finds them settled too. So each request has one outcome,
and each pair at most one response.

Scale: nothing is collected but the question whether a round has rows. Pairs are joined with the keys of
earlier requests and outcomes; their texts are not read. A batch needs at most ``max_retries`` + 2 rounds.

Defined cases: pairs that a batch holds twice are judged once, with the least ``messages``; null
``messages`` are an empty text; pairs with a null key are settled as ``missing_key`` without a request
(their attempt is 0); an empty batch does nothing. One query at a time may judge a set of pairs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import canon
from marlstone.operators import judging
from marlstone.sources import sinks

KEYS = ["candidate_id", "record_id"]
_PLACE = "query string, batch long, round int"
_REQUEST = "request_id string, candidate_id string, record_id string, attempt int"
_OUTCOME = f"{_REQUEST}, response string, reason string, detail string"
#: A judge takes (request_id, candidate_id, record_id, attempt, messages) and gives (request_id, response, reason, detail).
Judge = Callable[[DataFrame], DataFrame]


def requests(spark: SparkSession, root: str) -> DataFrame:
    """All committed requests, with query, batch and round."""
    return _read(spark, f"{root}/requests", f"{_REQUEST}, messages string, {_PLACE}")


def outcomes(spark: SparkSession, root: str) -> DataFrame:
    """All committed outcomes; ``reason`` is null where ``response`` is a valid judgment."""
    return _read(spark, f"{root}/outcomes", f"{_OUTCOME}, {_PLACE}")


def judge_stream(pairs: DataFrame, judge: Judge, root: str, checkpoint: str, query: str, run_id: str, max_retries: int = 2, **trigger: Any):
    """Start the query; ``trigger`` is Spark's (all that is there, unless given)."""

    def each(batch: DataFrame, number: int) -> None:
        judge_batch(batch, judge, root, query, number, run_id, max_retries)

    return pairs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def judge_batch(batch: DataFrame, judge: Judge, root: str, query: str, number: int, run_id: str, max_retries: int = 2) -> None:
    """Settle all pairs of a batch; safe to repeat after a failure at any point."""
    spark = batch.sparkSession
    folder = f"query={query}/batch={number}"
    _close(spark, root, folder)
    known = F.col("candidate_id").isNotNull() & F.col("record_id").isNotNull()
    pairs = batch.where(known).groupBy(*KEYS).agg(F.min(F.coalesce("messages", F.lit(""))).alias("messages"))
    while True:
        own = _round(spark, root, folder)
        todo = _todo(spark, root, pairs, run_id, max_retries)
        if not _put(todo, root, f"requests/{folder}/round={own}"):
            break
        _answer(spark, judge, root, folder, own)
    if "round=-1" not in sinks.names(spark, f"{root}/outcomes/{folder}"):
        lost = batch.where(~known).groupBy(*KEYS).agg(F.count("*").alias("n"))
        rows = lost.select(F.lit(None).cast("string").alias("request_id"), *KEYS, F.lit(0).alias("attempt"), F.lit(None).cast("string").alias("response"), F.lit("missing_key").alias("reason"), F.concat("n", F.lit(" rows")).alias("detail"))
        _put(rows, root, f"outcomes/{folder}/round=-1")


def settled(spark: SparkSession, root: str, max_retries: int = 2) -> DataFrame:
    """One row a pair: its response, or the reason of its last attempt, and how many attempts it took."""
    own = outcomes(spark, root).where("reason is distinct from 'missing_key'").groupBy(*KEYS).agg(
        F.max("response").alias("response"), F.max_by("reason", "attempt").alias("reason"), F.count("*").alias("attempts"),
        F.bool_or(F.coalesce(F.col("reason") == "token_budget_exceeded", F.lit(False))).alias("over"),
    )
    done = F.col("response").isNotNull() | F.col("over") | (F.col("attempts") > max_retries)
    return own.where(done).drop("over")


def _todo(spark: SparkSession, root: str, pairs: DataFrame, run_id: str, max_retries: int) -> DataFrame:
    """The next request of each pair that isn't settled."""
    ended = outcomes(spark, root)
    open_pairs = pairs.join(ended.where("response is not null").select(*KEYS), KEYS, "left_anti")
    state = judging.attempt_state(open_pairs, requests(spark, root), ended.where("reason is not null"), max_retries).where("not terminal")
    request = canon.request_id(F.lit(run_id), F.col("candidate_id"), F.col("record_id"), F.col("next_attempt"))
    return open_pairs.join(state, KEYS).select(request.alias("request_id"), *KEYS, F.col("next_attempt").cast("int").alias("attempt"), "messages")


def _answer(spark: SparkSession, judge: Judge, root: str, folder: str, number: int) -> None:
    """Ask the judge for a committed round of requests, and commit the outcomes: exactly one for each request."""
    asked = spark.read.schema(f"{_REQUEST}, messages string").parquet(f"{root}/requests/{folder}/round={number}")
    checked = judge(asked).withColumn("error", judging.judgment_error(F.col("response")))  # once, before the grouping
    said = checked.groupBy("request_id").agg(F.min(F.struct("reason", "response", "error", "detail")).alias("a"))
    met = asked.drop("messages").join(said, "request_id", "left")
    reason = F.when(F.col("a").isNull(), "no_judge_response").when(F.col("a.reason").isNotNull(), F.col("a.reason")).when(F.col("a.error").isNotNull(), "malformed_judge_response")
    kept = F.when(reason.isNull(), F.col("a.response"))
    detail = F.when(F.col("a.reason").isNull(), F.col("a.error"))
    rows = met.select("request_id", *KEYS, "attempt", kept.alias("response"), reason.alias("reason"), F.coalesce(detail, "a.detail").alias("detail"))
    _put(rows, root, f"outcomes/{folder}/round={number}")


def _close(spark: SparkSession, root: str, folder: str) -> None:
    """Rounds of this batch without outcomes were interrupted: their attempts are spent."""
    ended = sinks.names(spark, f"{root}/outcomes/{folder}")
    for name in sinks.names(spark, f"{root}/requests/{folder}"):
        if name.startswith("round=") and name not in ended:
            asked = spark.read.schema(_REQUEST).parquet(f"{root}/requests/{folder}/{name}")
            rows = asked.select("*", F.lit(None).cast("string").alias("response"), F.lit("interrupted_judge_attempt").alias("reason"), F.lit("requests were stored and no outcome; the attempt isn't used again").alias("detail"))
            _put(rows, root, f"outcomes/{folder}/{name}")


def _round(spark: SparkSession, root: str, folder: str) -> int:
    return sum(n.startswith("round=") for n in sinks.names(spark, f"{root}/requests/{folder}"))


def _put(rows: DataFrame, root: str, place: str) -> bool:
    """Write and commit by one rename, unless there are no rows; a write that fails leaves nothing in place."""
    spark = rows.sparkSession
    staged = f"{root}/_staged/{uuid.uuid4().hex}"
    try:
        rows.write.parquet(staged)
        if spark.read.schema(rows.schema).parquet(staged).isEmpty():
            return False
        sinks.move(spark, staged, f"{root}/{place}")
        return True
    finally:
        sinks.remove(spark, staged)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not sinks.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)
