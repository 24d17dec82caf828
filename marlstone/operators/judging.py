"""Judgments: validation of responses, attempts, and resuming."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.text import stripped

#: Dimensions, decisions and sufficiency grades of a judgment.
DIMENSIONS = ("reference_correctness", "evidence_faithfulness", "completeness", "relevance", "instruction_following", "format_validity")
DECISIONS = ("candidate_better", "baseline_better", "tie", "unjudgeable")
SUFFICIENCY = ("sufficient", "insufficient", "not_provided")


def _kind(path: str, v: Column) -> Column:
    """The JSON type of a path of a VARIANT; null where the path is absent."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, path, "variant")), r"^[A-Z]+", 0)


def _number(path: str, v: Column) -> Column:
    return F.when(_kind(path, v).isin("BIGINT", "DOUBLE", "DECIMAL"), F.try_variant_get(v, path, "double"))


def judgment_error(response: Column) -> Column:
    """Why a judge's JSON text is invalid (the first reason in a fixed order), or null."""
    v = F.try_parse_json(response)
    reasons = [F.when(v.isNull() | (_kind("$", v) != "OBJECT") | _kind("$", v).isNull(), "response: not a JSON object")]
    for side in ("baseline", "candidate"):
        reasons.append(F.when(~F.coalesce(_kind(f"$.{side}", v) == "OBJECT", F.lit(False)), f"{side}: no scores"))
        for d in DIMENSIONS:
            n = _number(f"$.{side}.{d}", v)
            reasons += [F.when(n.isNull(), f"{side}.{d}: not a number"), F.when(~n.between(0, 1), f"{side}.{d}: not a share")]
    text = lambda p: F.when(_kind(p, v) == "STRING", F.try_variant_get(v, p, "string"))
    bad = lambda c: ~F.coalesce(c, F.lit(False))
    confidence = _number("$.confidence", v)
    reasons += [
        F.when(bad(text("$.decision").isin(*DECISIONS)), "decision: unknown"),
        F.when(bad(confidence.between(0, 1)), "confidence: not a share"),
        F.when(bad(_kind("$.regression", v) == "BOOLEAN"), "regression: not a boolean"),
        F.when(bad(stripped(text("$.rationale")) != ""), "rationale: empty"),
        F.when(_kind("$.failure_categories", v) != "ARRAY", "failure_categories: not a list"),
        F.when(bad(text("$.evidence_sufficiency").isin(*SUFFICIENCY)), "evidence_sufficiency: unknown"),
    ]
    return F.coalesce(*reasons)


def unjudgeable_result() -> Column:
    """The stand-in judgment where evidence doesn't allow one: all scores zero."""
    side = F.struct(*[F.lit(0.0).alias(d) for d in DIMENSIONS])
    return F.struct(side.alias("baseline"), side.alias("candidate"), F.lit("unjudgeable").alias("decision"), F.lit(False).alias("regression"), F.lit(0.0).alias("confidence"))


def remaining(pairs: DataFrame, committed: DataFrame) -> DataFrame:
    """Pairs that no committed result covers."""
    return pairs.join(committed, ["candidate_id", "record_id"], "left_anti")


def attempt_state(pairs: DataFrame, requests: DataFrame, rejections: DataFrame, max_retries: int) -> DataFrame:
    """Next unused attempt, whether a pair is finished, and attempts that were interrupted.

    A request without a rejection was interrupted and its attempt is spent.
    """
    keys = ["candidate_id", "record_id"]
    inside = F.col("attempt").between(0, max_retries)
    r = requests.where(inside).select(*keys, "attempt", F.lit(False).alias("rejected"), F.lit(None).cast("string").alias("reason"))
    j = rejections.where(inside).select(*keys, "attempt", F.lit(True).alias("rejected"), "reason")
    by_attempt = r.union(j).groupBy(*keys, "attempt").agg(F.max("rejected").alias("rejected"), F.max("reason").alias("reason"))
    state = by_attempt.groupBy(*keys).agg(
        F.collect_set("attempt").alias("used"),
        F.count_if(~F.col("rejected")).alias("interrupted"),
        F.max(F.coalesce(F.col("reason") == "token_budget_exceeded", F.lit(False))).alias("over_budget"),
    )
    free = F.array_min(F.array_except(F.sequence(F.lit(0), F.lit(max_retries)), F.coalesce("used", F.array().cast("array<int>"))))
    next_attempt = F.coalesce(free, F.lit(max_retries + 1))
    return pairs.select(*keys).join(state, keys, "left").select(
        *keys,
        next_attempt.alias("next_attempt"),
        (F.coalesce("over_budget", F.lit(False)) | (next_attempt > max_retries)).alias("terminal"),
        F.coalesce("interrupted", F.lit(0)).cast("long").alias("interrupted"),
    )


class Judge(Protocol):
    """What a judge offers; ``judge`` alone runs on the executors."""

    def diagnose(self) -> dict[str, Any]: ...

    def capabilities(self) -> dict[str, Any]: ...

    def acquire(self) -> None: ...

    def count_tokens(self, messages: str) -> int: ...

    def judge(self, messages: str) -> str: ...

    def release(self) -> None: ...


def judged_by(requests: DataFrame, make: Callable[[], Judge], context_tokens: int, output_tokens: int) -> DataFrame:
    """(request_id, response, reason, detail): one judge a task, taken and released; requests beyond the context aren't sent.

    A failure of one request is its reason, with the exception's class and message, and the others go on.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        client.acquire()
        try:
            for b in batches:
                rows = []
                for request, messages in zip(b["request_id"], b["messages"]):
                    tokens = client.count_tokens(messages)
                    if tokens + output_tokens > context_tokens:
                        rows.append((request, None, "token_budget_exceeded", f"{tokens} tokens and {output_tokens} of output, {context_tokens} allowed"))
                        continue
                    try:
                        rows.append((request, client.judge(messages), None, None))
                    except Exception as e:  # noqa: BLE001  a row, not the task, has failed
                        rows.append((request, None, "judge_request_failed", f"{type(e).__name__}: {e}"[:1000]))
                yield pd.DataFrame(rows, columns=["request_id", "response", "reason", "detail"])
        finally:
            client.release()

    return requests.select("request_id", "messages").mapInPandas(run, "request_id string, response string, reason string, detail string")


def judged(requests: DataFrame, judge: Callable[[str], str]) -> DataFrame:
    """Responses of a judge callable to ``messages`` (JSON text), in Arrow batches on the executors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(response=b["messages"].map(judge))[["request_id", "response"]]

    return requests.select("request_id", "messages").mapInPandas(run, "request_id string, response string")


@F.pandas_udf(T.StringType())
def judge_messages(body: pd.Series) -> pd.Series:
    """A system and a user message around a request body (JSON text), keys sorted."""
    system = "Compare the two answers and reply with one JSON object."

    def one(text: str) -> str:
        user = json.dumps(json.loads(text), sort_keys=True, ensure_ascii=False)
        return json.dumps([{"role": "system", "content": system}, {"role": "user", "content": user}], ensure_ascii=False)

    return body.map(one)


def response_content(response: Column) -> Column:
    """The first choice's content of a chat response, or null."""
    return F.get_json_object(response, "$.choices[0].message.content")


def response_fields(response: Column) -> Column:
    """Content, model, finish reason, request id and token counts of a chat response, and why it can't be used."""
    at = lambda path: F.get_json_object(response, f"$.{path}")
    content = response_content(response)
    return F.struct(
        content.alias("content"),
        at("model").alias("model"),
        at("choices[0].finish_reason").alias("finish_reason"),
        at("id").alias("provider_request_id"),
        at("usage.prompt_tokens").try_cast("long").alias("prompt_tokens"),
        at("usage.completion_tokens").try_cast("long").alias("completion_tokens"),
        F.when(content.isNull(), "response without content").alias("error"),
    )
