"""Canonical JSON, content hashes and deterministic ids."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.text import is_blank

UNIT = 31  # the separator of hashed parts


@F.pandas_udf(T.StringType())
def stable_json(text: pd.Series) -> pd.Series:
    """JSON text with sorted keys, no spaces, nulls and non-ASCII kept; null if it isn't JSON."""

    def one(value: str | None) -> str | None:
        try:
            return None if value is None else json.dumps(json.loads(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        except ValueError:
            return None

    return text.map(one)


@F.pandas_udf(T.BooleanType())
def parses_as_json(text: pd.Series) -> pd.Series:
    def one(value: str | None) -> bool:
        try:
            json.loads(value or "")
        except ValueError:
            return False
        return True

    return text.map(one)


@F.pandas_udf(T.BooleanType())
def is_json_object(text: pd.Series) -> pd.Series:
    def one(value: str | None) -> bool:
        try:
            return isinstance(json.loads(value or ""), dict)
        except ValueError:
            return False

    return text.map(one)


def format_valid(answer: Column, required: Column) -> Column:
    """Null without a requirement (null, '' or '{}'); JSON parses, json_object is an object, any other isn't blank."""
    return (
        F.when(required.isNull() | required.isin("", "{}"), F.lit(None).cast("boolean"))
        .when(required.isin("json", "application/json"), parses_as_json(answer))
        .when(required == "json_object", is_json_object(answer))
        .otherwise(~is_blank(answer))
    )


def checksum(json_text: Column) -> Column:
    """sha256 of the canonical form."""
    return F.sha2(stable_json(json_text), 256)


def string_literal_checksum(text: Column) -> Column:
    """sha256 of a whole text as a JSON string literal."""
    literal = F.to_json(F.array(text))
    return F.sha2(F.substring(literal, F.lit(2), F.length(literal) - 2), 256)


def hashed_id(prefix: str, length: int, *parts: Column) -> Column:
    """prefix + the first ``length`` hex digits of sha256 over the parts, joined by the unit separator."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws(chr(UNIT), *[p.cast("string") for p in parts]), 256), 1, length))


def adapter_id(experiment: Column, run: Column) -> Column:
    return hashed_id("adp-", 24, experiment, run)


def variant_id(canonical: Column, prefix: str = "tvar-") -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(canonical, 256), 1, 20))


def request_id(evaluation: Column, candidate: Column, record: Column, attempt: Column) -> Column:
    return hashed_id("jreq-", 24, evaluation, candidate, record, attempt)


def row_key(candidate: Column, record: Column) -> Column:
    return F.sha2(F.concat_ws(chr(UNIT), candidate.cast("string"), record.cast("string")), 256)


def training_run_id(run: Column) -> Column:
    return F.when(F.startswith(run, F.lit("trun-")), run).otherwise(F.concat(F.lit("trun-"), run))


def valid_lineage_id(value: Column) -> Column:
    return F.coalesce(value.rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$"), F.lit(False))
