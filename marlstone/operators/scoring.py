"""Deterministic scores of prediction pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions import canon, text
from marlstone.operators.pairing import missing_side


def side_scores(answer: Column, normal: Column, wanted: Column, required_format: Column | None = None) -> Column:
    """The six scores of one side from its answer, the normalised answer and the normalised expected one.

    ``required_format`` brings in the JSON checks. Null answers count as empty ones.
    """
    valid = F.lit(None).cast("boolean") if required_format is None else canon.format_valid(answer, required_format)
    return F.struct(
        ((wanted != "") & (normal == wanted)).alias("normalized_exact_match"),
        ((wanted != "") & F.contains(normal, wanted)).alias("expected_answer_containment"),
        (normal == "").alias("empty_answer"),
        valid.alias("format_validity"),
        text.characters(answer).alias("response_characters"),
        text.token_estimate(answer).alias("response_token_estimate"),
    )


def deterministic_results(pairs: DataFrame, required_format: Column | None = None) -> DataFrame:
    """One scored row a pair; every text is normalised once."""
    normal = {f"_{k}": text.normalize_answer(F.col(c)) for k, c in (("b", "baseline_answer"), ("c", "candidate_answer"), ("e", "expected"))}
    return pairs.withColumns(normal).select(
        "candidate_id",
        "record_id",
        side_scores(F.col("baseline_answer"), F.col("_b"), F.col("_e"), required_format).alias("baseline"),
        side_scores(F.col("candidate_answer"), F.col("_c"), F.col("_e"), required_format).alias("candidate"),
        (F.col("_b") != F.col("_c")).alias("answer_changed"),
        missing_side().alias("missing_prediction"),
        F.struct(F.col("baseline_duplicate").alias("baseline"), F.col("candidate_duplicate").alias("candidate")).alias("duplicate_prediction"),
    )


def integrity_warnings(stored: dict[str, Column], recomputed: dict[str, Column]) -> Column:
    """``<name>_mismatch`` of stored flags that differ from recomputed ones, in the given order."""
    return F.array_compact(F.array(*[F.when(stored[k].isNotNull() & (stored[k] != recomputed[k]), f"{k}_mismatch") for k in stored]))
