"""Pairing baseline and candidate predictions.

Keys: candidate_id, record_id; ``side`` is 'baseline' or 'candidate', ``canonical`` the row's
canonical JSON and ``ordinal`` its place in the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.checks import require_none
from marlstone.functions.text import is_blank


def conflicts(predictions: DataFrame) -> DataFrame:
    """Keys whose repeats differ: an error of the input. Hashes alone are compared."""
    own = predictions.where(~is_blank(F.col("record_id"))).select("candidate_id", "record_id", "side", F.sha2("canonical", 256).alias("h"))
    return own.groupBy("candidate_id", "record_id", "side").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").select("candidate_id", "record_id", "side")


def invalid_ids(predictions: DataFrame) -> DataFrame:
    """Rows whose record id is null or white space: an error of the input, too."""
    return predictions.where(is_blank(F.col("record_id")))


def checked(predictions: DataFrame) -> DataFrame:
    """The predictions, after an error if there are rows without an id or repeats that differ."""
    require_none(invalid_ids(predictions).select("candidate_id", "side", "ordinal"), "predictions without a record id")
    require_none(conflicts(predictions), "conflicting predictions")
    return predictions


def pair_pivot(predictions: DataFrame) -> DataFrame:
    """Pairs by one grouped pass with one shuffle (a full outer join without a join).

    The first row of a side counts, by ``ordinal``; rows without an id are left out (see ``checked``).
    """
    base, cand = F.col("side") == "baseline", F.col("side") == "candidate"
    first = lambda side: F.min_by(F.struct("answer", "expected"), F.when(side, F.col("ordinal")))
    own = predictions.where(~is_blank(F.col("record_id"))).groupBy("candidate_id", "record_id").agg(
        first(base).alias("b"), first(cand).alias("c"), F.count_if(base).alias("n_b"), F.count_if(cand).alias("n_c")
    )
    own = own.withColumn("b", F.when(F.col("n_b") > 0, F.col("b"))).withColumn("c", F.when(F.col("n_c") > 0, F.col("c")))
    return own.select(
        "candidate_id",
        "record_id",
        F.col("b.answer").alias("baseline_answer"),
        F.col("c.answer").alias("candidate_answer"),
        F.coalesce("c.expected", "b.expected").alias("expected"),
        (F.col("n_b") > 0).alias("has_baseline"),
        (F.col("n_c") > 0).alias("has_candidate"),
        (F.col("n_b") > 1).alias("baseline_duplicate"),
        (F.col("n_c") > 1).alias("candidate_duplicate"),
    )


def pair_full_outer(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """The same pairs as an explicit full outer join on the ids."""
    b = baseline.groupBy("candidate_id", "record_id").agg(F.min_by("answer", "ordinal").alias("baseline_answer"), (F.count("*") > 1).alias("baseline_duplicate"))
    c = candidate.groupBy("candidate_id", "record_id").agg(F.min_by("answer", "ordinal").alias("candidate_answer"), (F.count("*") > 1).alias("candidate_duplicate"))
    joined = b.withColumn("has_baseline", F.lit(True)).join(c.withColumn("has_candidate", F.lit(True)), ["candidate_id", "record_id"], "full_outer")
    flags = [F.coalesce(f, F.lit(False)).alias(f) for f in ("has_baseline", "has_candidate", "baseline_duplicate", "candidate_duplicate")]
    return joined.select("candidate_id", "record_id", "baseline_answer", "candidate_answer", *flags)


def missing_side():
    return F.when(~F.col("has_baseline"), "baseline").when(~F.col("has_candidate"), "candidate")


def summary(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("candidate_id").agg(
        F.count("*").alias("record_count"),
        F.count_if(F.col("has_baseline") & F.col("has_candidate")).alias("paired_count"),
        F.count_if(~F.col("has_baseline")).alias("missing_baseline_count"),
        F.count_if(~F.col("has_candidate")).alias("missing_candidate_count"),
        F.count_if("baseline_duplicate").alias("duplicate_baseline_count"),
        F.count_if("candidate_duplicate").alias("duplicate_candidate_count"),
    )


def issues(pairs: DataFrame) -> DataFrame:
    bad = missing_side().isNotNull() | F.col("baseline_duplicate") | F.col("candidate_duplicate")
    return pairs.where(bad).select("candidate_id", "record_id", missing_side().alias("missing"), "baseline_duplicate", "candidate_duplicate")
