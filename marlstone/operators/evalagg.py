"""Aggregating, gating, comparing and ranking candidates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.numbers import ratio

#: The default gates.
GATES = {
    "minimum_record_coverage": 0.95,
    "minimum_candidate_win_rate": 0.55,
    "maximum_regression_rate": 0.05,
    "minimum_reference_correctness": 0.75,
    "minimum_evidence_faithfulness": 0.75,
    "maximum_unjudgeable_rate": 0.10,
    "require_deterministic_non_regression": True,
    "require_human_approval": True,
}


def deterministic_metrics(results: DataFrame) -> DataFrame:
    """Per candidate; accuracies over paired rows only."""
    paired = F.col("missing_prediction").isNull()
    one = results.groupBy("candidate_id").agg(
        F.count("*").alias("record_count"),
        F.count_if(paired).alias("paired_record_count"),
        F.count_if(F.col("missing_prediction") == "baseline").alias("missing_baseline_count"),
        F.count_if(F.col("missing_prediction") == "candidate").alias("missing_candidate_count"),
        F.count_if("duplicate_prediction.baseline").alias("duplicate_baseline_count"),
        F.count_if("duplicate_prediction.candidate").alias("duplicate_candidate_count"),
        F.count_if(paired & F.col("candidate.normalized_exact_match")).alias("candidate_exact_match_count"),
        F.count_if(paired & F.col("baseline.normalized_exact_match")).alias("baseline_exact_match_count"),
    )
    cand, base = (ratio(F.col(f"{s}_exact_match_count"), F.col("paired_record_count")) for s in ("candidate", "baseline"))
    return one.select(
        "*",
        ratio(F.col("paired_record_count"), F.col("record_count")).alias("record_coverage"),
        cand.alias("deterministic_accuracy"),
        base.alias("baseline_deterministic_accuracy"),
        (cand - base).alias("paired_exact_match_delta"),
        (F.col("candidate_exact_match_count") < F.col("baseline_exact_match_count")).alias("deterministic_regression"),
    )


def judgment_metrics(judgments: DataFrame) -> DataFrame:
    """Per candidate; rates over valid judgments (rows with a decision).

    Columns read: decision, regression, basis, reference_correctness, evidence_faithfulness,
    latency_seconds, prompt_tokens, completion_tokens.
    """
    valid = judgments.where("decision is not null")
    share = lambda c: F.avg(F.when(F.coalesce(c, F.lit(False)), 1.0).otherwise(0.0))
    decision = F.col("decision")
    return valid.groupBy("candidate_id").agg(
        F.count("*").alias("judged"),
        F.avg("reference_correctness").alias("judge_reference_correctness_mean"),
        F.avg("evidence_faithfulness").alias("judge_evidence_faithfulness_mean"),
        share(decision == "candidate_better").alias("candidate_win_rate"),
        share(decision == "baseline_better").alias("baseline_win_rate"),
        share(decision == "tie").alias("tie_rate"),
        share(F.col("regression")).alias("regression_rate"),
        share(decision == "unjudgeable").alias("unjudgeable_rate"),
        share(F.col("basis") == "evidence-grounded").alias("evidence_grounded_coverage"),
        F.avg("latency_seconds").alias("average_latency_seconds"),
        F.sum(F.coalesce("prompt_tokens", F.lit(0))).alias("input_tokens"),
        F.sum(F.coalesce("completion_tokens", F.lit(0))).alias("output_tokens"),
    )


def aggregate_candidates(results: DataFrame, judgments: DataFrame, rejections: DataFrame) -> DataFrame:
    """All metrics of each candidate of ``results``; three aggregations of few rows, joined."""
    rejected = rejections.groupBy("candidate_id").agg(F.count("*").alias("rejected"))
    joined = deterministic_metrics(results).join(judgment_metrics(judgments), "candidate_id", "left").join(rejected, "candidate_id", "left")
    zero = ("judged", "rejected", "input_tokens", "output_tokens")
    rates = ("candidate_win_rate", "baseline_win_rate", "tie_rate", "regression_rate", "evidence_grounded_coverage")
    filled = joined.fillna(0, list(zero)).fillna(0.0, list(rates)).fillna(1.0, ["unjudgeable_rate"])
    return filled.withColumn("invalid_judge_response_rate", ratio(F.col("rejected"), F.col("judged") + F.col("rejected"))).drop("judged", "rejected")


def gate_checks(gates: Mapping[str, float | bool]) -> dict[str, Column]:
    g = {**GATES, **gates}
    at_least = lambda c, k: F.coalesce(F.col(c) >= g[k], F.lit(False))
    return {
        "minimum_record_coverage": at_least("record_coverage", "minimum_record_coverage"),
        "minimum_candidate_win_rate": at_least("candidate_win_rate", "minimum_candidate_win_rate"),
        "maximum_regression_rate": F.col("regression_rate") <= g["maximum_regression_rate"],
        "minimum_reference_correctness": at_least("judge_reference_correctness_mean", "minimum_reference_correctness"),
        "minimum_evidence_faithfulness": at_least("judge_evidence_faithfulness_mean", "minimum_evidence_faithfulness"),
        "maximum_unjudgeable_rate": F.col("unjudgeable_rate") <= g["maximum_unjudgeable_rate"],
        "require_deterministic_non_regression": F.lit(not g["require_deterministic_non_regression"]) | ~F.col("deterministic_regression"),
    }


def recommendations(metrics: DataFrame, gates: Mapping[str, float | bool] | None = None) -> DataFrame:
    """Metrics with passed_gates, failed_gates and the recommendation."""
    checks = gate_checks(gates or {})
    human = {**GATES, **(gates or {})}["require_human_approval"]
    passed = F.array_sort(F.array_compact(F.array(*[F.when(c, k) for k, c in checks.items()])))
    failed = F.array_sort(F.array_compact(F.array(*[F.when(~c, k) for k, c in checks.items()])))
    status = (
        F.when((F.col("record_coverage") == 0) | (F.col("unjudgeable_rate") == 1), "insufficient_evidence")
        .when(F.size("failed_gates") > 0, "not_recommended")
        .otherwise("manual_review_required" if human else "recommended_for_promotion")
    )
    return metrics.withColumn("passed_gates", passed).withColumn("failed_gates", failed).withColumn("recommendation", status)


def overlaps(record_sets: DataFrame, candidates: DataFrame) -> DataFrame:
    """Shared records of every pair of candidates, relative to the larger set.

    ``candidates`` (candidate_id, ordinal) is the short list of compared candidates; pairs
    without a shared record stay, two empty sets overlap fully.
    """
    sizes = candidates.join(record_sets.groupBy("candidate_id").agg(F.count("*").alias("n")), "candidate_id", "left").fillna(0, ["n"])
    left = sizes.select(F.col("candidate_id").alias("left_id"), F.col("ordinal").alias("lo"), F.col("n").alias("ln"))
    right = sizes.select(F.col("candidate_id").alias("right_id"), F.col("ordinal").alias("ro"), F.col("n").alias("rn"))
    pairs = left.join(right, F.col("lo") < F.col("ro"))
    own = record_sets.select("candidate_id", "record_id")
    a, b = own.withColumnRenamed("candidate_id", "left_id"), own.withColumnRenamed("candidate_id", "right_id")
    shared = a.join(b, "record_id").groupBy("left_id", "right_id").agg(F.count("*").alias("shared"))
    both = pairs.join(shared, ["left_id", "right_id"], "left").fillna(0, ["shared"])
    larger = F.greatest("ln", "rn")
    return both.select("left_id", "right_id", "shared", F.when(larger == 0, 1.0).otherwise(F.col("shared") / larger).alias("overlap"))


def comparability(pair_overlaps: DataFrame, minimum: float) -> DataFrame:
    """(comparable, overlap): the least overlap of all pairs; one candidate alone is comparable."""
    least = F.coalesce(F.min("overlap"), F.lit(1.0))
    return pair_overlaps.agg((least >= minimum).alias("comparable"), least.alias("overlap"))


def downgraded(recommended: DataFrame, comparable: bool, candidates: int) -> DataFrame:
    """A recommendation of one among several incomparable candidates needs a review."""
    doubt = F.lit(candidates > 1 and not comparable) & (F.col("recommendation") == "recommended_for_promotion")
    return recommended.withColumn("recommendation", F.when(doubt, "manual_review_required").otherwise(F.col("recommendation")))


def ranking(metrics: DataFrame, comparable: bool = True) -> DataFrame:
    """Candidates by win rate, then accuracy; ties keep the input order; none if incomparable."""
    return metrics.where(F.lit(comparable)).orderBy(F.desc("candidate_win_rate"), F.desc("deterministic_accuracy"), F.asc("ordinal"))


def suite_accuracy(rows: DataFrame) -> DataFrame:
    """Accuracy by suite and overall in one pass of grouping sets; ``overall`` tells the total from a null suite."""
    return rows.rollup("suite").agg((F.grouping("suite") == 1).alias("overall"), F.count("*").alias("n"), F.avg(F.col("correct").cast("double")).alias("accuracy"))


def suite_report(rows: DataFrame) -> DataFrame:
    """Examples, both accuracies and the distinct evaluation sets (sorted) of each suite, and overall.

    Columns read: suite, exact_match, contains_expected, evaluation_set_id, evaluation_set_version.
    A null suite is the legacy one; rows without a set id add no set. The sets of a suite are few.
    """
    own = rows.withColumn("suite", F.coalesce("suite", F.lit("legacy_evaluation")))
    share = lambda c: F.avg(F.col(c).cast("double"))
    sets = F.collect_set(F.when(F.col("evaluation_set_id").isNotNull(), F.struct("evaluation_set_id", F.coalesce("evaluation_set_version", F.lit("")).alias("evaluation_set_version"))))
    return own.rollup("suite").agg(
        (F.grouping("suite") == 1).alias("overall"), F.count("*").alias("example_count"), share("exact_match").alias("exact_match_accuracy"), share("contains_expected").alias("contains_expected_accuracy"), F.array_sort(sets).alias("evaluation_sets")
    )


def deltas(baseline: DataFrame, trained: DataFrame) -> DataFrame:
    """Change of each suite's accuracy; null without records."""
    b = baseline.select("suite", F.col("accuracy").alias("before"))
    return trained.join(b, "suite", "left").select("suite", F.when(F.col("n") > 0, F.col("accuracy") - F.col("before")).alias("delta"))


def max_input_tokens(pairs: DataFrame, chars: Column) -> DataFrame:
    """Largest estimated judge input over pairs; 0 without pairs."""
    from marlstone.functions.text import char_budget_tokens

    return pairs.agg(F.coalesce(F.max(char_budget_tokens(chars)), F.lit(0)).alias("max_input_tokens"))
