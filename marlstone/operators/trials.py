"""Capacity-search trials: frontier, summaries, grids and pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def trial_number(trial_id: Column) -> Column:
    """The number in a trial id, -1 if there is none."""
    return F.coalesce(F.regexp_extract(trial_id, r"(\d+)", 1).try_cast("int"), F.lit(-1))


def capacity_frontier(trials: DataFrame, axes: tuple[str, ...], candidates: DataFrame) -> DataFrame:
    """Per model and axis: the last candidate, in declared order, that a completed trial had.

    ``candidates`` (axis, value, ordinal) is the short declared list.
    """
    done = trials.where("status = 'completed'")
    pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).cast("string").alias("value")) for a in axes]))
    long = done.select("model", pairs.alias("p"), "trial_number").select("model", "p.*", "trial_number")
    return long.join(candidates, ["axis", "value"]).groupBy("model", "axis").agg(F.max_by("value", "ordinal").alias("value"), F.max("ordinal").alias("ordinal"), F.count("*").alias("completed"))


def frontier_configurations(trials: DataFrame, frontier: DataFrame, axis: str) -> DataFrame:
    """Completed trials at the frontier value of an axis."""
    edge = frontier.where(F.col("axis") == axis).select("model", F.col("value").alias("edge"))
    return trials.where("status = 'completed'").join(edge, "model").where(F.col(axis).cast("string") == F.col("edge")).drop("edge")


def model_execution(trials: DataFrame) -> DataFrame:
    fresh = F.count_if(~F.coalesce("model_weights_reused", F.lit(False)))
    return trials.groupBy("model").agg(
        F.count("*").alias("trial_count"),
        F.count_if(F.col("status") == "completed").alias("completed_trial_count"),
        fresh.alias("model_load_count"),
        F.count_if("model_weights_reused").alias("reused_trial_count"),
        F.greatest(F.lit(0), fresh - 1).alias("worker_restart_count"),
        F.bool_or(F.col("status") == "completed").alias("supported"),
    )


def latest_safe(trials: DataFrame, *columns: str) -> DataFrame:
    """The last completed trial of each model."""
    done = trials.where("status = 'completed' and model is not null")
    return done.groupBy("model").agg(F.max_by(F.struct("trial_number", *columns), "trial_number").alias("last")).select("model", "last.*")


def grid(*axes: DataFrame) -> DataFrame:
    """The Cartesian product of short candidate lists, the first axis slowest.

    Each axis has a value column and ``<value>_index``; rows carry ``position``.
    """
    out = axes[0]
    for a in axes[1:]:
        out = out.crossJoin(a)
    order = [c for c in out.columns if c.endswith("_index")]
    return out.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def pruned(combinations: DataFrame, boundaries: DataFrame, context: tuple[str, ...], axis_index: str) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): a combination goes if an earlier boundary of its context has no larger index."""
    b = boundaries.select(*context, F.col(axis_index).alias("_edge"), F.col("position").alias("_at"))
    cond = (F.col("position") > F.col("_at")) & (F.col(axis_index) >= F.col("_edge"))
    for c in context:
        cond = cond & combinations[c].eqNullSafe(b[c])
    return combinations.join(b, cond, "left_anti"), combinations.join(b, cond, "left_semi")


def staged_boundary(outcomes: DataFrame) -> DataFrame:
    """Per model and axis, in declared order: tried candidates (up to the first failure) and the last safe one."""
    fail = outcomes.groupBy("model", "axis").agg(F.min(F.when(F.col("status") != "completed", F.col("ordinal"))).alias("first_failure"))
    met = outcomes.join(fail, ["model", "axis"])
    before = F.col("first_failure").isNull() | (F.col("ordinal") < F.col("first_failure"))
    return met.groupBy("model", "axis").agg(
        F.max("first_failure").alias("first_failure"),
        F.max(F.when(before, F.col("ordinal"))).alias("last_safe"),
        F.count_if(F.col("first_failure").isNull() | (F.col("ordinal") <= F.col("first_failure"))).alias("tried"),
    )


def longest_prefix(paths: DataFrame, mounts: DataFrame) -> DataFrame:
    """The longest mount point that is a path's prefix by whole components.

    Each path is cut into its ancestors and met by equality, so mounts may be many.
    """
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), n), "/")))
    rows = paths.select("path", F.explode(ancestors).alias("mount"))
    return rows.join(mounts, "mount").groupBy("path").agg(F.max_by("mount", F.length("mount")).alias("mount"))


def capped(combinations: DataFrame, max_trials: int) -> DataFrame:
    """The first ``max_trials`` combinations by position."""
    return combinations.orderBy("position").limit(max_trials)
