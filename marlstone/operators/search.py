"""Searches over configurations whose outcomes are a table: the grid with dominance, and the staged search.

Both give what a search that runs one trial after the other would have run, pruned or left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions that are numbered in one group.
BLOCK = 1 << 16


def _same(names: Sequence[str], left: str, right: str) -> Column:
    on = F.lit(True)
    for n in names:
        on = on & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return on


def grid_search(outcomes: DataFrame, context: Sequence[str], axis_index: str, max_trials: int | None = None) -> DataFrame:
    """Combinations (``context``, ``axis_index``, position, status) with what a search in order of position does.

    Adds ``state`` (run, pruned, not_reached), ``trial_number`` of those that run, and of the pruned
    ``boundary_position`` and ``boundary_index``: the first trial of the same context that timed out at no
    larger index. The ``max_trials``-th trial is the last; what comes after is not reached.

    Only trials that run make boundaries, but that needs no fold in order of position: a combination
    that is pruned has an index no smaller than its boundary's, so whatever its own timeout would prune
    that earlier boundary prunes too. The first timeout at or below each index so decides, whether it ran or not.
    It comes from one grouping by context and index and a running minimum over a context's distinct indexes.
    Numbers come from counts by blocks of ``BLOCK`` positions: only the sums of blocks are in one task.

    Defined cases: positions are distinct and not negative; a null context is a context like others; a
    combination with a null index is never pruned and prunes nothing; an empty table gives no rows.
    """
    at = F.when((F.col("status") == "timeout") & F.col(axis_index).isNotNull(), F.struct("position", axis_index))
    by_index = outcomes.groupBy(*context, axis_index).agg(F.min(at).alias("own"))
    below = Window.partitionBy(*context).orderBy(axis_index).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = by_index.withColumn("edge", F.min("own").over(below)).drop("own")
    met = outcomes.alias("o").join(edges.alias("e"), _same([*context, axis_index], "o", "e")).select("o.*", "e.edge")
    hit = F.coalesce(F.col("edge.position") < F.col("position"), F.lit(False)) & F.col(axis_index).isNotNull()
    marked = met.withColumn("goes", hit).withColumn("block", F.floor(F.col("position") / BLOCK))
    blocks = marked.groupBy("block").agg(F.count_if(~F.col("goes")).alias("runs"))
    blocks = blocks.select("block", (F.sum("runs").over(Window.orderBy("block")) - F.col("runs")).alias("before"))
    inside = F.count_if(~F.col("goes")).over(Window.partitionBy("block").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = marked.withColumn("inside", inside).join(blocks, "block").withColumn("upto", F.col("before") + F.col("inside"))
    earlier = F.col("upto") - F.when(F.col("goes"), 0).otherwise(1)
    late = F.lit(False) if max_trials is None else earlier >= max_trials
    state = F.when(late, "not_reached").when(F.col("goes"), "pruned").otherwise("run")
    return numbered.select(
        *[F.col(c) for c in outcomes.columns],
        state.alias("state"),
        F.when(state == "run", F.col("upto")).alias("trial_number"),
        F.when(state == "pruned", F.col("edge.position")).alias("boundary_position"),
        F.when(state == "pruned", F.col(f"edge.{axis_index}")).alias("boundary_index"),
    )


def staged_search(outcomes: DataFrame, axes: Mapping[str, Sequence[Any]], max_trials: int | None = None) -> DataFrame:
    """What a search over one axis after the other tries and prunes, for each model.

    ``outcomes`` has model, a column for each axis, and status. An axis ends at its first failure; the next
    one starts from the last safe configuration. What comes after a timeout is pruned, on all later axes as
    well if the least configuration timed out; a model whose least configuration fails is given up.

    Rows: model, axis, axis_number, ordinal, candidate (text), state (tried or pruned), status of the
    tried, ``last_safe`` (the axis' value in the last safe configuration before; null if there is none),
    ``boundary`` (the pruned: the value that timed out) and trial_number (the pruned: of the trial that pruned).
    Trials are numbered from 1 for each model; with ``max_trials`` over all models in order of their names, and
    the search ends there. Only the first ``max_trials`` models can then have a trial, so only they are read.

    One join and one grouping by model an axis, all models side by side; a model's row holds its candidates'
    statuses, of which there are as many as the declared lists are long. The joins are merge joins by hint:
    outcomes that come from an explode have many times the rows that Spark's estimate of their size supposes,
    and would be sent to the driver as a broadcast.

    Defined cases: a configuration without an outcome has the status ``no_outcome`` and ends its axis; of
    several outcomes the least status counts; repeated candidates count once; rows without a model are
    skipped; an empty table gives no rows.
    """
    names = list(axes)
    lists = {a: list(dict.fromkeys(axes[a])) for a in names}
    kind = {a: outcomes.schema[a].dataType for a in names}
    value = lambda a, v: F.lit(v).cast(kind[a])
    values = lambda a: F.array(*[value(a, v) for v in lists[a]])
    known = outcomes.where("model is not null")
    by_configuration = known.groupBy("model", *names).agg(F.min("status").alias("status")).hint("merge")
    models = known.select("model").distinct()
    if max_trials is not None:
        models = models.orderBy("model").limit(max_trials)
    state = models.select("model", *[value(a, lists[a][0]).alias(a) for a in names])
    gone = F.coalesce(F.col("fail_0") == 0, F.lit(False))
    for number, axis in enumerate(names):
        own = [F.struct(F.lit(k).alias("ordinal"), value(axis, v).alias("value")) for k, v in enumerate(lists[axis]) if k or not number]
        if not own:
            nothing = F.array().cast("array<struct<ordinal:int,status:string>>")
            state = state.withColumn(f"tried_{number}", nothing).withColumn(f"fail_{number}", F.lit(None).cast("int"))
            continue
        asked = state.withColumn("c", F.explode_outer(F.when(~gone, F.array(*own)) if number else F.array(*own)))
        met = asked.withColumn(axis, F.col("c.value")).join(by_configuration, ["model", *names], "left")
        one = F.when(F.col("c").isNotNull(), F.struct(F.col("c.ordinal").alias("ordinal"), F.coalesce("status", F.lit("no_outcome")).alias("status")))
        kept = [c for c in state.columns if c not in ("model", axis)]
        state = met.groupBy("model").agg(*[F.any_value(c).alias(c) for c in kept], F.array_sort(F.collect_list(one)).alias(f"tried_{number}"))
        failed = F.filter(f"tried_{number}", lambda x: x["status"] != "completed")
        state = state.withColumn(f"fail_{number}", F.array_min(F.transform(failed, lambda x: x["ordinal"])))
        safe = F.greatest(F.coalesce(f"fail_{number}", F.lit(len(lists[axis]))) - 1, F.lit(0))
        state = state.withColumn(axis, F.get(values(axis), safe))
    rows = F.concat(*[_axis_rows(number, axis, values(axis), len(lists[axis]), gone) for number, axis in enumerate(names)])
    made = state.select("model", rows.alias("rows"))
    made = made.withColumn("before", F.lit(0).cast("long"))
    if max_trials is not None:
        n = F.size(F.filter("rows", lambda r: r["state"] == "tried"))
        made = made.withColumn("before", F.sum(n).over(Window.orderBy("model")) - n)  # at most max_trials rows
    found = made.select("model", "before", F.inline("rows"))
    order = Window.partitionBy("model").orderBy("axis_number", "ordinal").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("trial_number", F.col("before") + F.count_if(F.col("state") == "tried").over(order)).drop("before")
    return found if max_trials is None else found.where(F.col("trial_number") <= max_trials)


def _axis_rows(number: int, axis: str, values: Column, n: int, gone: Column) -> Column:
    """The rows of one axis from a model's row."""
    tried, fail = F.col(f"tried_{number}"), F.col(f"fail_{number}")
    text = lambda k: F.get(values, k).cast("string")
    none = F.lit(None).cast("string")

    def row(ordinal: Column, state: str, status: Column, last_safe: Column, boundary: Column) -> Column:
        return F.struct(F.lit(axis).alias("axis"), F.lit(number).alias("axis_number"), ordinal.cast("int").alias("ordinal"), text(ordinal).alias("candidate"), F.lit(state).alias("state"), status.alias("status"), last_safe.alias("last_safe"), boundary.alias("boundary"))

    before = lambda k: F.when(k > 0, text(k - 1))
    ran = F.transform(F.filter(tried, lambda x: fail.isNull() | (x["ordinal"] <= fail)), lambda x: row(x["ordinal"], "tried", x["status"], before(x["ordinal"]), none))
    ended = F.exists(tried, lambda x: (x["ordinal"] == fail) & (x["status"] == "timeout"))
    beyond = F.transform(F.filter(tried, lambda x: (x["ordinal"] > fail) & ended), lambda x: row(x["ordinal"], "pruned", none, before(fail), text(fail)))
    out = F.concat(ran, beyond)
    if not number:
        return out
    least = gone & F.exists("tried_0", lambda x: (x["ordinal"] == 0) & (x["status"] == "timeout"))
    every = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: row(k, "pruned", none, none, none))
    return F.when(least, every).otherwise(out)
