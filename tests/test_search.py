"""Searches as tables against searches that run one trial after the other."""

import random

import pytest
from pyspark.sql import functions as F

from marlstone.operators import search


def one_by_one(rows, cap):
    """(position, state, number, boundary position, boundary index) of a search in order."""
    edges, n, out = [], 0, []
    for context, index, position, status in sorted(rows, key=lambda r: r[2]):
        if cap is not None and n >= cap:
            out.append((position, "not_reached", None, None, None))
            continue
        found = next((e for e in edges if e[0] == context and index is not None and e[1] <= index), None)
        if found:
            out.append((position, "pruned", None, found[2], found[1]))
            continue
        n += 1
        out.append((position, "run", n, None, None))
        if status == "timeout" and index is not None:
            edges.append((context, index, position))
    return out


@pytest.mark.parametrize("cap", [None, 0, 7, 60])
def test_grid(spark, cap, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 16)
    rng = random.Random(str(cap))
    places = rng.sample(range(400), 150)
    rows = [(rng.choice(["a", "b", None]), rng.choice([*range(8), None]), p, rng.choice(["completed", "completed", "threshold_reached", "timeout"])) for p in places]
    df = spark.createDataFrame(rows, "model string, rank_index int, position long, status string")
    got = search.grid_search(df, ["model"], "rank_index", cap).select("position", "state", "trial_number", "boundary_position", "boundary_index").collect()
    assert sorted(map(tuple, got)) == one_by_one(rows, cap)
    assert search.grid_search(df.limit(0), ["model"], "rank_index", cap).count() == 0


def staged(models, axes, run, cap):
    """Rows of a staged search that calls ``run`` for each trial."""
    out = []
    n = 0
    for model in models:
        count = 0
        now = {a: v[0] for a, v in axes.items()}
        found_safe = stop = False
        for number, (axis, values) in enumerate(axes.items()):
            own = list(dict.fromkeys(values))
            if stop:
                break
            for k in range(1 if number else 0, len(own)):
                if cap is not None and n >= cap:
                    return out
                n, count = n + 1, count + 1
                shown = n if cap is not None else count
                status = run(model, {**now, axis: own[k]})
                out.append((model, axis, number, k, str(own[k]), "tried", status, str(own[k - 1]) if k else None, None, shown))
                if status == "completed":
                    now, found_safe = {**now, axis: own[k]}, True
                    continue
                if status == "timeout":
                    out += [(model, axis, number, j, str(own[j]), "pruned", None, str(own[k - 1]) if k else None, str(own[k]), shown) for j in range(k + 1, len(own))]
                    if not found_safe:
                        out += [(model, a, m, j, str(v), "pruned", None, None, None, shown) for m, a in enumerate(axes) if m > number for j, v in enumerate(dict.fromkeys(axes[a]))]
                break
            stop = not found_safe
    return out


@pytest.mark.parametrize("cap", [None, 5, 25])
def test_staged(spark, cap):
    axes = {"length": [1, 2, 4, 4, 8], "batch": [1], "rank": ["r8", "r16", "r8", "r32"], "worker": [0.5, 1.5]}
    rng = random.Random(str(cap))
    table, rows = {}, []
    for m in [f"m{k:02d}" for k in range(12)]:
        good = rng.choice([0.0, 0.6, 0.9])
        for a in (1, 2, 4, 8):
            for r in ("r8", "r16", "r32"):
                for w in (0.5, 1.5):
                    status = "completed" if rng.random() < good else rng.choice(["timeout", "threshold_reached"])
                    if rng.random() < 0.95:
                        table[m, a, 1, r, w] = status
                        rows += [(m, a, 1, r, w, status)] * rng.choice([1, 2])
    run = lambda m, c: table.get((m, c["length"], c["batch"], c["rank"], c["worker"]), "no_outcome")
    df = spark.createDataFrame([*rows, (None, 1, 1, "r8", 0.5, "timeout")], "model string, length int, batch int, rank string, worker double, status string")
    names = ["model", "axis", "axis_number", "ordinal", "candidate", "state", "status", "last_safe", "boundary", "trial_number"]
    got = search.staged_search(df, axes, cap).select(*names).collect()
    models = sorted({r[0] for r in rows})
    assert sorted(map(tuple, got), key=str) == sorted(staged(models, axes, run, cap), key=str)
    assert search.staged_search(df.limit(0), axes, cap).count() == 0


def test_staged_outcomes_are_never_broadcast(spark):
    """Exploded outcomes look as small as the table they come from."""
    axes = {"length": [1, 2, 4], "batch": [1, 2]}
    made = spark.range(100).select(F.col("id").cast("string").alias("model"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(4))).alias("length"), F.lit("completed").alias("status"))
    out = search.staged_search(made.withColumn("batch", F.explode(F.array(F.lit(1), F.lit(2)))), axes)
    assert out.count() == 100 * 4
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
