"""Telemetry: time-ordered samples of devices. Windows are partitioned by device.

Sample columns: device, t (seconds, double), and readings.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _by_time(device: str = "device", *ties: str):
    return Window.partitionBy(device).orderBy("t", *ties)


def ranked_values(df: DataFrame, value: str, ranks: Mapping[str, Column], *keys: str) -> DataFrame:
    """The values at zero-based ranks of each key's sorted values, one column a rank, exactly.

    ``ranks`` are expressions of ``n``, the key's count. Counts by buckets of nearly equal values
    find the bucket of each rank; only values of such buckets are counted one by one. So no key's
    values come together in an array or a task. Nulls in ``value`` are left out.
    """
    v = F.col(value).cast("double")
    key = F.struct(*[F.col(k) for k in keys], F.lit(0).alias("_"))  # nulls are equal inside a struct
    size = F.floor(F.log2(F.abs(v)) * 64).cast("long") + 100_000
    bucket = F.when(v == 0, 0).when(v > 0, size).otherwise(-size)
    own = df.where(v.isNotNull()).select(key.alias("k"), bucket.alias("b"), v.alias("v"))
    buckets = own.groupBy("k", "b").agg(F.count("*").alias("m"))
    total = buckets.groupBy("k").agg(F.sum("m").alias("n"))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), r.cast("long").alias("rank")) for name, r in ranks.items()]))
    before = F.sum("m").over(Window.partitionBy("k").orderBy("b")) - F.col("m")
    met = buckets.withColumn("before", before).join(total.select("k", wanted.alias("w")), "k").where("w.rank >= before and w.rank < before + m")
    picked = met.select("k", "b", F.col("w.name").alias("name"), (F.col("w.rank") - F.col("before")).alias("at"))
    values = own.join(picked.select("k", "b").distinct(), ["k", "b"], "left_semi").groupBy("k", "b", "v").agg(F.count("*").alias("c"))
    passed = F.sum("c").over(Window.partitionBy("k", "b").orderBy("v"))
    found = values.withColumn("passed", passed).join(picked, ["k", "b"]).where("at < passed and at >= passed - c")
    out = found.groupBy("k").agg(*[F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in ranks])
    return out.select(*[F.col("k")[k].alias(k) for k in keys], *ranks)


def latency_summary(df: DataFrame, seconds: str, *keys: str) -> DataFrame:
    """Count, mean, extremes, true median and half-even nearest-rank p95 and p99, in ms."""
    last = F.col("n") - 1
    ranks = {"_low": F.floor(last / 2), "_high": F.ceil(last / 2), "p95": F.rint(last * 0.95), "p99": F.rint(last * 0.99)}
    at = ranked_values(df, seconds, ranks, *keys)
    own = df.groupBy(*keys).agg(F.count(seconds).alias("sample_count"), (F.avg(seconds) * 1000).alias("average_ms"), (F.min(seconds) * 1000).alias("minimum_ms"), (F.max(seconds) * 1000).alias("maximum_ms"))
    same = [own[k].eqNullSafe(at[k]) for k in keys] or [F.lit(True)]  # without keys one row on either side
    met = own.join(at, same, "left").select(own["*"], "_low", "_high", "p95", "p99")
    return met.select(
        *keys, "sample_count", "average_ms", "minimum_ms", ((F.col("_low") + F.col("_high")) / 2 * 1000).alias("median_ms"),
        (F.col("p95") * 1000).alias("p95_ms"), (F.col("p99") * 1000).alias("p99_ms"), "maximum_ms",
    )


def energy(df: DataFrame, watts: str = "watts", *ties: str) -> DataFrame:
    """Joules by left Riemann sum over consecutive samples; steps from an unknown power are skipped."""
    w = _by_time("device", *ties)
    steps = df.select("device", watts, (F.lag(watts).over(w) * (F.col("t") - F.lag("t").over(w))).alias("step"))
    return steps.groupBy("device").agg(F.when(F.count(watts) > 0, F.coalesce(F.sum("step"), F.lit(0.0))).alias("joules"))


def energy_of_active(df: DataFrame, watts: str = "watts", *ties: str) -> DataFrame:
    """The controller's rule: samples without power are dropped first, so steps span the gaps."""
    return energy(df.where(F.coalesce(F.col(watts), F.lit(0.0)) > 0), watts, *ties)


def rates(df: DataFrame, value: str, *ties: str) -> DataFrame:
    """Growth per second, never negative; the first sample of a device has 0."""
    w = _by_time("device", *ties)
    grown, passed = F.col(value) - F.lag(value).over(w), F.col("t") - F.lag("t").over(w)
    return df.withColumn("rate", F.coalesce(F.greatest(F.lit(0.0), grown) / F.greatest(passed, F.lit(1e-9)), F.lit(0.0)))


def gpu_summary(df: DataFrame) -> DataFrame:
    """Averages and peaks of each device (nulls skipped), constants from its first sample."""
    first = lambda c: F.min_by(c, "t").alias(c)
    agg = [F.count("*").alias("sample_count")]
    for c, unit in (("utilization_percent", "utilization"), ("power_draw_watts", "power"), ("temperature_celsius", "temperature")):
        agg += [F.avg(c).alias(f"{unit}_average"), F.max(c).alias(f"{unit}_peak")]
    used = F.coalesce(F.col("memory_used_bytes"), F.lit(0))
    agg += [F.rint(F.avg(used)).cast("long").alias("memory_average_bytes"), F.max(used).alias("memory_peak_bytes"), first("memory_total_bytes"), first("power_limit_watts")]
    return df.groupBy("device").agg(*agg).withColumn("memory_peak_percent", F.when(F.col("memory_total_bytes") > 0, F.col("memory_peak_bytes") / F.col("memory_total_bytes") * 100))


def monitor_summary(df: DataFrame) -> DataFrame:
    """Host averages and peaks, the last host sample, and I/O between the first and last sample."""
    delta = lambda c: (F.max_by(c, "t") - F.min_by(c, "t")).alias(f"{c}_delta")
    return df.groupBy("device").agg(
        F.avg("cpu_percent").alias("cpu_average"), F.max("cpu_percent").alias("cpu_peak"), F.avg("ram_percent").alias("ram_average"), F.max("ram_percent").alias("ram_peak"),
        F.max_by("host", "t").alias("host"), delta("read_bytes"), delta("write_bytes"),
    )


def latest(df: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    """The last row of each key as one struct, without a sort."""
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("last")).select(key, "last.*")


def running_peaks(df: DataFrame, value: str) -> DataFrame:
    """Peak over time of the sum over devices at each time."""
    total = df.groupBy("t").agg(F.sum(value).alias("total"))
    return total.agg(F.max("total").alias("peak"))


def fresh(df: DataFrame, now: Column, max_age: float) -> DataFrame:
    """Samples no older than ``max_age`` seconds, with their age (never negative)."""
    age = F.greatest(F.lit(0.0), now - F.col("t"))
    return df.withColumn("age_seconds", age).where(age <= max_age)


def breaches(df: DataFrame, limits: Mapping[str, float | None]) -> DataFrame:
    """(key, value, limit) of each sample whose reading reaches a limit; a null limit is off."""
    on = {k: v for k, v in limits.items() if v is not None}
    others = [c for c in df.columns if c not in limits]
    checks = F.array(*[F.struct(F.lit(i).alias("check"), F.lit(k).alias("key"), F.col(k).cast("double").alias("value"), F.lit(float(v)).alias("limit")) for i, (k, v) in enumerate(on.items())])
    return df.select(*others, F.explode(checks).alias("b")).select(*others, "b.*").where("value >= limit")


def timeouts(df: DataFrame, limits: Mapping[str, float | None], no_step: float | None = None) -> DataFrame:
    """(key, value, limit) where a phase has lasted its limit, and where training made no step for ``no_step`` seconds.

    Columns read: phase, phase_seconds, and seconds_since_step (null: none to wait for). A phase
    without a limit, or with a null one, can't time out. The key is the phase's setting; training's
    is the trial's.
    """
    on = {k: v for k, v in limits.items() if v is not None}
    limit = F.coalesce(*[F.when(F.col("phase") == k, F.lit(float(v))) for k, v in on.items()], F.lit(None).cast("double"))
    key = F.concat(F.when(F.col("phase") == "training", "trial").otherwise(F.col("phase")), F.lit("_timeout_seconds"))
    one = lambda ok, key, value, most: F.when(ok, F.struct(F.lit(key).alias("key") if isinstance(key, str) else key.alias("key"), value.cast("double").alias("value"), most.alias("limit")))
    found = [one(F.col("phase_seconds") >= limit, key, F.col("phase_seconds"), limit)]
    if no_step is not None:
        late = (F.col("phase") == "training") & (F.col("seconds_since_step") >= no_step)
        found.append(one(late, "no_step_progress_timeout_seconds", F.col("seconds_since_step"), F.lit(float(no_step))))
    others = [c for c in df.columns if c not in ("key", "value", "limit")]
    return df.select(*others, F.explode(F.array_compact(F.array(*found))).alias("b")).select(*others, "b.*")


def step_progress(df: DataFrame, now: Column, *ties: str) -> DataFrame:
    """Per device: the last completed step, the longest pause between steps, and seconds since the last.

    Columns read: t and step (null where a sample is no step).
    """
    steps = df.where("step is not null")
    w = _by_time("device", *ties)
    gaps = steps.withColumn("gap", F.col("t") - F.lag("t").over(w))
    order = F.struct("t", *ties)
    return gaps.groupBy("device").agg(
        F.max_by("step", order).alias("completed_step"), F.coalesce(F.max("gap"), F.lit(0.0)).alias("longest_step_seconds"), (now - F.max("t")).alias("seconds_since_step")
    )


def device_peaks(df: DataFrame) -> DataFrame:
    """Peaks over time of what a trial's devices show: shares and temperature by device, power as their sum."""
    by_time = df.groupBy("t").agg(
        F.max("memory_used_percent").alias("m"), F.max("utilization_percent").alias("u"), F.max("temperature_celsius").alias("c"), F.sum("power_draw_watts").alias("p"), F.max("ram_used_percent").alias("r")
    )
    return by_time.agg(
        F.max("m").alias("gpu_memory_peak_percent"), F.max("u").alias("gpu_utilization_peak_percent"), F.max("c").alias("gpu_temperature_peak_celsius"), F.max("p").alias("gpu_power_peak_watts"), F.max("r").alias("system_ram_peak_percent")
    )


def sustained(df: DataFrame, over: Column, seconds: float, *ties: str) -> DataFrame:
    """First time at which a device has been ``over`` without a break for ``seconds``."""
    w = _by_time("device", *ties)
    clear = F.sum(F.when(F.coalesce(over, F.lit(False)), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = df.withColumn("over", F.coalesce(over, F.lit(False))).withColumn("island", clear).where("over")
    since = F.min("t").over(Window.partitionBy("device", "island"))
    fired = marked.withColumn("since", since).where(F.col("t") - F.col("since") >= seconds)
    return fired.groupBy("device").agg(F.min("t").alias("fired_at"), F.min_by("since", "t").alias("since"))


def first_breach(df: DataFrame, immediate: tuple[str, ...]) -> DataFrame:
    """Of candidate firings (t, check, key, sustained) the one that stops a run."""
    return df.where(F.col("sustained") | F.col("key").isin(*immediate)).groupBy("device").agg(F.min_by(F.struct("t", "key"), F.struct("t", "check")).alias("b")).select("device", "b.*")


def longest_gap(df: DataFrame, *ties: str) -> DataFrame:
    """Marks, the longest pause between marks, and the time of the last."""
    w = _by_time("device", *ties)
    gaps = df.withColumn("gap", F.col("t") - F.lag("t").over(w))
    return gaps.groupBy("device").agg(F.count("*").alias("marks"), F.max("gap").alias("longest_gap"), F.max("t").alias("last_mark"))


def phases(df: DataFrame, marker: Column, *ties: str, start: str = "model_loading") -> DataFrame:
    """The phase of each sample (last marker so far) and the seconds it has lasted."""
    w = _by_time("device", *ties).rowsBetween(Window.unboundedPreceding, 0)
    own = df.withColumn("phase", F.coalesce(F.last(marker, ignorenulls=True).over(w), F.lit(start)))
    began = F.coalesce(F.last(F.when(marker.isNotNull(), F.col("t")), ignorenulls=True).over(w), F.first("t").over(w))
    return own.withColumn("phase_seconds", F.col("t") - began)


def throughput(df: DataFrame) -> DataFrame:
    """Per-second counters; null before any time has passed."""
    per = lambda c: F.when(F.col("elapsed") > 0, F.col(c) / F.col("elapsed")).alias(f"{c}_per_second")
    return df.select("*", per("steps"), per("examples"), per("tokens"))


def live_metrics(df: DataFrame, scope: str = "live") -> DataFrame:
    """(step, name, value): progress counters and rates as metric events, nulls left out."""
    own = throughput(df)
    names = [c for c in own.columns if c not in ("step", "device", "t") and dict(own.dtypes)[c] in ("int", "bigint", "double", "float")]
    entries = F.array(*[F.struct(F.lit(f"{scope}.{c}").alias("name"), F.col(c).cast("double").alias("value")) for c in names])
    return own.select("step", F.explode(entries).alias("m")).select("step", "m.*").where("value is not null")
