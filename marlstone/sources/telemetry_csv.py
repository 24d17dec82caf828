"""Telemetry sources: device CSV lines, bridge samples, host samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.numbers import number, percent

MIB = 1 << 20


def gpu_rows(df: DataFrame, line: str) -> DataFrame:
    """Eight-column device lines as samples; short lines go, unparsable numbers are null."""
    parts = F.split(line, r",\s*")
    v = lambda k: number(F.get(parts, F.lit(k)))
    used, total = (v(2) * MIB).cast("long"), (v(3) * MIB).cast("long")
    own = df.where(F.size(parts) >= 8).select(
        "*", v(0).cast("int").alias("device_index"), F.get(parts, F.lit(1)).alias("device"), used.alias("memory_used_bytes"), total.alias("memory_total_bytes"),
        v(4).alias("utilization_percent"), v(5).alias("power_draw_watts"), v(6).alias("power_limit_watts"), v(7).alias("temperature_celsius"),
    )
    return own.withColumn("memory_used_percent", percent(F.col("memory_used_bytes"), F.col("memory_total_bytes"))).withColumn("power_percent_of_limit", percent(F.col("power_draw_watts"), F.col("power_limit_watts")))


def bridge_samples(df: DataFrame, now: Column, max_age: float, required: tuple[str, ...]) -> DataFrame:
    """Complete bridge samples no older than ``max_age`` seconds, with age_seconds (never negative)."""
    age = F.greatest(F.lit(0.0), (F.unix_micros(now) - F.unix_micros("captured_at_utc")) / 1e6)
    complete = F.col(required[0]).isNotNull()
    for c in required[1:]:
        complete = complete & F.col(c).isNotNull()
    return df.where(complete).withColumn("age_seconds", age).where(F.col("age_seconds") <= max_age)


def counter_totals(df: DataFrame, *keys: str) -> DataFrame:
    """Sums of counters by key; not-a-number and infinite readings are skipped, none is negative."""
    ok = ~F.isnan("value") & (F.abs("value") < float("inf"))
    return df.where(ok).groupBy(*keys).agg(F.sum(F.greatest(F.lit(0.0), F.col("value"))).alias("total"))


def preferred_host(df: DataFrame) -> DataFrame:
    """The first available scope of each time: windows, then wsl, then any other."""
    rank = F.when(F.col("scope") == "windows", 0).when(F.col("scope") == "wsl", 1).otherwise(2)
    return df.groupBy("t").agg(F.min_by(F.struct("scope", "used_bytes", "total_bytes"), rank).alias("h")).select("t", "h.*")
