"""Streams of telemetry and logs."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A fresh checkpoint folder under the cluster's shared folder (a temporary one without it, on a local master)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="marlstone-stream-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream; ts as a timestamp (watermarks need one)."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    is_dir = "events.parquet"
    own = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/{is_dir}*")
    return own.withColumn("ts", F.col("ts").cast("timestamp"))


def run_to_end(stream: DataFrame, mode: str, name: str, values: tuple[str, ...] = ()) -> DataFrame:
    """Process what is there and return the sink's table, in the shared folder.

    Update results are written batch by batch; of each key (all columns that aren't ``values``)
    the row of the last batch counts.
    """
    spark = stream.sparkSession
    where = checkpoint_location(spark, name)
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{where}/checkpoint")
    if mode == "append":
        writer.format("parquet").option("path", f"{where}/out").start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{where}/out")
    # A batch that is repeated after a failure writes the same folder again.
    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{where}/out/batch={number}")

    writer.foreachBatch(put).start().awaitTermination()
    rows = spark.read.schema(stream.schema.add("batch", "long")).option("basePath", f"{where}/out").parquet(f"{where}/out")
    keys = [c for c in stream.columns if c not in values]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("last"))
    return last.select(*keys, "last.*").select(*stream.columns)


def hourly(events: DataFrame, lateness: str | None = None) -> DataFrame:
    """Counts and sums by hour and type; with ``lateness`` closed windows are dropped from state."""
    own = events.withWatermark("ts", lateness) if lateness else events
    return own.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("hour"), "event_type", "n", "total")


def sustained_breaches(events: DataFrame, limit: float, seconds: float) -> DataFrame:
    """Device and time of its first breach that lasts ``seconds``; state: when the breach began.

    Within a batch samples are put in time order; a device fires once.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        began, fired = state.get if state.exists else (-1.0, False)
        if fired:
            return
        rows = pd.concat(list(batches)).sort_values(["t", "event_id"])
        t, over = rows["t"].to_numpy(), rows["value"].to_numpy() >= limit
        starts = over & ~np.concatenate([[began >= 0], over[:-1]])
        last = np.maximum.accumulate(np.where(starts, np.arange(len(t)), -1))
        since = np.where(last >= 0, t[last], began)
        hits = np.flatnonzero(over & (t - since >= seconds))
        state.update((float(since[-1]) if over[-1] else -1.0, bool(len(hits))))
        out = [(key[0], t[hits[0]], since[hits[0]])] if len(hits) else []
        yield pd.DataFrame(out, columns=["device", "fired_at", "since"])

    own = events.select(F.col("user_id").alias("device"), (F.unix_micros("ts") / 1e6).alias("t"), "event_id", "value")
    return own.groupBy("device").applyInPandasWithState(step, "device long, fired_at double, since double", "since double, fired boolean", "append", GroupStateTimeout.NoTimeout)


def split_lines(chunks: DataFrame) -> DataFrame:
    """Complete lines of each process's output chunks (process, ordinal, text); the rest is carried over."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rest = state.get[0] if state.exists else ""
        rows = pd.concat(list(batches)).sort_values("ordinal")
        parts = (rest + "".join(rows["text"])).replace("\r", "\n").split("\n")
        state.update((parts[-1],))
        yield pd.DataFrame([(key[0], p) for p in parts[:-1] if p], columns=["process", "line"])

    return chunks.groupBy("process").applyInPandasWithState(step, "process string, line string", "rest string", "append", GroupStateTimeout.NoTimeout)


def deduplicated(events: DataFrame, *keys: str, within: str | None = None) -> DataFrame:
    """Replayed events once; with ``within`` (on the event time ts) keys are forgotten after that time."""
    if within:
        return events.withWatermark("ts", within).dropDuplicatesWithinWatermark(list(keys))
    return events.dropDuplicates(list(keys))


def fresh_only(events: DataFrame, max_age: str, now: Column | None = None) -> DataFrame:
    """Samples no older than the allowed age; ``now`` is the clock of each batch unless it is given."""
    clock = F.current_timestamp() if now is None else now
    return events.where(F.col("ts") >= clock - F.expr(f"interval {max_age}"))


def refreshed(trials: DataFrame, report: Callable[[DataFrame, int], None], where: str):
    """Recompute a report after each batch; a failing report never stops the accounting."""

    def each(batch: DataFrame, number: int) -> None:
        try:
            report(batch, number)
        except Exception:  # noqa: BLE001  the accounting goes on
            logging.getLogger(__name__).warning("report of batch %s failed", number, exc_info=True)

    return trials.writeStream.foreachBatch(each).option("checkpointLocation", where).trigger(availableNow=True).start()


def unjudged(pairs: DataFrame, committed: DataFrame) -> DataFrame:
    """Streamed pairs without those that a table of committed results covers (read anew by each batch's plan)."""
    return pairs.join(committed.select("candidate_id", "record_id").distinct(), ["candidate_id", "record_id"], "left_anti")


def emitted_every(metrics: DataFrame, seconds: float, emit: Callable[[DataFrame, int], None], where: str):
    """Hand metric events to ``emit`` at a steady pace, however fast they come."""
    return metrics.writeStream.foreachBatch(emit).option("checkpointLocation", where).trigger(processingTime=f"{seconds} seconds").start()
