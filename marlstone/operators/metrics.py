"""Metrics and configurations as long tables; tracking policy; overrides."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import metric_segment


def flattened(df: DataFrame, key: str, json_column: str) -> DataFrame:
    """(key, name, kind, value): nested objects as dotted names; lists as JSON; any depth."""

    def walk(prefix: str, value: object) -> Iterator[tuple[str, str, str | None]]:
        if isinstance(value, dict):
            for k, v in value.items():
                yield from walk(f"{prefix}.{k}" if prefix else str(k), v)
        elif isinstance(value, list):
            yield prefix, "list", json.dumps(value, sort_keys=True)
        elif isinstance(value, bool):
            yield prefix, "bool", str(value)
        elif isinstance(value, (int, float)):
            yield prefix, "number", repr(value)
        else:
            yield prefix, "null" if value is None else "string", None if value is None else str(value)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, *r) for k, text in zip(b[key], b[json_column]) if text for r in walk("", json.loads(text))]
            yield pd.DataFrame(rows, columns=[key, "name", "kind", "value"])

    return df.select(key, json_column).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, name string, kind string, value string")


def metric_values(flat: DataFrame) -> DataFrame:
    """Numbers that aren't booleans."""
    return flat.where("kind = 'number'").withColumn("value", F.col("value").cast("double")).drop("kind")


def parameter_values(flat: DataFrame) -> DataFrame:
    """Everything but nulls, cut to 500 characters."""
    return flat.where("kind <> 'null'").withColumn("value", F.substring("value", 1, 500)).drop("kind")


def map_metrics(df: DataFrame, key: str, values: str) -> DataFrame:
    """A map column as rows of cleaned names, sorted by name within a key."""
    return df.select(key, F.explode(F.map_entries(values)).alias("e")).select(key, metric_segment(F.col("e.key")).alias("name"), F.col("e.value").alias("value"))


def suite_events(accuracies: DataFrame) -> DataFrame:
    """One event a suite (name suite.accuracy), numbers only."""
    return accuracies.where("accuracy is not null").select(F.concat(metric_segment(F.col("suite")), F.lit(".accuracy")).alias("name"), F.col("accuracy").alias("value"))


def override_diff(baseline: DataFrame, effective: DataFrame) -> DataFrame:
    """Settings (name, value) that differ between two configurations."""
    b, e = baseline.withColumnRenamed("value", "before"), effective.withColumnRenamed("value", "after")
    return b.join(e, "name", "full_outer").where(~F.col("before").eqNullSafe(F.col("after")))


def idempotent(events: DataFrame, *keys: str) -> DataFrame:
    """Replayed events once."""
    return events.dropDuplicates(list(keys))


def ordered_distinct(df: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct non-null values in the order of their first occurrence."""
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(order).alias("first_at"))


def bundle_checksum(files: DataFrame, *keys: str) -> DataFrame:
    """An order-independent hash of each bundle's (path, sha256, size_bytes)."""
    rows = F.array_sort(F.collect_list(F.struct("path", "sha256", "size_bytes")))
    return files.groupBy(*keys).agg(F.sha2(F.to_json(rows), 256).alias("checksum"), F.count("*").alias("files"))


def checksum_mismatches(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Paths that are missing, unexpected, or have another hash or size."""
    e = expected.select("path", F.col("sha256").alias("want"), F.col("size_bytes").alias("want_size"))
    a = actual.select("path", F.col("sha256").alias("got"), F.col("size_bytes").alias("got_size"))
    both = e.join(a, "path", "full_outer").where(~F.col("want").eqNullSafe(F.col("got")) | ~F.col("want_size").eqNullSafe(F.col("got_size")))
    why = F.when(F.col("got").isNull(), "missing").when(F.col("want").isNull(), "unexpected").when(F.col("want_size") != F.col("got_size"), "size").otherwise("sha256")
    return both.select("path", why.alias("why"))
