"""Keyed tables: rows by key in hashed partitions, of which a merge writes only those it changes.

``put`` merges rows by key. A key that is new is stored. One that is stored with the same content is left
alone. One that is stored with other content keeps what it has and becomes a row of the returned conflicts,
or with ``replace`` takes the new content. Where one call brings several contents of a key, the first by
``order`` (then by content digest) counts and the others are conflicts.

A merge first writes the new state of the changed partitions to a folder beside the table, whole or not at
all, and then overwrites those partitions dynamically. If it is killed before that folder is whole nothing
has changed; if it is killed later, the next ``put``, ``get`` or ``rows`` overwrites them again from the
folder. A merge is so repeated without harm. One writer at a time; a reader of another application that
reads the files themselves may meet a partition while it is overwritten.

Scale: contents are counted by key and digest before they are shuffled, so a hot key or a large group of
repeated rows is small. A partition is written by ``SPREAD`` tasks. The driver sees partition numbers, of
which there are ``buckets`` at most (stored with the table: it can't be changed later).

Defined cases: a null key is a key like others; null values are content like others; an empty table of
rows changes nothing; a key that isn't stored has nulls in ``get``; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.checks import require_none
from marlstone.sources import sinks

#: Tasks that write one partition.
SPREAD = 8
_BUCKET, _DIGEST = "key_bucket", "content_digest"


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path`` with ``schema``, of which ``keys`` are the key."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 64

    def __post_init__(self) -> None:
        described = {"keys": list(self.keys), "buckets": self.buckets, "schema": self.schema.simpleString()}
        sinks.put_json(self.spark, f"{self.path}.json", described)

    @property
    def values(self) -> list[str]:
        return [f.name for f in self.schema if f.name not in self.keys]

    def rows(self) -> DataFrame:
        """All stored rows."""
        return self._stored().select(*self.schema.names)

    def get(self, wanted: DataFrame, required: bool = False) -> DataFrame:
        """Stored rows of the keys of ``wanted``, each once; with ``required`` a key that isn't stored is an error."""
        keys = wanted.select(*self.keys).distinct().withColumn(_BUCKET, self._bucket())
        touched = self._numbers(keys)
        found = self._stored().where(F.col(_BUCKET).isin(touched)).withColumn("is_stored", F.lit(True))
        met = keys.alias("w").join(found.alias("s"), self._same("w", "s"), "left")
        if required:
            require_none(met.where("is_stored is null").select(*[F.col(f"w.{k}") for k in self.keys]), "keys that aren't stored")
        return met.select(*[F.col(f"{'w' if n in self.keys else 's'}.{n}") for n in self.schema.names])

    def put(self, rows: DataFrame, order: Sequence[str] = (), replace: bool = False) -> DataFrame:
        """Merge; returns the conflicts: key, ``content_digest``, ``stored_digest`` and how many rows brought that content."""
        self._recover()
        digest = F.sha2(F.to_json(F.struct(*self.values), {"ignoreNullFields": "false"}), 256)
        own = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema], *[F.col(c).alias(f"order_{k}") for k, c in enumerate(order)])
        rank = F.struct(*[f"order_{k}" for k in range(len(order))], _DIGEST)
        by_content = own.withColumn(_DIGEST, digest).groupBy(*self.keys, _DIGEST).agg(F.count("*").alias("brought"), F.min(rank).alias("rank"), F.any_value(F.struct(*self.values)).alias("content"))
        brought = self._kept(by_content, "brought")
        first = brought.groupBy(*self.keys).agg(F.min_by(F.struct(_DIGEST, "content"), "rank").alias("f")).select(*self.keys, f"f.{_DIGEST}", "f.content")
        first = first.withColumn(_BUCKET, self._bucket())
        stored = self._stored()
        near = stored.where(F.col(_BUCKET).isin(self._numbers(first)))
        same = self._same("n", "s") if not replace else self._same("n", "s") & (F.col(f"n.{_DIGEST}") == F.col(f"s.{_DIGEST}"))
        new = self._kept(first.alias("n").join(near.alias("s"), same, "left_anti").select(*self.keys, "content.*", _DIGEST, _BUCKET), "new")
        changed = self._numbers(new)
        if changed:
            old = stored.where(F.col(_BUCKET).isin(changed))
            if replace:
                old = old.alias("s").join(new.alias("n"), self._same("n", "s"), "left_anti")
            self._publish(old.select(new.columns).unionByName(new))
        now = self._stored().select(*self.keys, F.col(_DIGEST).alias("stored_digest"), _BUCKET)
        met = brought.withColumn(_BUCKET, self._bucket()).alias("n").join(now.alias("s"), self._same("n", "s"))
        return met.where(F.col(_DIGEST) != F.col("stored_digest")).select(*[F.col(f"n.{k}") for k in self.keys], _DIGEST, "stored_digest", "brought")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _same(self, left: str, right: str) -> Column:
        on = F.col(f"{left}.{_BUCKET}") == F.col(f"{right}.{_BUCKET}")
        for k in self.keys:
            on = on & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
        return on

    @staticmethod
    def _numbers(df: DataFrame) -> list[int]:
        return sorted(r[0] for r in df.select(_BUCKET).distinct().collect())  # one row a bucket

    def _all_columns(self) -> T.StructType:
        return T.StructType([*self.schema, T.StructField(_DIGEST, T.StringType()), T.StructField(_BUCKET, T.IntegerType())])

    def _stored(self) -> DataFrame:
        self._recover()
        if not sinks.exists(self.spark, self.path):
            return self.spark.createDataFrame([], self._all_columns())
        return self.spark.read.schema(self._all_columns()).parquet(self.path)

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        """What a merge reads more than once, written beside the table, so that its end can't change it."""
        where = f"{self.path}.{name}"
        df.write.mode("overwrite").parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def _publish(self, merged: DataFrame) -> None:
        part = F.pmod(F.hash(*self.keys), F.lit(SPREAD))
        merged.repartition(_BUCKET, part).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}.merge")
        self._recover()

    def _recover(self) -> None:
        """Finish a merge whose partitions are written and maybe not in place; forget one that wasn't whole."""
        staged = f"{self.path}.merge"
        if not sinks.exists(self.spark, staged):
            return
        if sinks.exists(self.spark, f"{staged}/_SUCCESS"):
            ready = self.spark.read.schema(self._all_columns()).parquet(staged)
            part = F.pmod(F.hash(*self.keys), F.lit(SPREAD))
            ready.repartition(_BUCKET, part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(self.path)
        sinks.remove(self.spark, staged)
