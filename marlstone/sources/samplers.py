"""Sampler callables as a Spark data source, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, SimpleDataSourceStreamReader


def register_sampler(spark: SparkSession, name: str, sampler: Callable[[int], list[tuple[Any, ...]]], ddl: str) -> str:
    """Make ``spark.read.format(name)`` and ``spark.readStream.format(name)`` call ``sampler``.

    ``sampler`` gets a sample number and returns rows of ``ddl``. A batch reads the numbers 0 to
    the option ``samples`` (1); a stream reads the next one in every trigger, until ``samples``
    where that is set, and reads the same number again after a failure.
    """

    class Batch(DataSourceReader):
        def __init__(self, count: int) -> None:
            self.count = count

        def read(self, partition: Any) -> Iterator[tuple[Any, ...]]:
            for k in range(self.count):
                yield from sampler(k)

    class Stream(SimpleDataSourceStreamReader):
        def __init__(self, most: int | None) -> None:
            self.most = most

        def initialOffset(self) -> dict[str, int]:
            return {"next": 0}

        def read(self, start: dict[str, int]) -> tuple[Iterator[tuple[Any, ...]], dict[str, int]]:
            at = start["next"]
            if self.most is not None and at >= self.most:
                return iter(()), start
            return iter(sampler(at)), {"next": at + 1}

        def readBetweenOffsets(self, start: dict[str, int], end: dict[str, int]) -> Iterator[tuple[Any, ...]]:
            return iter([r for k in range(start["next"], end["next"]) for r in sampler(k)])

        def commit(self, end: dict[str, int]) -> None:
            pass

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ddl

        def reader(self, schema: Any) -> DataSourceReader:
            return Batch(int(self.options.get("samples", 1)))

        def simpleStreamReader(self, schema: Any) -> SimpleDataSourceStreamReader:
            most = self.options.get("samples")
            return Stream(None if most is None else int(most))

    spark.dataSource.register(Source)
    return name
