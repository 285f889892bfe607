"""User code as a Spark source: it plans splits, and executors read each split.

A handler says which splits exist and yields Arrow batches for one of them. Registered under a
name it serves `spark.read.format(name)` and, when it knows offsets, `spark.readStream`.
"""

from __future__ import annotations

import json
from abc import ABC, abstractmethod
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


class SourceHandler(ABC):
    """What user code supplies. `options` are the reader options."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    @abstractmethod
    def schema(self) -> str:
        """Row type as DDL."""

    @abstractmethod
    def plan_splits(self, start: int | None = None, end: int | None = None) -> list[dict]:
        """Disjoint splits that cover everything, or the offsets `start <= o < end`."""

    @abstractmethod
    def read_split(self, split: dict) -> Iterator[pa.RecordBatch]:
        """Rows of one split; runs on an executor."""

    def first_offset(self) -> int:
        raise NotImplementedError("this handler has no offsets, so it cannot be streamed")

    def latest_offset(self) -> int:
        raise NotImplementedError("this handler has no offsets, so it cannot be streamed")


class _Split(InputPartition):
    def __init__(self, split: dict):
        super().__init__(json.dumps(split))


class _BatchReader(DataSourceReader):
    def __init__(self, handler: SourceHandler):
        self.handler = handler

    def partitions(self):
        return [_Split(s) for s in self.handler.plan_splits()]

    def read(self, partition):
        return self.handler.read_split(json.loads(partition.value))


class _OffsetReader(DataSourceStreamReader):
    def __init__(self, handler: SourceHandler):
        self.handler = handler

    def initialOffset(self):
        return {"next": self.handler.first_offset()}

    def latestOffset(self):
        return {"next": self.handler.latest_offset()}

    def partitions(self, start, end):
        return [_Split(s) for s in self.handler.plan_splits(start["next"], end["next"])]

    def read(self, partition):
        return self.handler.read_split(json.loads(partition.value))

    def commit(self, end):
        pass


def register_handler(spark: SparkSession, name: str, handler: type[SourceHandler]) -> None:
    """Make `handler` available as format `name`."""
    import headgate.sources.handler as this_module

    # Executors get this module by value, so they need no copy of the package.
    cloudpickle.register_pickle_by_value(this_module)

    class HandlerSource(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return handler(dict(self.options)).schema()

        def reader(self, schema):
            return _BatchReader(handler(dict(self.options)))

        def streamReader(self, schema):
            return _OffsetReader(handler(dict(self.options)))

    spark.dataSource.register(HandlerSource)
