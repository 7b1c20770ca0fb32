"""Pluggable announcement sources as a Spark data source.

    register(spark)
    spark.read.format("announcements").option("source", "package.module:function").option("parts", 4).load()

``function(part, parts, options)`` yields dictionaries with the columns of ``SCHEMA``; each part
runs in a task of its own.  What a source leaves out is null; a time without a zone is an error,
as ten hours make another market day.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "source_ref string, ticker string, title string, lodged_at timestamp, announcement string, content binary, document_urls array<string>"
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


class _Part(InputPartition):
    def __init__(self, number: int, parts: int):
        super().__init__(number)
        self.number, self.parts = number, parts


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[_Part]:
        parts = int(self.options.get("parts", 1))
        return [_Part(i, parts) for i in range(parts)]

    def read(self, partition: _Part) -> Iterator[tuple]:
        module, _, name = self.options["source"].partition(":")
        fetch: Callable = getattr(importlib.import_module(module), name)
        for row in fetch(partition.number, partition.parts, self.options):
            at = row.get("lodged_at")
            if at is not None and at.tzinfo is None:
                raise ValueError("a time without a zone")
            yield tuple(row.get(n) for n in _NAMES)


class Announcements(DataSource):
    @classmethod
    def name(cls) -> str:
        return "announcements"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Announcements)


def example(part: int, parts: int, options: dict) -> Iterator[dict]:
    """Two made-up announcements a part; for trying the source out."""
    for i in range(2):
        yield {"source_ref": f"{part}-{i}", "ticker": "RNG", "title": "Change of Director's Interest Notice"}
