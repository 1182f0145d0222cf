"""Recorded search answers as a Spark data source: ``spark.read.format("recorded_search").load(folder)``."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "query string, position int, url string, title string, snippet string, error string"


class RecordedSearch(DataSource):
    """A JSON file an answer, ``{"query": ..., "response": {"organic_results": [...]}}``; soft errors become a row."""

    @classmethod
    def name(cls) -> str:
        return "recorded_search"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(self.options["path"], int(self.options.get("most", 100)))


class _Reader(DataSourceReader):
    def __init__(self, folder: str, most: int) -> None:
        self.folder, self.most = folder, most

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(str(p)) for p in sorted(Path(self.folder).glob("*.json"))] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        given = json.loads(Path(partition.value).read_text(encoding="utf-8"))
        answer = given.get("response") or {}
        if answer.get("error"):
            yield given.get("query"), None, None, None, None, str(answer["error"])
            return
        for i, r in enumerate((answer.get("organic_results") or [])[: self.most], 1):
            if r.get("link"):
                yield given.get("query"), i, r["link"], r.get("title"), r.get("snippet"), None


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordedSearch)
