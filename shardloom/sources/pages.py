"""Paged results of a remote job as a Spark data source."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class PagedResults(DataSource):
    """``spark.read.format("paged_results").option("folder", f).load()``: each page is a JSON file ``page-<n>.json`` with
    a list ``results`` of {"id", "raw"}; results without an id are skipped. One partition per page."""

    @classmethod
    def name(cls) -> str:
        return "paged_results"

    def schema(self) -> str:
        return "request_id string, raw string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["folder"])


class _Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(n) for n in sorted(os.listdir(self.folder)) if n.startswith("page-") and n.endswith(".json")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(os.path.join(self.folder, partition.value), encoding="utf-8") as f:
            for r in json.load(f).get("results", []):
                if r.get("id"):
                    yield r["id"], r.get("raw")
