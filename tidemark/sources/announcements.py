"""A paged announcement source: one partition a day, so an error ends that day only.

The page getter is given as `module:function`; it takes (day as YYYYMMDD, page,
page size) and returns a list of dicts. Without one the source is offline and
reads JSON files named by day from `path`, a folder or uri that pyarrow can open
from every executor.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import date, timedelta

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "day string, title string, code string, publish_date string, url string"


class Day(InputPartition):
    def __init__(self, day: str):
        self.day = day


def day_range(first: str, last: str) -> list[str]:
    a, b = (date(int(x[:4]), int(x[4:6]), int(x[6:8])) for x in (first, last))
    return [(a + timedelta(days=i)).strftime("%Y%m%d") for i in range((b - a).days + 1)]


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Day]:
        return [Day(d) for d in day_range(self.options["first"], self.options["last"])]

    def _get(self):
        if name := self.options.get("getter"):
            from importlib import import_module

            module, _, function = name.partition(":")
            return getattr(import_module(module), function)
        folder = self.options["path"]

        def offline(day: str, page: int, size: int) -> list[dict]:
            from pyarrow import fs

            store, at = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
            with store.open_input_stream(f"{at}/{day}.json") as f:
                return json.loads(f.read())[page * size : (page + 1) * size]

        return offline

    def read(self, partition: Day) -> Iterator[tuple]:
        get, size, page = self._get(), int(self.options.get("pagesize", 10)), 0
        while True:
            try:
                rows = get(partition.day, page, size)
            except Exception:  # noqa: BLE001  by contract a page's error ends its day
                return
            for r in rows:
                yield partition.day, r.get("Title"), r.get("Code"), r.get("PublishDate"), r.get("Url")
            if len(rows) < size:
                return
            page += 1


class AnnouncementSource(DataSource):
    """`spark.dataSource.register(AnnouncementSource)`, then format('announcements') with first, last, path or getter."""

    @classmethod
    def name(cls) -> str:
        return "announcements"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)
