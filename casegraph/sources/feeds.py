"""Feeds of discovered pages as a data source: windows are partitions, and an importable function fetches a window.

    spark.dataSource.register(FeedSource)
    spark.read.format("feed").option("fetch", "package.module:function").option("date_from", ...).option("date_to", ...).load()

The function takes (query, start, end) and returns (url, title, published) tuples; a
window that comes back full is halved up to MAX_DEPTH times, since feeds cut
long answers; rows of a window that is still full then have is_full set, so that a
reader can see where something may be missing. URLs outside the window, on blocked paths or without the wanted
words are left out; rows without a date are kept. Retries are the task's.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from datetime import datetime, timedelta
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "source string, url string, title string, published timestamp, window_start timestamp, is_full boolean"
# Hours of a window, rows from which one counts as full, halvings, and hours that aren't halved.
WINDOW_HOURS = 48
FULL = 90
MAX_DEPTH = 4
LEAST_HOURS = 3


class Window(InputPartition):
    def __init__(self, start: datetime, end: datetime) -> None:
        super().__init__((start, end))
        self.start, self.end = start, end


def windows(start: datetime, end: datetime, hours: int = WINDOW_HOURS) -> list[Window]:
    out, at = [], start
    while at < end:
        out.append(Window(at, min(at + timedelta(hours=hours), end)))
        at = out[-1].end
    return out


class FeedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = dict(options)

    def partitions(self) -> list[Window]:
        return windows(datetime.fromisoformat(self.options["date_from"]), datetime.fromisoformat(self.options["date_to"]), int(self.options.get("hours", WINDOW_HOURS)))

    def read(self, partition: Window) -> Iterator[tuple]:
        module, _, name = self.options["fetch"].partition(":")
        fetch = getattr(importlib.import_module(module), name)
        blocked = {x for x in self.options.get("blocked", "").split(",") if x}
        wanted = [x for x in self.options.get("keywords", "").split(",") if x]
        todo, seen = [(partition.start, partition.end, 0)], set()
        while todo:
            start, end, depth = todo.pop()
            found = list(fetch(self.options.get("query", ""), start, end))
            full = len(found) >= int(self.options.get("full", FULL))
            if full and depth < MAX_DEPTH and end - start > timedelta(hours=LEAST_HOURS):
                half = start + (end - start) / 2
                todo += [(start, half, depth + 1), (half, end, depth + 1)]
                continue
            for url, title, published in found:
                inside = published is None or partition.start <= published < partition.end
                section = urlsplit(url).path.strip("/").split("/")[0]
                if url not in seen and inside and section not in blocked and (not wanted or any(w in (title or "") for w in wanted)):
                    seen.add(url)
                    yield self.options.get("source", ""), url, title, published, partition.start, full


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FeedReader:
        return FeedReader(self.options)


def first_seen(feeds: list[DataFrame], order: Column | None = None) -> DataFrame:
    """Rows of several feeds, each URL from the first feed that has it."""
    from casegraph.operators.tables import union_distinct

    return union_distinct(feeds, "url")


def expand_queries(df: DataFrame, query: str, words: list[str], year: Column) -> DataFrame:
    """One row per query and descriptor, for sparse results."""
    return df.withColumn(query, F.explode(F.array(F.col(query), *[F.concat_ws(" ", query, F.lit(w), year.cast("string")) for w in words])))
