"""Listings behind a service as a data source of Spark: pages planned as partitions, filters handed to the service, failed requests tried again, and new pages as a stream.

``fetch(page, filters)`` gives the entries of a page (from 1 on) as dictionaries, or nothing beyond the last (an empty dictionary is the place of an entry that doesn't fit the filters); filters: {column: value} for those columns that the service can select by. It runs in tasks. Without a network it reads a dump.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, InputPartition
from pyspark.sql.types import StructType

Fetch = Callable[[int, dict], "list[dict] | None"]


def retried(call: Callable, *args, attempts: int = 4, pause: float = 0.2):
    """What the call gives; after a failure again, each time after about twice the pause; the last failure is raised."""
    for turn in range(attempts):
        try:
            return call(*args)
        except Exception:  # any failure of the provider
            if turn == attempts - 1:
                raise
            time.sleep(pause * 2**turn * random.uniform(0.5, 1.5))


@dataclass
class Pages(InputPartition):
    """Every ``step``-th page from ``first`` on, up to ``last`` or, without one, to the first that is empty."""

    first: int
    step: int = 1
    last: int | None = None


def _rows(pages: Pages, fetch: Fetch, filters: dict, names: list[str], how: dict) -> Iterator[tuple]:
    page = pages.first
    while pages.last is None or page <= pages.last:
        entries = retried(fetch, page, filters, **how)
        if not entries and pages.last is None:
            return
        yield from (tuple(e.get(n) for n in names) for e in entries or [] if e)
        page += pages.step


class _Batch(DataSourceReader):
    def __init__(self, source):
        self.source, self.filters = source, {}

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in self.source.selects and f.attribute[0] not in self.filters:
                self.filters[f.attribute[0]] = f.value
            else:
                yield f

    def partitions(self):
        s = self.source
        return [Pages(i + 1, s.at_once) for i in range(s.at_once)]

    def read(self, partition):
        s = self.source
        return _rows(partition, s.fetch, self.filters, s.names, s.how)


class _Stream(DataSourceStreamReader):
    """The offset is how many pages are complete: those with ``page_size`` entries. The last, incomplete page comes once it is full."""

    def __init__(self, source):
        self.source, self.known = source, 0

    def initialOffset(self):
        return {"pages": 0}

    def latestOffset(self):
        s = self.source
        full = lambda page: len(retried(s.fetch, page, {}, **s.how) or []) >= s.page_size
        if not full(self.known + 1):
            return {"pages": self.known}
        step = 1  # steps that double, then halve: few requests however many pages have come
        low = self.known + 1
        while full(low + step):
            low, step = low + step, step * 2
        while step > 1:
            step //= 2
            low += step if full(low + step) else 0
        self.known = low
        return {"pages": low}

    def partitions(self, start, end):
        first, last, n = start["pages"] + 1, end["pages"], self.source.at_once
        self.known = max(self.known, last)
        return [Pages(p, n, last) for p in range(first, min(last, first + n - 1) + 1)]

    def read(self, partition):
        s = self.source
        return _rows(partition, s.fetch, {}, s.names, s.how)

    def commit(self, end):
        pass


def listing_source(fetch: Fetch, schema: str | StructType, selects: tuple[str, ...] = (), at_once: int = 64, page_size: int = 100, **how) -> type[DataSource]:
    """A data source class for a listing; how: attempts and pause of retried. ``at_once`` tasks take turns with the pages, each until it meets an empty one, so nobody has to know how many there are."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    known = {"fetch": staticmethod(fetch), "selects": selects, "at_once": at_once, "page_size": page_size, "how": how, "names": fields.names}
    title = f"listing_{uuid.uuid4().hex}"
    return type("Listing", (DataSource,), known | {"name": classmethod(lambda cls: title), "schema": lambda self: fields, "reader": lambda self, schema: _Batch(self), "streamReader": lambda self, schema: _Stream(self)})


def listing(spark: SparkSession, source: type[DataSource]) -> DataFrame:
    """All entries of a listing; filters by equality on its ``selects`` go to the service."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)
    return spark.read.format(source.name()).load()


def listing_stream(spark: SparkSession, source: type[DataSource]) -> DataFrame:
    """The listing's complete pages as they come; a query's checkpoint knows which it has had."""
    spark.dataSource.register(source)
    return spark.readStream.format(source.name()).load()
