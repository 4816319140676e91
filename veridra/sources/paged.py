"""Reading a paged service as a data source: a few pages of one range a partition, planned from counts.

A service answers two requests: how many records a range of years holds, and one page of them.
It refuses to page past a window. So the reader asks for the count of the whole range first and
halves a range that passes the window until each part fits. A single year beyond the window is
halved by key in the same way where the first and last key are told; else it is walked by key
instead of by offset, in one partition, so nothing is left out. Requests that fail
are repeated after growing pauses; a page is read by whichever task Spark gives it to, and again
by another if that one is lost.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Busy(Exception):
    """The service could not answer now; the request may be repeated."""


class Service(Protocol):
    """What a service must answer. It is sent to executors, so it must pickle."""

    def count(self, low: int, high: int) -> int:
        """Records of the years low to high."""

    def page(self, low: int, high: int, limit: int, offset: int = 0, after: Any = None) -> pa.RecordBatch:
        """Up to `limit` records by key: from an offset on, or those behind a key.

        A service whose years are to be halved by key takes `after` and `most` (the last key) in both
        requests; an offset then counts from the first record behind `after`.
        """


def patiently(ask: Callable[[], Any], tries: int, pause: float) -> Any:
    """What ask returns; it is asked again, after pauses that double (with some chance in them), if the service is busy."""
    for n in range(tries):
        try:
            return ask()
        except Busy:
            if n == tries - 1:
                raise
            time.sleep(pause * 2**n * (0.5 + random.random()))


@dataclass
class Page(InputPartition):
    """Records of the years low to high (and of keys behind the first, up to the second): `limit` from an offset on, or all by key where there is none."""

    low: int
    high: int
    limit: int
    offset: int | None
    keys: tuple[int, int] | None = None


#: Pages that one partition asks for at most.
TOGETHER = 16


@dataclass
class Pages(InputPartition):
    """Pages that are asked for one after another."""

    pages: list[Page]


def together(pages: list[Page], most: int = TOGETHER) -> list[Pages]:
    """Neighbours of one range by offset, up to `most` a partition; a task a page would cost more than the page."""
    out: list[Pages] = []
    for p in pages:
        held = out[-1].pages if out else []
        if held and len(held) < most and p.offset is not None and held[0].offset is not None and (p.low, p.high, p.keys) == (held[0].low, held[0].high, held[0].keys):
            held.append(p)
        else:
            out.append(Pages([p]))
    return out


def plan(service: Service, low: int, high: int, size: int, window: int, tries: int = 5, pause: float = 0.5, keys: tuple[int, int] | None = None) -> list[Page]:
    """Pages that hold every record of the years once; as many count requests as parts, twice at most.

    keys: the first and last key there may be; with them a year beyond the window is halved by key.
    """
    total = patiently(lambda: service.count(low, high), tries, pause)
    if total <= window:
        return [Page(low, high, size, at) for at in range(0, total, size)]
    if low == high:
        return _by_key(service, low, size, window, tries, pause, keys[0] - 1, keys[1]) if keys else [Page(low, high, size, None)]
    middle = (low + high) // 2
    return plan(service, low, middle, size, window, tries, pause, keys) + plan(service, middle + 1, high, size, window, tries, pause, keys)


def _by_key(service: Service, year: int, size: int, window: int, tries: int, pause: float, after: int, most: int) -> list[Page]:
    """Pages of the records of a year whose keys lie behind `after`, up to `most`."""
    total = patiently(lambda: service.count(year, year, after=after, most=most), tries, pause)
    if total <= window:
        return [Page(year, year, size, at, (after, most)) for at in range(0, total, size)]
    if most - after < 2:
        raise ValueError(f"more than {window} records of {year} have the key {most}")
    middle = (after + most) // 2
    return [p for a, b in ((after, middle), (middle, most)) for p in _by_key(service, year, size, window, tries, pause, a, b)]


def read_paged(
    spark: SparkSession, service: Service, schema: str, key: str, low: int, high: int,
    size: int = 500, window: int = 15_000, tries: int = 5, pause: float = 0.5, keys: tuple[int, int] | None = None,
) -> DataFrame:
    """All records of the years low to high of a service, with the columns of schema.

    key is the column that pages are in order of; it tells where to go on in a year beyond the window,
    which one task walks unless keys (whole numbers, the first and the last there may be) are given.
    Pages are read when the frame is, a few by each task; no page gives no rows.
    """
    name, cores = f"paged_{uuid.uuid4().hex}", 4 * spark.sparkContext.defaultParallelism

    class Reader(DataSourceReader):
        def partitions(self) -> list[Pages]:
            # as many tasks as there are cores, if there are pages for them
            pages = plan(service, low, high, size, window, tries, pause, keys)
            return together(pages, max(1, min(TOGETHER, len(pages) // cores))) or [Pages([Page(low, high, 0, 0)])]

        def read(self, parts: Pages) -> Iterator[pa.RecordBatch]:
            for part in parts.pages:
                yield from self.one(part)

        def one(self, part: Page) -> Iterator[pa.RecordBatch]:
            if not part.limit:  # no records at all
                return
            if part.offset is not None:
                between = {"after": part.keys[0], "most": part.keys[1]} if part.keys else {}
                yield patiently(lambda: service.page(part.low, part.high, part.limit, part.offset, **between), tries, pause)
                return
            after = None
            while (batch := patiently(lambda: service.page(part.low, part.high, part.limit, after=after), tries, pause)).num_rows:
                yield batch
                after = batch.column(key)[batch.num_rows - 1].as_py()

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:  # noqa: ARG002
            return Reader()

    spark.dataSource.register(Paged)
    return spark.read.format(name).load()
