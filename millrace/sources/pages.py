"""A paged reader as a Python data source: pages of captured responses as partitions."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class PageRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def paged(name: str, schema: str, fetch: Callable[[int], str | None], attempts: int = 3) -> type[DataSource]:
    """A data source class named ``name``. ``fetch(page)`` gives a page as JSON with ``rows`` (or ``error``), or None past the end.

    Options: pages (how many there are; required), per_partition, wait (seconds before the second attempt, twice as long before each
    further one). Pages are read in parallel by ranges. A page that fails is tried again; an error envelope fails the query, and so
    does a source that goes on after its last page.
    """

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str]):
            if "pages" not in options:
                raise ValueError("option pages is required: the number of pages of the source")
            self.pages, self.per = int(options["pages"]), int(options.get("per_partition", "1"))
            self.wait = float(options.get("wait", "0"))

        def partitions(self) -> list[InputPartition]:
            return [PageRange(a, min(a + self.per, self.pages)) for a in range(0, self.pages, self.per)]

        def read(self, partition: PageRange) -> Iterator[tuple]:
            for page in range(partition.first, partition.last):
                for attempt in range(attempts):
                    try:
                        body = fetch(page)
                        break
                    except OSError:
                        if attempt == attempts - 1:
                            raise
                        time.sleep(self.wait * 2**attempt)
                if body is None:
                    return
                data = json.loads(body)
                if "error" in data:
                    raise RuntimeError(f"page {page}: {data['error']}")
                for row in data["rows"]:
                    yield tuple(row)
            if partition.last == self.pages and fetch(self.pages) is not None:
                raise RuntimeError(f"the source has more than {self.pages} pages")

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

    return Source


def register(spark: SparkSession, source: type[DataSource]) -> None:
    spark.dataSource.register(source)
