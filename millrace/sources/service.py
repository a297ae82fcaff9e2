"""A record service as a source: predicates, fields and keys go to the service, and a stream takes up its numbered pages where it left off.

The service is a function ``fetch(request) -> JSON text``; requests are dictionaries:

* ``{"count": True, "where": [...]}`` is answered by ``{"count": n}``,
* ``{"where": [[column, operator, value], ...], "fields": [...], "offset": o, "limit": l}`` and ``{"keys": [...], "where": ..., "fields": ...}`` by ``{"rows": [[...], ...]}``,
* ``{"head": kind}`` by ``{"head": number of the newest page, or -1}``, ``{"page": number, "kind": kind, "fields": [...]}`` by rows.

``{"error": ...}`` fails the query. OSErrors are tried again, each time after twice the wait; ``Refused`` is not.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringStartsWith,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Fetch = Callable[[dict], str]

_OPERATORS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in", StringStartsWith: "starts", StringContains: "contains"}


class Refused(Exception):
    """The service holds the request itself to be wrong (4xx); to ask again is of no use."""


class Part(InputPartition):
    """One request, or several that follow each other."""

    def __init__(self, requests: list[dict]):
        self.requests = requests


def answered(fetch: Fetch, request: dict, attempts: int = 3, wait: float = 0.0) -> dict:
    for attempt in range(attempts):
        try:
            data = json.loads(fetch(request))
            break
        except OSError:
            if attempt == attempts - 1:
                raise
            time.sleep(wait * 2**attempt)
    if "error" in data:
        raise RuntimeError(f"{request}: {data['error']}")
    return data


def service(name: str, schema: StructType, fetch: Fetch, key: str | None = None, attempts: int = 3) -> type[DataSource]:
    """A data source class named ``name``. Comparisons, lists, prefixes and contained texts of one column go into the requests (see ``use_pushdown``);
    equality and lists on ``key`` are asked for in batches of keys instead of pages.

    Options: fields (columns to ask for, between commas; all by default), page (rows of a request, 1000), batch (keys of a request, 50),
    wait (seconds before the second attempt). Each request is a partition; their number comes from one count request.
    """

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str], fields: list[str]):
            self.page, self.batch, self.wait = int(options.get("page", "1000")), int(options.get("batch", "50")), float(options.get("wait", "0"))
            self.fields, self.where, self.keys = fields, [], None

        def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
            for f in filters:
                value, column = getattr(f, "value", None), f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
                plain = all(isinstance(v, (str, int, float, bool)) for v in (value if isinstance(f, In) else (value,)))
                if column == key and isinstance(f, (EqualTo, In)) and plain and key:
                    asked = dict.fromkeys(value if isinstance(f, In) else [value])
                    self.keys = list(asked) if self.keys is None else [k for k in self.keys if k in asked]
                elif column and type(f) in _OPERATORS and plain:
                    self.where.append([column, _OPERATORS[type(f)], list(value) if isinstance(f, In) else value])
                elif column and isinstance(f, IsNotNull):
                    self.where.append([column, "present", True])
                else:
                    yield f

        def partitions(self) -> list[InputPartition]:
            same = {"where": self.where, "fields": self.fields}
            if self.keys is not None:
                asks = [{"keys": self.keys[i : i + self.batch], **same} for i in range(0, len(self.keys), self.batch)]
            else:
                n = answered(fetch, {"count": True, "where": self.where}, attempts, self.wait)["count"]
                asks = [{"offset": i, "limit": self.page, **same} for i in range(0, n, self.page)]
            return [Part([a]) for a in asks] or [Part([])]

        def read(self, partition: Part) -> Iterator[tuple]:
            for request in partition.requests:
                yield from map(tuple, answered(fetch, request, attempts, self.wait)["rows"])

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            asked = [f.strip() for f in self.options.get("fields", "").split(",") if f.strip()]
            return StructType([schema[f] for f in asked]) if asked else schema

        def reader(self, schema: StructType) -> DataSourceReader:
            return Reader(self.options, schema.names)

    return Source


def use_pushdown(spark: SparkSession) -> None:
    """Let Spark hand filters to data sources in Python."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def lookups(keys: DataFrame, key: str, fetch: Fetch, schema: StructType, batch: int = 50, attempts: int = 3, wait: float = 0.0) -> DataFrame:
    """What the service has of the distinct keys of a table, asked for in batches by the tasks that hold them. Null keys are not asked for."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for b in batches:
            held += b.column(0).to_pylist()
            while len(held) >= batch:
                yield rows(held[:batch])
                held = held[batch:]
        if held:
            yield rows(held)

    def rows(asked: list) -> pa.RecordBatch:
        return _batch(answered(fetch, {"keys": asked, "where": [], "fields": schema.names}, attempts, wait)["rows"], schema)

    return keys.select(F.col(key)).where(F.col(key).isNotNull()).distinct().mapInArrow(ask, schema)


def prefix_lookups(asked: DataFrame, area: str, prefix: str, part: str, fetch: Fetch, schema: StructType, batch: int = 20, attempts: int = 3, wait: float = 0.0) -> DataFrame:
    """What the service has of an area where one of up to ``batch`` (prefix and contained text) pairs holds in each request.

    The distinct pairs are dealt out by ranges of (area, prefix, text), so an area with many of them is asked for by many tasks and each request
    is of one area. A record that several pairs of different requests find is there several times.
    """
    distinct = asked.select(area, prefix, part).where(" and ".join(f"`{c}` is not null" for c in (area, prefix, part))).distinct()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []
        for b in batches:
            for a, p, t in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if held and (a != place or len(held) == batch):
                    yield rows(place, held)
                    held = []
                place = a
                held.append([p, t])
        if held:
            yield rows(place, held)

    def rows(place: object, pairs: list) -> pa.RecordBatch:
        request = {"where": [[area, "=", place]], "any": pairs, "fields": schema.names}
        return _batch(answered(fetch, request, attempts, wait)["rows"], schema)

    return distinct.repartitionByRange(area, prefix, part).sortWithinPartitions(area, prefix, part).mapInArrow(ask, schema)


def _batch(rows: list, schema: StructType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, to_arrow_schema(schema), strict=True)], schema.names)


def pages_stream(name: str, schema: StructType, fetch: Fetch, kinds: list[str], cursor: tuple[Callable[[], dict], Callable[[dict], None]] | None = None, attempts: int = 3) -> type[DataSource]:
    """A streaming data source of numbered pages of several kinds, each with an offset of its own: the number of the last page taken.

    A batch has the pages between two offsets, each read by one task. A page that fails fails its batch, so the offset stays before it and the
    batch is read again when the query is started again; nothing is skipped. Options: most (pages of a kind in a batch; what is over waits for
    the next one), wait.

    ``cursor`` (load, save) keeps the ends of planned batches outside of the checkpoint, for Spark does not tell a source where it starts: ``most`` goes by
    them after a restart, and a head that has gone back holds the offset where it is. They are saved once Spark has logged a batch, so they are never
    behind its start. Without a cursor, neither is known until the first batch is planned.
    """

    class Reader(DataSourceStreamReader):
        def __init__(self, options: dict[str, str], fields: list[str]):
            self.fields, self.wait, self.most = fields, float(options.get("wait", "0")), int(options.get("most", "0"))
            self.reached: dict = {}

        def initialOffset(self) -> dict:
            return dict.fromkeys(kinds, -1)

        def latestOffset(self) -> dict:
            heads = {k: answered(fetch, {"head": k}, attempts, self.wait)["head"] for k in kinds}
            start = self.reached or (cursor[0]() if cursor else {})
            heads = {k: max(h, start.get(k, -1)) for k, h in heads.items()}
            return {k: min(h, start.get(k, -1) + self.most) for k, h in heads.items()} if self.most and start else heads

        def partitions(self, start: dict, end: dict) -> list[InputPartition]:
            self.reached = end
            if cursor:
                cursor[1](end)
            return [Part([{"page": n, "kind": k, "fields": self.fields}]) for k in kinds for n in range(start.get(k, -1) + 1, end.get(k, -1) + 1)]

        def read(self, partition: Part) -> Iterator[tuple]:
            for request in partition.requests:
                yield from map(tuple, answered(fetch, request, attempts, self.wait)["rows"])

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            return schema

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return Reader(self.options, schema.names)

    return Source
