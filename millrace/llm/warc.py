"""Operator 5, WARC: writing archives, reading their records, and transaction assembly.

``write`` makes three records of each page: a response (or, if another page has the same payload, a revisit of that one), a request
and a metadata record; the latter two name the first in ``WARC-Concurrent-To``. Each record is a gzip member of its own, as WARC
readers expect. ``read`` lists a folder of archives and gives a row for each record, whoever wrote it. ``assemble`` joins requests
and metadata to the response or revisit that they are concurrent to, and revisits to the response that they refer to, and emits one
nested row for each capture.

Every row has a record of its own. Among pages with equal payloads of ``least`` bytes or more, the one with the largest id is the
response, and of rows that share that id the one with the largest url. Payloads are told apart by their SHA-1, their SHA-256 and
their length, and combined before the shuffle, so a payload that a third of all pages share travels once for each task; what such
pages have besides is joined by ``weighed_join``, and equal rows are counted first and dealt out again.

Defined results: null payloads are empty; rows that repeat, or have no id, get a record each; null ids come before all others; a null url is
written as an empty one, and line ends in urls as spaces; an empty table makes no archives and reads as no rows. A request or
metadata record that is concurrent to no response or revisit in the archives is left out of the assembly; of several that name the
same one, the one with the smallest record id is nested, and ``n_requests`` and ``n_metadata`` count them all.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SALTS, cut, new_folder, shuffled, weighed_join

SUFFIX, FILE_BYTES = ".warc.gz", 16 << 20
#: Equal rows of a table that are written at once.
CHUNK = 1000
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL name space of RFC 4122
_DATE = "1970-01-01T00:00:00Z"
RECORD = "record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, content_type string, payload_digest string, payload_bytes long, fields map<string,string>, payload binary"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>"


def record(kind: str, rid: str, uri: str, content_type: str, block: bytes, **headers: str | None) -> bytes:
    """A WARC/1.1 record as a gzip member. Line ends in header values become spaces."""
    lines = {"WARC-Type": kind, "WARC-Record-ID": rid, "WARC-Date": _DATE, "WARC-Target-URI": uri, **{k.replace("_", "-"): v for k, v in headers.items()}, "Content-Type": content_type, "Content-Length": str(len(block))}
    head = "".join(f"{k}: {' '.join(v.splitlines())}\r\n" for k, v in lines.items() if v is not None)
    deflate = zlib.compressobj(3, zlib.DEFLATED, 31)
    return deflate.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n") + deflate.compress(block) + deflate.compress(b"\r\n\r\n") + deflate.flush()


def members(data: bytes) -> Iterator[bytes]:
    """The contents of the gzip members of a file; each byte is looked at once."""
    view, at, step = memoryview(data), 0, 1 << 16
    while at < len(data):
        inflate, out = zlib.decompressobj(31), []
        while not inflate.eof:
            piece = view[at : at + step]
            if not len(piece):
                raise ValueError("a gzip member has no end")
            out.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        yield b"".join(out)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of the records in the contents of a file or member."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        headers = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers.get("content-length", 0))
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> DataFrame:
    """What to write: id, url, sha1, payload, first_id, first_url, first, times.

    Each row stands for the ``times`` equal rows of ``pages`` numbered from ``first`` on. ``payload`` is null for revisits, which refer to
    row 0 of (first_id, first_url, sha1); among equal payloads of ``least`` bytes or more that is the row with the largest id,
    and of several with that id the one with the largest url."""
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{url_col}`"), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "sha2": F.sha2("payload", 256), "size": F.octet_length("payload")})
    small = F.when(F.col("size") < least, F.col("payload"))
    keys = cut(rows.groupBy("id", "url", "sha1", "sha2", "size", small.alias("small")).agg(F.count(F.lit(1)).alias("times")), "captures")
    same = ["sha1", "sha2", "size"]
    groups = keys.where("small is null").groupBy(*same).agg(F.max(F.struct("id", "url")).alias("best"), F.sum("times").alias("all"), F.count(F.lit(1)).alias("members"))
    groups = cut(groups.select(*same, F.col("best.id").alias("first_id"), F.col("best.url").alias("first_url"), "all", "members"), "groups")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    # Only one row for each payload (and task) carries it through a shuffle, however many pages share it.
    held = rows.where(F.col("size") >= least).groupBy(*same).agg(F.first("payload").alias("payload"))
    responses = groups.join(held, same).select(F.col("first_id").alias("id"), F.col("first_url").alias("url"), "sha1", "payload", "first_id", "first_url", zero.alias("first"), one.alias("times"))
    shared = weighed_join(keys.where("small is null"), groups.where(F.col("all") > 1).drop("all"), same, "members")
    chief = F.when(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("url") == F.col("first_url")), one).otherwise(zero)
    revisits = shared.select("id", "url", "sha1", F.lit(None).cast("binary").alias("payload"), "first_id", "first_url", chief.alias("first"), (F.col("times") - chief).alias("times"))
    alone = keys.where("small is not null").select("id", "url", "sha1", F.col("small").alias("payload"), F.col("id").alias("first_id"), F.col("url").alias("first_url"), zero.alias("first"), "times")
    both = revisits.unionByName(alone).where("times > 0")
    # Rows that stand for many are dealt out, so that one page which fills a third of the table is no single task's work.
    step = F.explode(F.sequence(zero, F.col("times") - 1, F.lit(CHUNK).cast("long"))).alias("step")
    many = both.where(F.col("times") > CHUNK).select("*", step)
    many = many.withColumns({"first": F.col("first") + F.col("step"), "times": F.least(F.lit(CHUNK).cast("long"), F.col("times") - F.col("step"))}).drop("step")
    return responses.unionByName(both.where(F.col("times") <= CHUNK)).unionByName(many.repartition("id", "url", "sha1", "first"))


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, folder: str | None = None) -> str:
    """Write the pages as archives of about FILE_BYTES to a folder of the shared store, and return the folder."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    rows = captures(pages, id_col, url_col, payload_col, least).withColumn("part", F.spark_partition_id())
    rows = rows.sortWithinPartitions("id", "url", "sha1", "first")  # a task that runs again writes the same files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = pafs.FileSystem.from_uri(folder)
        store.create_dir(at, recursive=True)
        held, size, seq, part = [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, seq
            temporary = f"{at}/_{uuid.uuid4().hex}"
            with store.open_output_stream(temporary) as f:
                for x in held:
                    f.write(x)
            store.move(temporary, f"{at}/part-{part:07d}-{seq:07d}{SUFFIX}")
            out = pa.RecordBatch.from_pydict({"records": [len(held)], "bytes": [size]})
            held, size, seq = [], 0, seq + 1
            return out

        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                for page, url, sha1, payload, first_id, first_url, first, times, part in zip(*(c.to_pylist() for c in whole.slice(i, 256).columns), strict=True):
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    host, _, path = url.partition("://")[2].partition("/")
                    for nth in range(first, first + times):
                        name = f"{page}:{nth}:{sha1}:{url}"
                        rid = record_id(f"page:{name}")
                        if payload is not None:
                            http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
                            main = record("response", rid, url, "application/http;msgtype=response", http + payload, WARC_Payload_Digest=f"sha1:{digest}")
                        else:
                            http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
                            main = record("revisit", rid, url, "application/http;msgtype=response", http, WARC_Payload_Digest=f"sha1:{digest}", WARC_Refers_To=record_id(f"page:{first_id}:0:{sha1}:{first_url}"), WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
                        ask = record("request", record_id(f"request:{name}"), url, "application/http;msgtype=request", f"GET /{path.partition('#')[0]} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode(), WARC_Concurrent_To=rid)
                        meta = record("metadata", record_id(f"metadata:{name}"), url, "application/warc-fields", b"" if page is None else f"page: {page}\r\n".encode(), WARC_Concurrent_To=rid)
                        held += [main, ask, meta]
                        size += len(main) + len(ask) + len(meta)
                        if size >= FILE_BYTES:
                            yield flush()
        if held:
            yield flush()

    rows.mapInArrow(run, "records long, bytes long").agg(F.sum("records")).collect()
    return folder


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """A row for each record of the ``.warc`` and ``.warc.gz`` files of a folder.

    ``payload`` is what follows the HTTP header of a response, revisit or request, or else the block; it is null without
    ``payloads``. ``payload_digest`` is the SHA-1 in base32 of a payload that is there, and what the header states for a revisit.
    ``fields`` has the lines of an ``application/warc-fields`` block.
    """
    store, at = pafs.FileSystem.from_uri(folder)
    if store.get_file_info(at).type == pafs.FileType.NotFound:
        return spark.createDataFrame([], RECORD)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc{,.gz}").load(folder).select("path", "content")

    def rows(headers: dict[str, str], block: bytes) -> dict:
        kind, content = headers.get("warc-type"), headers.get("content-type", "")
        payload = block.partition(b"\r\n\r\n")[2] if content.startswith("application/http") else block
        stated = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
        fields = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n")) if k.strip()] if content == "application/warc-fields" else []
        return {"record_id": headers.get("warc-record-id"), "type": kind, "concurrent_to": headers.get("warc-concurrent-to"), "refers_to": headers.get("warc-refers-to"), "target_uri": headers.get("warc-target-uri"), "date": headers.get("warc-date"), "content_type": content, "payload_digest": stated if kind == "revisit" else sha1_base32(payload), "payload_bytes": len(payload), "fields": dict(fields), "payload": payload if payloads else None}

    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = {"payload_bytes": pa.int64(), "fields": pa.map_(pa.string(), pa.string()), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                data, held, size = b.column(1)[i].as_py(), [], 0
                for part in members(data) if data[:2] == b"\x1f\x8b" else (data,):
                    for headers, block in parse(part):
                        held.append(rows(headers, block))
                        size += len(block) * payloads + 500
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return files.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each response or revisit: record_id, type, target_uri, payload_digest, payload_bytes (both of
    the full payload), payload (null for revisits), refers_to, original (of the response that a revisit refers to), request, metadata, n_requests, n_metadata."""
    side = ["record_id", "target_uri", "date", "content_type", "payload", "fields"]

    def concurrent(kind: str, name: str) -> DataFrame:
        mine = records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        return mine.groupBy(F.col("concurrent_to").alias("record_id")).agg(F.min_by(F.struct(*side), "record_id").alias(name), F.count(F.lit(1)).alias(f"n_{name}"))

    main = records.where(F.col("type").isin("response", "revisit")).drop("concurrent_to", "fields")
    request, metadata = concurrent("request", "request").withColumnRenamed("n_request", "n_requests"), concurrent("metadata", "metadata")
    whole = main.join(request, "record_id", "left").join(metadata, "record_id", "left").fillna(0, ["n_requests", "n_metadata"])
    whole = cut(whole, "captures")
    first = whole.where("type = 'response'").select(F.col("record_id").alias("refers_to"), F.struct("target_uri", "payload_bytes", "payload_digest", "metadata").alias("original"))
    revisits = whole.where("type = 'revisit'")
    # Only what revisits refer to is repeated for the salts, and it holds no payloads.
    first = first.join(revisits.select("refers_to").distinct(), "refers_to", "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    revisits = revisits.withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int")).join(shuffled(first), ["refers_to", "salt"], "left").drop("salt")
    both = revisits.unionByName(whole.where("type <> 'revisit'"), allowMissingColumns=True)
    return both.select("record_id", "type", "target_uri", "date", F.coalesce("original.payload_digest", "payload_digest").alias("payload_digest"), F.coalesce("original.payload_bytes", "payload_bytes").alias("payload_bytes"), F.when(F.col("type") == "response", F.col("payload")).alias("payload"), "refers_to", "original", "request", "metadata", "n_requests", "n_metadata")
