import base64
import hashlib
from collections import Counter

import pytest

from millrace.llm import queries, warc
from tests.oracle import SF

SCHEMA = "page_id long, url string, html string, record_id string, type string, payload string, part int, first long"
ROWS = [
    (1, "http://a.com/x", "same"), (2, "http://a.com/y", "same"), (2, "http://a.com/z", "same"), (2, "http://a.com/z", "same"), (3, "http://b.com/", "other"),
    (3, "http://b.com/", "and more"), (4, None, None), (5, "http://c", ""), (None, "http://d/1", "same"), (None, "http://d/2", "no number"), (None, "http://d/2", "no number"),
    (6, "http://e/ü?q=1#f", "é\r\n\r\nWARC/1.0\r\n\r\n"), (7, "no scheme", "x" * 300_000), (8, "http://line\r\nend/", "same"), (None, None, None),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "r", "t", "p", 1, 2) for r in rows], SCHEMA)


def expected(rows, least=0):
    """By the definition: page, payload's bytes and digest, type, the response's page."""
    best = {}
    for i, _, html in rows:
        best[html or ""] = max(best.get(html or "", -1), -1 if i is None else i)
    out, seen = Counter(), set()
    for i, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        chief = (-1 if i is None else i) == best[html or ""] and html not in seen and (html or "") not in seen
        if len(data) < least:
            out[i, len(data), digest, "response", None] += 1
        elif chief:
            seen.add(html or "")
            out[i, len(data), digest, "response", None] += 1
        else:
            out[i, len(data), digest, "revisit", None if best[html or ""] == -1 else best[html or ""]] += 1
    return out


def told(captures):
    page = lambda m: int(m.fields["page"]) if m and "page" in m.fields else None
    return Counter((page(r.metadata), r.payload_bytes, r.payload_digest, r.type, page(r.original.metadata) if r.original else None) for r in captures)


@pytest.mark.parametrize("least", [0, 5])
@pytest.mark.parametrize("chunk", [1000, 1])
def test_every_row_has_a_record_that_comes_back(spark, monkeypatch, least, chunk):
    monkeypatch.setattr(warc, "CHUNK", chunk)
    captures = warc.assemble(warc.read(spark, warc.write(pages(spark), least=least))).collect()
    assert told(captures) == expected(ROWS, least) and len(captures) == len(ROWS)
    assert len({r.record_id for r in captures}) == len(ROWS) and all(r.n_requests == r.n_metadata == 1 for r in captures)
    assert Counter(r.target_uri for r in captures) == Counter(" ".join((u or "").splitlines()) for _, u, _ in ROWS)
    assert Counter(bytes(r.payload).decode() for r in captures if r.type == "response") == Counter(h or "" for h in [*{h or "" for _, _, h in ROWS if len((h or "").encode()) >= least}, *(h for _, _, h in ROWS if len((h or "").encode()) < least)])


def test_hot_payloads_go_the_salted_way(spark, monkeypatch):
    rows = [(i, f"http://h/{i % 7}", "one page of a template") for i in range(60)] + ROWS
    monkeypatch.setattr("millrace.llm.common.HOT", 10)
    monkeypatch.setattr("millrace.llm.common.BROADCAST_ROWS", 0)
    got = warc.assemble(warc.read(spark, warc.write(pages(spark, rows)))).collect()
    assert told(got) == expected(rows)


def test_the_query_by_the_definition(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()
    got = queries.op5_warc(spark, SF).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected([tuple(r) for r in table])


def test_an_empty_table_has_no_records(spark):
    assert warc.assemble(warc.read(spark, warc.write(pages(spark, [])))).count() == 0


def test_archives_of_others_are_read(spark, tmp_path):
    response = warc.record("response", "<urn:uuid:1>", "http://x/", "application/http;msgtype=response", b"HTTP/1.1 200 OK\r\n\r\nbody")
    ask = warc.record("request", "<urn:uuid:2>", "http://x/", "application/http;msgtype=request", b"GET / HTTP/1.1\r\n\r\n", WARC_Concurrent_To="<urn:uuid:1>")
    stray = warc.record("metadata", "<urn:uuid:3>", "http://x/", "application/warc-fields", b"a: b\r\n", WARC_Concurrent_To="<urn:uuid:9>")
    lost = warc.record("revisit", "<urn:uuid:4>", "http://y/", "application/http;msgtype=response", b"HTTP/1.1 200 OK\r\n\r\n", WARC_Refers_To="<urn:uuid:8>", WARC_Payload_Digest="sha1:ABC")
    (tmp_path / "a.warc.gz").write_bytes(response + ask)
    (tmp_path / "b.warc").write_bytes(b"".join(warc.members(stray + lost)))
    got = {r.record_id[-2]: r for r in warc.assemble(warc.read(spark, f"file://{tmp_path}")).collect()}
    assert set(got) == {"1", "4"} and bytes(got["1"].payload) == b"body" and got["1"].n_requests == 1 and got["1"].metadata is None
    assert got["4"].payload_digest == "ABC" and got["4"].original is None
