import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import queries, url_filter
from tests.llm import data
from tests.oracle import SF


def split(url):
    """Host and path by the definition."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :]).group()


def rule_of(host, path):
    best = None
    for verdict, rule in queries.URL_RULES:
        at, slash, begin = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith(slash + begin) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return best


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/7x?q#f", "http://example.com/en/8", "http://xexample.com/en/", "https://b.example.net/de/81", "https://b.example.net/de/7", "ftp://org/es/", "ftp://orga/es/", "http://ÄB.net/de/É", "http://h//a//b", "http://example.com/en/7", "http://h?x", "http://h#x"]


def test_hosts_paths_and_rules_by_the_definition(spark):
    rows = [(i, u, "rule", "v") for i, u in enumerate([*URLS, *URLS])] + [(None, URLS[4], None, None)]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, rule string, verdict string"), queries.URL_RULES).collect()
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    by = dict((i, u) for i, u, _, _ in rows)
    for r in got:
        host, path = split(by[r.page_id])
        fits = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, fits and fits[1])
        assert r.verdict == (fits[0] if fits else "allow") or not fits


def test_the_query_covers_all_pages(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op6_url_filter(spark, SF).collect()
    assert {r.page_id for r in got} == set(pages) and len(got) == len(pages)
    for r in got:
        host, path = split(pages[r.page_id])
        fits = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, fits and fits[1]) and r.verdict in ("allow", "block") and (not fits or r.verdict == fits[0])


def test_templates_of_a_small_tree(spark):
    """Bad and good directories stay apart, variable segments become wildcards, and purity is that of the labels with two neutral ones added."""
    rows = [(f"/good/item-{i}/x", 0) for i in range(40)] + [(f"/bad/item-{i}/y", 1) for i in range(40)] + [("/rare", 1)]
    got = url_filter.judge(spark.createDataFrame([(i, f"http://h{u}", b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int"), [], label_col="bad").collect()
    template = {r.path: r.template for r in got}
    assert {template[f"/good/item-{i}/x"] for i in range(40)}.isdisjoint({template[f"/bad/item-{i}/y"] for i in range(40)})
    sums = Counter()
    for r in got:
        sums[r.template, rows[r.page_id][1]] += 1
    for r in got:
        bad, all_ = sums[r.template, 1], sums[r.template, 0] + sums[r.template, 1]
        assert abs(r.purity - (bad + 1) / (all_ + 2)) < 1e-9 and r.verdict == ("block" if r.purity >= url_filter.REJECT else "allow")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, queries.URL_RULES).count() == 0


def test_the_stages_keep_what_they_should(spark):
    docs, seen = data.docs(spark), {}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, data.empty(spark), SF).count() == 0
        docs = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == data.empty(spark).columns
            docs = spark.createDataFrame(docs.collect(), data.SCHEMA)
        seen[name] = Counter(r.doc_id for r in docs.collect())
    rows = data.texts()
    letters = Counter(i for i, t, _ in rows if any(c.isalpha() for c in t or ""))
    assert seen["language_id"] == letters
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    first = {}
    for i, t, _ in rows:
        if any(c.isalpha() for c in t or ""):
            first[norm(t)] = min(first.get(norm(t), (True, 0)), (i is None, i or 0))
    assert seen["exact_copies"] == Counter(None if none else i for none, i in first.values())
    assert seen["near_copies"] == seen["exact_copies"] - Counter([50, 51, 52, 53])
    assert seen["benchmark_leaks"] == seen["near_copies"] and seen["sentencepiece"] == seen["benchmark_leaks"]


def test_stages_hand_texts_to_workers_in_small_batches(spark, monkeypatch):
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 400).alias("text"))  # 18 MB
    monkeypatch.setattr(corpus_pipeline.pieces, "encode", lambda docs, model: docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "bytes"]) for b in batches), "rows long, bytes long"))
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sum(r.rows for r in got) == 4000 and max(r.bytes for r in got) < 1.1 * corpus_pipeline.BATCH_BYTES
