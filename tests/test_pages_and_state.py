import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import sampling, snapshots
from millrace.sources import markup
from millrace.streaming import state

PAGE = """<html><!-- <p>no</p> --><title>Case 12</title><script>if (a<b) x("<p>")</script><nav id=m><a href="/x">Home</a></nav>
<div class="info"><b>Filed:</b> March 4, 2024 <b>Judge :</b><b>Open:</b><i>Ann &amp; Bo</i></div>loose
<table><tr><th>Name</th><th>Role</th></tr><TR><td>Mary <i>Doe</i></td><td></td></TR><tr>none</tr><tr><td>J. Roe<td>heir</tr></table>on February 30, 2020 and January 9, 2023<p>"""


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_nodes_have_their_tag_and_region(spark):
    found = one(spark, markup.nodes(F.lit(PAGE), {"menu": r"<nav\b[^>]*>", "info": '<div class="info">', "table": "<table>"}))
    assert [tuple(n) for n in found][:6] == [("", "<title>", "Case 12"), ("menu", '<a href="/x">', "Home"), ("info", "<b>", "Filed:"), ("info", "<b>", "March 4, 2024"), ("info", "<b>", "Judge :"), ("info", "<b>", "Open:")]
    assert ("info", "<i>", "Ann & Bo") in found and ("info", "<i>", "loose") in found and ("table", "<i>", "Doe") in found
    assert one(spark, markup.nodes(F.lit(None).cast("string"), {})) == [] == one(spark, markup.nodes(F.lit("<p><br></p>"), {}))
    assert [tuple(n) for n in one(spark, markup.nodes(F.lit("a < b\x01\x02c"), {"x": "<x>"}))] == [("", "", "a < b c")]
    long = one(spark, markup.nodes(F.lit("<p>x</p>" * 50_000), {"p": "<q>"}))
    assert len(long) == 50_000


def test_pairs_rows_and_dates(spark):
    got = one(spark, markup.pairs(markup.nodes(F.lit(PAGE.replace("<b>Open:</b><i>", "<b>Open:</b><span>")), {}), "^<b>"))
    assert [tuple(p) for p in got][:2] == [("Filed", None), ("March 4, 2024", None)], "text after a closing tag still has that tag"
    table = one(spark, markup.pairs(markup.nodes(F.lit("<dl><dt>Filed:</dt><dd>May 1</dd><dt>Judge</dt><dt>Court :</dt><dd>B</dd><dt>End"), {}), "^<dt"))
    assert [tuple(p) for p in table] == [("Filed", "May 1"), ("Judge", None), ("Court", "B"), ("End", None)]
    assert one(spark, markup.rows(F.lit(PAGE))) == [["Name", "Role"], ["Mary Doe", ""], ["J. Roe", "heir"]]
    assert one(spark, markup.rows(F.lit("no table"))) == [] and one(spark, markup.rows(F.lit(None).cast("string"))) == []
    assert one(spark, markup.earliest(F.lit(PAGE), r"([A-Z][a-z]+ \d+, \d{4})", "MMMM d, yyyy")) == dt.date(2023, 1, 9)
    assert one(spark, markup.earliest(F.lit("none"), r"(\d+)", "yyyy")) is None


def test_a_sample_is_the_same_under_any_partitioning_and_keeps_floor_and_cap(spark):
    rows = [(i % 3 if i < 900 else (None if i < 903 else 7), i) for i in range(904)]
    draw = lambda n, seed=1: sorted(sampling.stratified(spark.createDataFrame(rows, "s int, id int").repartition(n), ["s"], ["id"], 0.01, 5, 8, seed).collect(), key=str)
    a = draw(1)
    assert a == draw(7) != draw(7, seed=2)
    counts = {}
    for r in a:
        counts[r.s] = counts.get(r.s, 0) + 1
        assert r.taken == min(r.rows, 8, max(5, -(-r.rows // 100)))
    assert counts == {0: 5, 1: 5, 2: 5, None: 3, 7: 1}
    assert sampling.stratified(spark.createDataFrame([], "s int, id int"), ["s"], ["id"]).count() == 0


def test_a_sample_of_few_leaves_a_task(spark):
    plan = sampling.stratified(spark.range(1000).selectExpr("id", "id % 3 as s"), ["s"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def stamp(folder):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def test_a_batch_rewrites_only_the_buckets_it_touches_and_never_twice(spark, tmp_path):
    kept = state.history(str(tmp_path / "s"), "k", "long", "long", buckets=16)
    batches = [[(i, i * 10, 1) for i in range(100)], [(3, 31, 2), (3, 32, 3), (500, 1, 1), (None, 1, 1)], [(3, 40, 4)]]
    whole = spark.createDataFrame([], kept.schema)
    apply = lambda old, rows: snapshots.upsert(old, rows, "k", "v", F.lit("2024-01-02").cast("date"), "o")
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "k long, v long, o int")
        before = stamp(tmp_path / "s")
        kept.apply(df, n, apply)
        after = stamp(tmp_path / "s")
        assert all(after[f] == t for f, t in before.items()), "no file of an earlier batch is written again"
        data = {f.split("/b=")[1].split("/")[0] for f in set(after) - set(before) if "/data/" in f}
        assert len(data) == (16 if n == 0 else len(data)) and (n == 0 or len(data) <= 2)
        whole = apply(whole, df.where("k is not null"))
        want = sorted(map(tuple, whole.collect()))
        assert sorted(map(tuple, kept.read(spark, n).collect())) == want
        kept.apply(spark.createDataFrame([(1, -1, 9)], "k long, v long, o int"), n, apply)
        assert stamp(tmp_path / "s") == after, "a batch that runs again changes nothing"
    assert {r.k: (r.current, r.previous, r.delta) for r in kept.read(spark, 2).where("k = 3").collect()} == {3: (40, 32, 8)}
    with pytest.raises(ValueError, match="missing"):
        kept.apply(df, 9, apply)


def test_a_stream_keeps_the_state_of_its_batches(spark, tmp_path):
    r = random.Random(1)
    rows = [(r.randrange(30), r.randrange(100), i) for i in range(200)]
    for i in range(4):
        spark.createDataFrame(rows[50 * i : 50 * i + 50], "k long, v long, o int").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    kept = state.history(str(tmp_path / "s"), "k", "long", "long", buckets=8)
    for i in range(4):
        stream = spark.readStream.schema("k long, v long, o int").parquet(str(tmp_path / f"in/[0-{i}]"))
        state.keep_history(stream, kept, str(tmp_path / "c"), "v", "o", "2024-01-02")
    got = {x.k: (x.current, x.previous) for x in kept.read(spark, 3).collect()}
    want = {}
    for k, v, _ in rows:
        want[k] = (v, want.get(k, (None, None))[0])
    assert got == want


def test_ties_of_the_ordinal_and_ordinals_of_any_type(spark):
    empty = spark.createDataFrame([], "k long, first_seen date, last_seen date, current long, previous long, delta long")
    day = F.lit("2024-01-02").cast("date")
    got = snapshots.upsert(empty, spark.createDataFrame([(1, 5, 1, 2), (1, 9, 1, 1), (2, 7, 1, 1), (2, 7, 1, 1), (3, 4, None, 1)], "k long, v long, o int, t int"), "k", "v", day, "o")
    assert {r.k: (r.current, r.previous, r.delta) for r in got.collect()} == {1: (9, 5, 4), 2: (7, 7, 0), 3: (4, None, None)}
    by_tie = snapshots.upsert(empty, spark.createDataFrame([(1, 5, 1, 2), (1, 9, 1, 1)], "k long, v long, o int, t int"), "k", "v", day, "o", "t").first()
    assert (by_tie.current, by_tie.previous) == (5, 9)
    times = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "a"), (1, dt.datetime(2024, 1, 2), "b"), (1, None, "c"), (2, None, "d")], "k int, ts timestamp, v string")
    assert {r.k: r.v for r in snapshots.last_wins(times, ["k"], "ts").collect()} == {1: "b", 2: "d"}
    words = spark.createDataFrame([(1, "b", 1), (1, "a", 2)], "k int, o string, v int")
    assert snapshots.last_wins(words, ["k"], "o").first().v == 1
