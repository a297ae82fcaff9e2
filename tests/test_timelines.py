import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import episodes, ordered
from millrace.streaming import episodes as streamed
from millrace.streaming.jobs import run_to_end

DAY = dt.datetime(2024, 3, 1)


def at(hours):
    return DAY + dt.timedelta(hours=hours)


def events(seed, n=400, keys=3):
    r = random.Random(seed)
    return [(r.randrange(keys), r.choice("ab"), at(r.choice([r.uniform(0, 200), r.randrange(200)])), i, r.random() < 0.6) for i in range(n)]


SCHEMA = "k long, kind string, ts timestamp, tie long, opens boolean"
TTL = {"a": 5 * 3600, "b": None}


def fold(rows, as_of):
    """Episodes by going through a key's events in order."""
    out, open_ = [], {}

    def expire(key, now, strict=False):
        o = open_.get(key)
        ttl = TTL[key[1]]
        if o and ttl is not None and o[1] + dt.timedelta(seconds=ttl) < now:
            out.append((*key, *o, o[1] + dt.timedelta(seconds=ttl), "expired"))
            del open_[key]

    for k, kind, ts, _, opens in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[2], r[3])):
        key = (k, kind)
        expire(key, ts)
        o = open_.get(key)
        if opens:
            open_[key] = (o[0] if o else ts, ts, (o[2] if o else 0) + 1)
        elif o:
            out.append((*key, *o, ts, "closed"))
            del open_[key]
    for key in list(open_):
        expire(key, as_of)
        if key in open_:
            out.append((*key, *open_[key], None, "open"))
    return sorted(out, key=str)


def batch(df, as_of, hours=24):
    ttl = F.when(F.col("kind") == "a", TTL["a"])
    got = episodes.episodes(df, ["k", "kind"], "ts", "tie", F.col("opens"), ttl, F.lit(as_of), hours)
    return sorted((tuple(r) for r in got.select("k", "kind", "opened", "refreshed", "opens", "ended", "status").collect()), key=str)


@pytest.mark.parametrize("hours", [1, 24, 10_000])
def test_episodes_are_those_of_a_fold_whatever_the_buckets(spark, hours):
    rows = events(hours) + [(None, "a", at(1), 10_000, True), (9, "a", at(0), 10_001, False), (9, "a", at(1), 10_002, True), (9, "a", at(6), 10_003, False), (9, "a", at(6), 10_004, False), (9, "a", at(6), 10_005, True)]
    want = fold(rows, at(203))
    assert batch(spark.createDataFrame(rows, SCHEMA), at(203), hours) == want
    assert {r[-1] for r in want} == {"open", "closed", "expired"}


def test_the_stream_ends_as_the_batch_does_late_and_reopened_keys_included(spark, tmp_path):
    streamed.use_state_store(spark)
    rows = sorted(events(7, 300), key=lambda r: (r[2], r[3]))
    r = random.Random(3)
    cuts = [rows[i : i + 60] for i in range(0, len(rows), 60)]
    for a, b in zip(cuts, cuts[1:], strict=False):  # out of order within what the watermark allows
        for _ in range(5):
            i, j = r.randrange(len(a) - 8, len(a)), r.randrange(8)
            a[i], b[j] = b[j], a[i]
    too_late = [(1, "a", at(1), 90_000, True), (1, "b", at(2), 90_001, False)]
    flush = [(77, "a", at(5000), 95_000, True), (77, "a", at(9000), 95_001, False)]
    folder = str(tmp_path / "in")
    for i, some in enumerate([*cuts, too_late, flush[:1], flush[1:]]):
        spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{i:03}")
    # As its files come, in order of their folders: every run of the stream takes one more.
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for i in range(len(cuts) + 3):
        stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/00[0-{i}]")
        stream = stream.withColumn("ttl", F.when(F.col("kind") == "a", TTL["a"]))
        ended = streamed.episodes(stream, ["k", "kind"], "ts", "tie", "opens", "ttl", "30 hours")
        ended.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = sorted((tuple(x) for x in spark.read.parquet(out).where("k < 77").select("k", "kind", "opened", "refreshed", "opens", "ended", "status").collect()), key=str)
    want = [x for x in batch(spark.createDataFrame(rows, SCHEMA), at(5000)) if x[-1] != "open"]
    assert got == want and len(got) == len({x[:3] for x in got})


def test_running_and_previous_rows(spark):
    rows = [(r.k, r.ts, r.tie) for r in spark.createDataFrame(events(5), SCHEMA).collect()]
    df = spark.createDataFrame(rows, "k long, ts timestamp, tie long")
    for ahead in (False, True):
        got = {r.tie: r for r in ordered.running(df, ["k"], ["ts", "tie"], ordered.buckets("ts", 7), {"n": ("sum", F.lit(1)), "hi": ("max", F.col("tie")), "lo": ("min", F.col("tie"))}, ahead).collect()}
        for k, ts, tie in rows:
            before = [t for k2, ts2, t in rows if k2 == k and (((ts2, t) > (ts, tie)) if ahead else ((ts2, t) < (ts, tie)))]
            assert (got[tie].n, got[tie].hi, got[tie].lo) == (len(before), max(before, default=None), min(before, default=None))


def test_distinct_within_is_that_of_looking_back_from_every_row(spark):
    rows = [(k, kind, ts) for k, kind, ts, _, _ in events(8)] + [(0, None, at(3)), (None, "a", at(3))]
    df = spark.createDataFrame([(k, f"{kind}{int(ts.timestamp()) % 7}" if kind else None, ts) for k, kind, ts in rows], "k long, v string, ts timestamp")
    all_rows = [tuple(r) for r in df.collect() if r.v is not None and r.k is not None]
    want = {(k, ts, len({v2 for k2, v2, ts2 in all_rows if k2 == k and ts - dt.timedelta(hours=9) <= ts2 <= ts})) for k, _, ts in all_rows}
    for hours in (1, 24, 5000):
        got = ordered.distinct_within(df, ["k"], "v", "ts", 9 * 3600, hours).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_lifecycle_conflicts_both_ways_and_double_closings(spark):
    rows = [(1, 1, 1, "s"), (1, 2, 2, "s"), (1, 3, 0, "c"), (1, 4, 0, "c"), (1, 5, 3, "s"), (2, 1, 3, "s"), (2, 2, 1, "s"), (2, 3, 2, "s"), (3, 1, 0, "c"), (3, 2, 1, "s"), (4, 1, 1, "s"), (4, 1, 1, "s")]
    df = spark.createDataFrame([(k, at(h), 100 * k + i, stage, what == "c") for i, (k, h, stage, what) in enumerate(rows)], "k long, ts timestamp, tie long, stage int, closes boolean")
    for hours in (1, 24):
        got = {r.tie: (r.status, r.closed_by, r.conflict) for r in episodes.lifecycles(df, "k", "ts", "tie", F.col("stage"), F.col("closes"), F.lit(3600), F.lit(at(4)), hours).collect()}
        assert got[100] == ("closed", 102, None) and got[101] == ("closed", 102, None) and got[102][0] == "closing" and got[103][0] == "closing"
        assert got[104] == ("active", None, None), "opened again after it was closed"
        assert got[205] == ("expired", None, "late") and got[206] == ("superseded", None, "early") and got[207] == ("active", None, "early")
        assert got[308] == ("closing", None, "premature") and got[309] == ("expired", None, None)
        assert got[410][0] == got[411][0] == "expired", "equal stages do not supersede each other"


def test_alerts(spark):
    log = [(1, True, 10, 90.0, 1), (2, True, 4, 90.0, 2), (3, True, 0, 70.0, 2), (4, False, 0, 0.0, None), (5, True, 5, 70.0, 2), (6, False, None, None, None), (7, False, 0, 0.0, 0), (8, False, 0, 0.0, 0), (9, False, 0, 0.0, 0), (10, True, 5, None, 1), (11, True, 5, 70.0, None), (12, True, 5, 70.0, None), (13, True, 5, 70.0, None)]
    df = spark.createDataFrame([("s", n, at(n if n < 13 else 90), ok, c, q, p) for n, ok, c, q, p in log] + [(None, 1, at(1), False, 0, 0.0, 0)], "source string, run long, ts timestamp, ok boolean, n int, q double, p int")
    for bucket in (1, 5, 1000):
        got = sorted((r.run, r.alert) for r in episodes.alerts(df, "source", "run", "ts", F.col("ok"), F.col("n"), F.col("q"), F.col("p"), bucket=bucket).collect())
        assert got == [(2, "fewer"), (3, "doubtful"), (3, "empty"), (5, "stuck"), (8, "failing"), (9, "failing"), (10, "back"), (13, "stale")]
