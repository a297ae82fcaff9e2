import hashlib
import re
import zlib
from collections import Counter

from millrace.llm import exact_dedup, sharding
from millrace.llm.common import cut, weighed_join
from tests.llm import data


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_decisions_follow_the_definition(spark):
    rows = data.texts()
    least, size = {}, Counter()
    for i, t, _ in rows:
        size[norm(t)] += 1
        least[norm(t)] = i if least.get(norm(t)) is None else least[norm(t)] if i is None else min(i, least[norm(t)])
    got = exact_dedup.decisions(data.docs(spark)).collect()
    assert len(got) == len(rows)
    want = Counter((i, least[norm(t)], size[norm(t)], hashlib.sha256(norm(t).encode()).hexdigest()) for i, t, _ in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(least)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_the_rows_that_stay_keep_all_columns(spark):
    docs = data.docs(spark)
    got = exact_dedup.deduplicate(docs).collect()
    assert exact_dedup.deduplicate(docs).schema == docs.schema
    kept = Counter(norm(r.text) for r in got)
    assert set(kept.values()) == {1} and set(kept) == {norm(t) for _, t, _ in data.texts()}
    first = {}
    for i, t, _ in data.texts():
        if i is not None:
            first[norm(t)] = min(i, first.get(norm(t), i))
    assert all(r.doc_id == first.get(norm(r.text)) for r in got)


def test_salts_and_partitions_do_not_matter(spark):
    docs = data.docs(spark)
    a = sorted(map(str, exact_dedup.decisions(docs.repartition(7)).collect()))
    assert a == sorted(map(str, exact_dedup.decisions(docs.coalesce(1)).collect()))


def test_an_empty_table_has_no_decisions(spark):
    assert exact_dedup.decisions(data.empty(spark)).count() == 0
    assert exact_dedup.deduplicate(data.empty(spark)).count() == 0


def test_the_permutation_is_a_bijection(spark):
    for n in (1, 2, 3, 5, 16, 17, 1000, 1023):
        got = [r[0] for r in spark.range(n).select(sharding.permuted(sharding.F.col("id"), n)).collect()]
        assert sorted(got) == list(range(n))
    assert got != sorted(got)


def test_shards_are_level_and_slots_have_no_gaps(spark):
    rows = data.texts()
    for shards in (1, 7, 200):
        got = sharding.shard(data.docs(spark), shards).collect()
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
        slots = {}
        for r in got:
            slots.setdefault(r.shard, []).append(r.slot)
            assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        counts = [len(slots.get(k, [])) for k in range(shards)]
        assert max(counts) - min(counts) <= 1


def test_the_shuffle_is_reproducible(spark):
    a, b = (sorted(map(str, sharding.shard(data.docs(spark).repartition(n), 5).collect())) for n in (1, 6))
    assert a == b
    assert sharding.shard(data.empty(spark), 3).count() == 0


def test_repeated_rows_and_ids_that_many_share_are_dealt_out(spark):
    from millrace.llm.common import each_of

    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 10), (None, 11)], "k string, times long")
    got = Counter((r.k, r.nth) for r in each_of(df, "times", "nth", 10).collect())
    assert got == Counter((k, i) for k, n in (("a", 25), ("b", 1), ("c", 10), (None, 11)) for i in range(n))
    same = spark.range(30_000).select(sharding.F.lit(None).cast("long").alias("doc_id"), sharding.F.concat(sharding.F.lit("t"), sharding.F.col("id") % 2000).alias("text"))
    rows, n = sharding.numbered(same.withColumn("size", sharding.F.length("text")), ["doc_id", "text"])
    assert n == 30_000 and rows.select("row_number").distinct().count() == n and rows.agg(sharding.F.max("row_number")).first()[0] == n - 1
    columns = spark.createDataFrame([(1, "x"), (2, "y")], "`doc.id` long, `a.text` string")
    assert sharding.shard(columns, 2, "doc.id", "a.text").count() == 2 == exact_dedup.decisions(columns, "doc.id", "a.text").count()


def test_keys_that_are_not_hot_are_joined_by_a_shuffle(spark):
    big, small = spark.range(100).toDF("k"), cut(spark.range(100).selectExpr("id as k", "repeat('x', 1000) as text", "1L as n"))
    joined = weighed_join(big, small, ["k"], "n")
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 100
