import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import lineage, loose, matching


def hits(a, b):
    a, b = a.upper(), b.upper()
    if not a.strip(" ") or not b.strip(" "):
        return False
    words = lambda t: {w for w in re.split(r"[\s,]+", t) if len(w) > 2}
    return a in b or b in a or bool(words(a)) and words(a) <= words(b)


def test_loose_matches_are_those_of_comparing_all(spark):
    r = random.Random(1)
    parts = ["mary", "doe", "m", "ann", "lee", "o'neil", "DOE", "mar", "ry", "longname", "%", "_"]
    text = lambda: r.choice([" ", ", ", "  "]).join(r.choice(parts) for _ in range(r.randint(0, 3)))
    asked = [(i, text()) for i in range(80)] + [(80, None), (81, ""), (82, "  "), (83, "m"), (84, "ar"), (85, "mary doe, and somebody else")]
    names = [(i, text()) for i in range(60)] + [(60, None), (61, ""), (62, "Mary Doe"), (63, "mary doe"), (64, "unique person")] + [(65, "m")]
    asked.append((86, "the unique person"))
    got = {x.a: (x.matches, x.match) for x in loose.loose_match(spark.createDataFrame(asked, "a int, t string"), "a", "t", spark.createDataFrame(names, "n int, t string"), "n", "t").collect()}
    assert len(got) == len(asked)
    for i, t in asked:
        found = [n for n, name in names if t is not None and name is not None and hits(t, name)]
        assert got[i] == (len(found), found[0] if len(found) == 1 else None), (i, t)
    assert got[86] == (1, 64)


def test_no_plan_compares_all_pairs(spark):
    df = spark.createDataFrame([(1, "a b c")], "id int, t string").repartition(2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = loose.loose_match(df, "id", "t", df.select(F.col("id").alias("n"), "t"), "n", "t")._jdf.queryExecution().toString()
        pairs = loose.like_labels(df, "t", df, "t")._jdf.queryExecution().toString()
        assert not any(x in p for x in ("Cartesian", "NestedLoop") for p in (plan, pairs))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("least", [0.9, 0.75, 0.6])
def test_like_labels_are_those_of_comparing_all(spark, least):
    r = random.Random(2)
    labels = ["".join(r.choice("ABC ") for _ in range(r.randint(1, 24))) for _ in range(40)]

    def slip(t):
        for _ in range(r.randint(0, 4)):
            i = r.randrange(len(t) + 1)
            t = r.choice([t[:i] + t[i + 1 :], t[:i] + r.choice("ABC") + t[i:], t[:i] + r.choice("ABC") + t[i + 1 :]])
        return t

    texts = [slip(t) for t in labels * 4] + ["", "A", "AB"] + labels
    got = {(x.text, x.label, x.distance) for x in loose.like_labels(spark.createDataFrame([(t,) for t in texts] + [(None,)], "x string"), "x", spark.createDataFrame([(t,) for t in labels] + [("",), (None,)], "y string"), "y", least).collect()}
    want = {(t, k, d) for t in texts for k in labels if t and k for d in [distance(t, k)] if 1 - d / max(len(t), len(k)) >= least - 1e-9}
    assert got == want


def test_typed(spark):
    known = [("Notice of sale", False), ("Judgment lien", False), ("Discharge of judgment lien", True), ("Mortgage", False), ("BOSS BILLS", False)]
    cases = {
        "NOTICE  of Sale": ("Notice of sale", 100.0, None),
        "notice of sales": ("Notice of sale", 84.0, None),
        "M0RTGAGE": ("Mortgage", 95.0, None),
        "N0TICE OF 5ALE": ("Notice of sale", 90.0, None),
        "B055 B1LLS": (None, 0.0, "unknown"),
        "BO5S BI1LS": ("BOSS BILLS", 71.0, None),
        "B0SS B1LLS": ("BOSS BILLS", 90.0, None),
        "DISCHARGE OF JUDGMENT LIENS": ("Discharge of judgment lien", round(90 * (1 - 1 / 27), 6), None),
        "DISCHARGE MORTGAGE": (None, 0.0, "unknown"),
        "2026 MORTGAGE": (None, 0.0, "unknown"),
        " ": (None, 0.0, "unknown"),
    }
    rows = spark.createDataFrame([(k,) for k in cases] + [(None,)], "text string")
    got = {x.text: (x.label, x.confidence, x.reason) for x in loose.typed(rows, "text", spark.createDataFrame(known, "name string, negative boolean"), "name", "negative", ["discharge", "release"]).collect()}
    assert got.pop(None) == (None, 0.0, "unknown")
    # "5ALE" has its digit in front, which is not between letters; the likeness of what is left decides.
    cases["N0TICE OF 5ALE"] = ("Notice of sale", round(90 * (1 - 1 / 14), 6) - 5, None)
    assert got == cases
    polar = loose.typed(spark.createDataFrame([("RELEASE OF A JUDGMENT LIEN AND SO ON",)], "text string"), "text", spark.createDataFrame([("RELEASE OF A JUDGMENT LIEN AND SO OM", False)], "name string, negative boolean"), "name", "negative", ["release"]).first()
    assert (polar.label, polar.reason) == (None, "polarity_conflict")
    three = loose.typed(spark.createDataFrame([("M0RT6AGE B0UND AB1E L0T",)], "text string"), "text", spark.createDataFrame([("M0RT6AGE BOUND ABIE LOT", False)], "name string, negative boolean"), "name", "negative", []).first()
    assert (three.confidence, three.reason) == (85.0, "speculative")


def broadcast_explodes(df):
    """Whether a broadcast side of the plan has an explode in it, of which Spark's estimates know nothing."""
    lines, inside = df._jdf.queryExecution().executedPlan().toString().split("\n"), None
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        inside = None if inside is not None and depth <= inside else inside
        if inside is not None and "Generate explode" in line:
            return True
        if "BroadcastExchange" in line and inside is None:
            inside = depth
    return False


def test_no_exploded_index_is_broadcast(spark, tmp_path):
    spark.range(2000).select("id", F.concat(F.lit("name "), F.col("id").cast("string")).alias("t")).write.parquet(str(tmp_path / "names"))
    names = spark.read.parquet(str(tmp_path / "names"))
    asked = spark.createDataFrame([(1, "na", "1"), (2, "", "")], "ask int, a string, b string")
    found = matching.ordered_contains(names, "t", asked, "ask", ["a", "b"])
    assert not broadcast_explodes(found) and found.where("ask = 2").count() == 2000
    texts = names.select(F.col("t").alias("text"), F.split("t", " ").alias("words"))
    assert not broadcast_explodes(loose.contained_texts(texts, texts))
    assert not broadcast_explodes(loose.contained_sets(texts, texts, "words"))


def test_probes_that_are_not_small_are_not_broadcast(spark, monkeypatch):
    rows, probes = spark.range(20).select(F.explode(F.array("id", F.lit(7))).alias("k")), spark.createDataFrame([(7, "x"), (8, None)], "k long, v string")
    few = lineage.probed(rows, probes, "k")
    monkeypatch.setattr(lineage, "SMALL_ROWS", 1)
    many = lineage.probed(rows, probes, "k")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(few) and "Broadcast" not in plan(many)
    assert sorted(map(tuple, few.collect()), key=str) == sorted(map(tuple, many.collect()), key=str) and few.count() == 22


def test_words_that_match_make_no_pairs_of_texts(spark, tmp_path, monkeypatch):
    """30 asked texts and 30 names of the same words: one pair of sets, no pair of texts."""
    seen, keep = {}, loose.kept
    monkeypatch.setattr(loose, "kept", lambda df, name: seen.setdefault(name, keep(df, name)))
    asked = spark.createDataFrame([(i, f"red bolt {i}") for i in range(30)], "a int, t string")
    names = spark.createDataFrame([(i, f"red large bolt {i}") for i in range(30)], "n int, t string")
    got = loose.loose_match(asked, "a", "t", names, "n", "t").collect()
    assert {(r.matches, r.match) for r in got} == {(30, None)} and len(got) == 30
    assert seen["sets"].count() == 1 and seen["pairs"].count() == 0


def copied(spark, n, copies, seed):
    r = random.Random(seed)
    some = [(r.choice(["x", "y", None]), r.choices("pqrst", k=r.randint(0, 4))) for _ in range(n)]
    return spark.createDataFrame([(i, *some[i % n]) for i in range(n * copies)], "id int, g string, w array<string>")


@pytest.mark.parametrize("itself", [True, False])
def test_verified_tiers_make_pairs_of_values_only(spark, monkeypatch, itself):
    p = copied(spark, 30, 4, 3).union(spark.createDataFrame([(1000, "x", None), (1001, "z", ["alone"])], "id int, g string, w array<string>"))
    q = p.withColumnRenamed("id", "rid") if itself else copied(spark, 25, 3, 4).withColumnRenamed("id", "rid")
    seen, keep = {}, matching.kept
    monkeypatch.setattr(matching, "kept", lambda df, name: seen.setdefault(name, keep(df, name)))
    overlap = F.arrays_overlap("l.w", "r.w")
    fast = matching.tiered_match(p, q, "id", "rid", [("g", 80, ["g"])], overlap, itself=itself, looks_at=["w"])
    slow = matching.tiered_match(p, q, "id", "rid", [("g", 80, ["g"])], overlap, itself=itself)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
    assert seen["hits"].count() <= 30 and seen["classes"].count() <= 31


def test_best_cover_makes_pairs_of_classes_only(spark, monkeypatch):
    p = copied(spark, 40, 1, 5).union(copied(spark, 15, 3, 6).withColumn("id", F.col("id") + 100)).where("size(w) > 0")
    c = p.select(F.col("id").alias("cid"), "g", F.when(F.col("id") % 3 == 0, F.array_union("w", F.array(F.lit("z")))).otherwise(F.col("w")).alias("w"))
    distinct = c.select("cid", "g", F.array_distinct("w").alias("offered"))
    pairs = p.join(distinct, "g").where("id <> cid").withColumn("w", F.array_distinct("w"))
    seen, keep = {}, matching.kept
    monkeypatch.setattr(matching, "kept", lambda df, name: seen.setdefault(name, keep(df, name)))
    got = matching.best_cover(p, c, "id", "cid", "w", ["g"], itself=True)
    want = sorted(map(tuple, matching.best_overlap(pairs, "id", "cid", "w", "offered").collect()))
    assert want and sorted(map(tuple, got.collect())) == want
    assert seen["levels"].count() == p.where("g is not null").select("g", F.array_sort(F.array_distinct("w"))).distinct().count()
