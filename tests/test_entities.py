import random
from itertools import combinations

from pyspark.sql import functions as F

from millrace.operators import entities

KINDS = ["a", "b", "c", "d"]


def brute(rows):
    parts = {k: [n for n in ("x", "y") if k == "d"] or [k] for k in KINDS}
    value = lambda r, k: tuple(r[p] for p in parts[k]) if all(r[p] is not None and str(r[p]).strip() for p in parts[k]) else None
    label = {r["id"]: r["id"] for r in rows}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for r, s in combinations(rows, 2):
        if sum(value(r, k) is not None and value(r, k) == value(s, k) for k in KINDS) >= 2:
            a, b = top(r["id"]), top(s["id"])
            label[max(a, b)] = min(a, b)
    entity = {r["id"]: top(r["id"]) for r in rows}
    out = {}
    for r in rows:
        mine = entity[r["id"]]
        shared = sorted(k for k in KINDS if value(r, k) is not None and any(value(s, k) == value(r, k) and entity[s["id"]] != mine for s in rows))
        out[r["id"]] = (mine, sum(e == mine for e in entity.values()), shared)
    return out


def found(spark, rows):
    df = spark.createDataFrame([tuple(r[c] for c in ("id", "a", "b", "c", "x", "y")) for r in rows], "id long, a string, b int, c string, x string, y string")
    kinds = {"a": [F.col("a")], "b": [F.col("b")], "c": [F.col("c")], "d": [F.col("x"), F.col("y")]}
    return {r.id: (r.entity, r.size, r.shared) for r in entities.merged(df, "id", kinds).collect()}


def row(i, a=None, b=None, c=None, x=None, y=None):
    return {"id": i, "a": a, "b": b, "c": c, "x": x, "y": y}


def test_entities_are_those_of_comparing_all_pairs(spark):
    r = random.Random(1)
    pick = lambda n, blank="": r.choice([None, blank, *map(str, range(n))])
    rows = [row(i, pick(12), r.choice([None, *range(25)]), pick(30, "  "), pick(6), pick(5)) for i in r.sample(range(1000), 120)]
    assert found(spark, rows) == brute(rows)


def test_a_chain_a_hot_key_and_a_single_shared_identifier(spark):
    chain = [row(i, f"a{i // 2}", i // 2, f"c{(i + 1) // 2}", f"x{(i + 1) // 2}", "y") for i in range(40)]  # each pair shares a, b or c, d in turn
    hot = [row(100 + i, "hot", 7, f"own{i}") for i in range(200)]
    lone = [row(400 + i, "same", 100 + i) for i in range(5)] + [row(500), row(501, " ", None, "")]
    got = found(spark, chain + hot + lone)
    assert {got[i][:2] for i in range(40)} == {(0, 40)} and {got[100 + i][:2] for i in range(200)} == {(100, 200)}
    assert all(got[400 + i][0] == 400 + i and "a" in got[400 + i][2] for i in range(5)), "one identifier is for review only"
    assert got[500] == (500, 1, []) and got[501] == (501, 1, [])


def test_no_plan_has_a_cross_join(spark):
    df = spark.createDataFrame([(1, "a", "b")], "id long, a string, b string")
    plan = entities.merged(df, "id", {"a": [F.col("a")], "b": [F.col("b")]})._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_an_empty_table(spark):
    assert entities.merged(spark.createDataFrame([], "id long, a string, b string"), "id", {"a": [F.col("a")], "b": [F.col("b")]}).count() == 0


def test_links_are_of_ids_and_shrink_fast(spark, monkeypatch):
    """A chain of 200 rows and 300 copies of a row: a key's rows are linked to one of them, and a few rounds are enough."""
    seen, keep = [], entities.kept
    monkeypatch.setattr(entities, "kept", lambda df, name: seen.append((name, keep(df, name))) or seen[-1][1])
    links = [(i + d, f"k{i}") for i in range(199) for d in (0, 1)] + [(1000 + i, "hot") for i in range(300)] + [(5000, "alone")]
    got = {r.id: r.label for r in entities.connected(spark.createDataFrame(links, "id long, key string")).collect()}
    assert got == {i: 0 for i in range(1, 200)} | {1000 + i: 1000 for i in range(1, 300)}
    edges = [df.count() for name, df in seen if name == "edges"]
    assert edges[0] == 199 + 299 and edges[-1] == 0 and len(edges) <= 3
    assert all(dict(df.dtypes).keys() <= {"u", "v", "m", "went"} for _, df in seen)
