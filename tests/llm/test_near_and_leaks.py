import random
from itertools import combinations

import numpy as np
import xxhash

from millrace.llm import decontam, simhash, url_filter
from millrace.llm.common import components, cut, sized_join
from tests.llm import data


def fingerprint(text, n):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components_by_brute_force(spark):
    rows = data.texts()
    prints = [fingerprint(t, 4) for _, t, _ in rows]
    distinct = sorted(set(prints))
    at = roots(distinct, [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 4])
    least = {}
    for (i, _, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[at[p]] = min(i, least.get(at[p], i))
    got = simhash.near_duplicates(data.docs(spark), words=4, distance=4).collect()
    want = sorted((i if i is not None else -1, p, least.get(at[p], -1)) for (i, _, _), p in zip(rows, prints, strict=True))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fp % (1 << 64), -1 if r.component_id is None else r.component_id) for r in got) == want
    assert simhash.near_duplicates(data.empty(spark)).count() == 0


def test_links_are_those_of_brute_force_at_any_cut(spark):
    r = random.Random(1)
    fps = [r.getrandbits(64) for _ in range(30)]
    fps += [f ^ sum(1 << b for b in r.sample(range(64), k)) for f in fps[:12] for k in (1, 3, 4, 5, 6)]
    fps = sorted(set(fps))
    frame = spark.createDataFrame([(int(np.array(f, np.uint64).view(np.int64)),) for f in fps], "fp long")
    want = {frozenset((a, b)) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 4}
    for segments in (2, 3, 4):
        pairs = [(p.a % (1 << 64), p.b % (1 << 64)) for p in simhash.links(frame, 4, segments).collect()]
        assert len(pairs) == len(want) and {frozenset(p) for p in pairs} == want


def test_components_of_chains_stars_and_cliques(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(a, b) for a in range(200, 210) for b in range(200, 210)]
    names = list(range(300))
    r.shuffle(names)
    edges = [(names[a], names[b]) for a, b in edges]
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots({n for e in edges for n in e}, edges)
    assert got == {n: w for n, w in want.items() if n in got} and set(got) == {n for a, b in edges if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_both_ways_of_a_sized_join_agree(spark):
    big = spark.createDataFrame([(i % 3 or None, i) for i in range(30)], "k int, v int")
    small = spark.createDataFrame([(1, "a"), (2, "b"), (4, "c")], "k int, w string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a, b = (sorted(map(str, sized_join(big, small, ["k"], how, rows=n).collect())) for n in (3, 10**9))
        assert a == b


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_what_is_repeated_for_salts_or_parts_is_not_broadcast(spark):
    big, small = spark.range(100).toDF("k"), cut(spark.range(100).selectExpr("id as k", "id as w"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert "Broadcast" not in plan(sized_join(big, small, ["k"], how, rows=10**9))
    assert "Broadcast" in plan(sized_join(big, small, ["k"], rows=100))
    fps = cut(spark.range(100).toDF("fp"))
    assert "Broadcast" not in plan(simhash.links(fps, 4))


def test_near_texts_groups_copies_and_leaves_the_others(spark):
    got = {r.doc_id: r.component_id for r in simhash.near_texts(data.docs(spark)).collect()}
    assert {got[i] for i in (5, 50, 51, 52, 53)} == {5}
    assert {got[i] for i in (3, *range(40, 46))} == {3}
    assert {got[i] for i in (60, 61, 62)} == {60}
    alone = [i for i in range(40) if i not in (3, 5)]
    assert all(got[i] == i for i in alone)
    kept = simhash.keep_one(data.docs(spark))
    assert kept.columns == data.docs(spark).columns
    assert {r.doc_id for r in kept.collect()} >= set(range(40)) and simhash.near_texts(data.empty(spark)).count() == 0


def test_blocks_of_a_bucket_give_the_same_groups(spark, monkeypatch):
    want = sorted(map(str, simhash.near_texts(data.docs(spark)).collect()))
    monkeypatch.setattr(simhash, "BLOCK", 2)
    assert sorted(map(str, simhash.near_texts(data.docs(spark)).collect())) == want


def test_a_forest_has_the_groups_of_all_links():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, (6, 4)).astype(np.uint64)
    sketch = base[r.integers(0, 6, 60)] ^ (np.uint64(1) << r.integers(0, 63, (60, 4)).astype(np.uint64))
    node = np.arange(60)
    far = np.array([[np.bitwise_count(a ^ b).sum() for b in sketch] for a in sketch])
    want = roots(range(60), [(a, b) for a in range(60) for b in range(60) if a != b and far[a, b] <= 9])
    edges = simhash.forest(node, sketch, 9)
    assert all(far[a, b] <= 9 for a, b in edges) and roots(range(60), edges.tolist()) == want
    assert len(edges) == 60 - len(set(want.values()))


def shingle_set(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_near_texts_are_the_components_of_exact_similarity(spark):
    r, rows = random.Random(11), []
    vocabulary, odds = [f"w{i}" for i in range(5000)], [1 / (i + 1) for i in range(5000)]
    for _ in range(40):
        base = r.choices(vocabulary, odds, k=200)
        some = list(base)
        for at in r.sample(range(200), 4):
            some[at] = "changed"
        many = list(base)
        for at in r.sample(range(200), 6):
            many[at] = "altered"
        rows += [" ".join(t) for t in (base, base[: r.randint(160, 166)], base[-r.randint(168, 180) :], some, many)]
    sets = [shingle_set(t) for t in rows]
    alike = [(a, b) for a in range(len(rows)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = roots(range(len(rows)), alike)
    got = simhash.near_texts(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    assert {x.doc_id: x.component_id for x in got} == want and len(alike) > 100


def test_rows_without_an_id_outlive_both_stages(spark):
    alone, twin, leak = "a row that has no number and no copy", "two rows with this text and no number at all", "a leaking passage that is in the list of items to be taken out of all texts"
    rows = [(None, alone), (None, twin), (None, twin), (None, leak), (1, "the same id"), (1, "another text of the same id"), (2, "said with and without"), (None, "said with and without"), (3, "one row twice"), (3, "one row twice"), (1, leak)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(simhash.keep_one(docs).collect(), key=str)
    assert kept == sorted([(None, alone), (None, twin), (1, leak), (1, "the same id"), (1, "another text of the same id"), (2, "said with and without"), (3, "one row twice")], key=str)
    left = decontam.decontaminate(docs, spark.createDataFrame([(1, leak)], "item_id long, text string")).collect()
    assert sorted(left, key=str) == sorted((r for r in rows if r[1] != leak), key=str)


def test_an_exact_forest_has_the_groups_of_all_links():
    r = np.random.default_rng(6)
    sets = [np.unique(np.concatenate([np.arange(20 * (i % 4), 20 * (i % 4) + 20)[r.random(20) < 0.93], r.integers(200, 999, 1)])).astype(np.uint64) for i in range(60)]
    pairs = [(a, b) for a in range(60) for b in range(a) if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))]
    edges = simhash.exact_forest(np.arange(60), sets, 0.8)
    want = roots(range(60), pairs)
    assert roots(range(60), edges.tolist()) == want and len(edges) == 60 - len(set(want.values()))


ITEMS = [(1, "seven little tokens that stand here together and then a few more of them follow"), (2, "Short item"), (3, None), (4, ""), (5, "!!!"), (6, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"), (None, "an item without any number of its own that is still looked for in texts")]


def leaks(spark, rows, items=ITEMS):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): (r.matched, r.width) for r in decontam.contaminated(docs, bench).collect()}


def test_passages_are_found_with_substitutions_and_others_are_not(spark):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    rows = [
        (1, "before it. SEVEN little, tokens that stand here; together and then a few more of them follow after"),
        (2, "seven little tokens that stood here together and then a few less of them follow"),
        (3, "a short ITEM"),
        (4, long.replace("two", "zwei").replace("nine", "neun").replace("fourteen", "x")),
        (5, "seven little birds that stand there apart and now some more of us follow"),
        (6, None),
        (7, ""),
        (8, "x " * 5000 + long),
        (9, "an item without any number of its own that is still looked for in texts"),
        (None, long),
        (10, "one two three four five six"),
        (11, long), (11, long),
    ]
    got = leaks(spark, rows)
    assert set(got) == {(1, 1), (2, 1), (3, 2), (4, 6), (8, 6), (9, None), (None, 6), (11, 6)}
    assert got[1, 1] == (13, 13) and got[2, 1][0] >= 11 and got[3, 2] == (2, 2)


def test_every_accepted_pattern_of_substitutions_is_found(spark):
    items, rows = [], []
    for n in range(1, 17):
        item = [f"i{n}x{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        width = min(n, 13)
        allowed = width - -(-4 * width // 5)
        for changed in range(min(allowed + 2, width)):
            for places in combinations(range(width), changed):
                # Longer items are there only as far as the stretch goes.
                text = ["y" if k in places else t for k, t in enumerate(item[:width])]
                rows.append(((n, changed <= allowed), " ".join(["z", "z", *text, *["z"] * (n - width)])))
    want = {(i, n) for i, ((n, good), _) in enumerate(rows) if good}
    got = leaks(spark, [(i, t) for i, (_, t) in enumerate(rows)], items)
    assert set(got) == want and sum(n == 13 for _, n in want) == 1 + 13 + 78


def test_the_way_past_the_broadcast_gives_the_same(spark, monkeypatch):
    rows = [(i, t) for i, t, _ in data.texts()]
    rows += [(900, rows[7][1] + " tail"), (901, "head " + rows[9][1])]
    items = [(i, t[: len(t) // 2]) for i, t, _ in data.texts()[6:12]]
    want = leaks(spark, rows, items)
    assert {(7, 7), (900, 7), (9, 9), (901, 9)} <= set(want)
    monkeypatch.setattr(decontam, "FEW_HASHES", 0)
    assert leaks(spark, rows, items) == want


def test_what_is_left_after_decontamination(spark):
    docs = data.docs(spark)
    items = spark.createDataFrame([(1, data.texts()[7][1]), (2, None)], "item_id long, text string")
    kept = decontam.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert decontam.decontaminate(docs, items.limit(0)).count() == docs.count()
    assert decontam.decontaminate(data.empty(spark), items).count() == 0


def test_overlap_by_brute_force():
    r = random.Random(4)
    for _ in range(200):
        doc, item = [r.randint(0, 2) for _ in range(r.randint(1, 30))], [r.randint(0, 2) for _ in range(r.randint(1, 12))]
        shift, window = r.randint(-8, 25), r.randint(1, 14)
        width = min(window, len(item))
        inside = [a for a in range(len(item) - width + 1) if a + shift >= 0 and a + width + shift <= len(doc)]
        want = max((sum(item[a + k] == doc[a + k + shift] for k in range(width)) for a in inside), default=0)
        assert decontam.overlap(np.array(doc), np.array(item), shift, window)[0] == want


def test_a_small_bad_branch_of_a_large_host_stays_literal(spark):
    rows = [(f"http://big.example/d{chr(97 + k // 26)}{chr(97 + k % 26)}/x{chr(97 + i % 26)}", 0) for k in range(40) for i in range(100)]
    rows += [(f"http://big.example/bad/x{chr(97 + i % 26)}", 1) for i in range(160)]
    urls = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    got = {r.page_id: r.verdict for r in url_filter.judge(urls, [], label_col="bad").collect()}
    assert got == {i: "block" if b else "allow" for i, (_, b) in enumerate(rows)}


def test_every_size_enumerates_hamming_balls():
    for n in (0, 1, 100, 10**4, 10**6, 10**9, 10**12):
        for distance in range(1, 9):
            assert 1 <= simhash.segments_for(n, distance) <= distance
