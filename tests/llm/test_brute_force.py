"""Whole results of operators without SQL against plain versions of their definitions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from millrace.llm import decontam, langid, url_filter
from millrace.llm.common import read_table
from tests.llm import data
from tests.oracle import SF


def tree(rows, depth=url_filter.DEPTH, least=url_filter.LEAST, z=url_filter.Z):
    """Template and purity of each (host, shape), level by level in dictionaries. rows: host, path, bad."""
    sums = defaultdict(lambda: [0, 0, 0])
    for host, path, bad in rows:
        s = sums[host, re.sub("[0-9]+", "#", path)]
        s[0] += 1
        s[1] += bad is not None
        s[2] += bad or 0
    segments = {k: re.sub("^/", "", k[1]).split("/", depth - 1) for k in sums}
    template = dict.fromkeys(sums, "")

    def differ(h, n, all_h, all_n):
        if not n or not all_n - n:
            return False
        p = all_h / all_n
        return abs(h / n - (all_h - h) / (all_n - n)) > z * math.sqrt(p * (1 - p) * (1 / n + 1 / (all_n - n)))

    for level in range(max(map(len, segments.values()), default=0)):
        kids = defaultdict(lambda: [0, 0, 0, 0])
        for k, seg in segments.items():
            if level < len(seg):
                s = kids[k[0], template[k], seg[level]]
                for i, v in enumerate([*sums[k], sums[k][0] if len(seg) <= level + 2 else 0]):
                    s[i] += v
        nodes = defaultdict(lambda: [0, 0, 0, 0, 0])
        for (host, t, _), s in kids.items():
            for i, v in enumerate([*s, 1]):
                nodes[host, t][i] += v
        literal = set()
        for (host, t, seg), (n, labelled, bad, ends) in kids.items():
            a = nodes[host, t]
            if n >= least and (a[4] == 1 or differ(labelled, n, a[1], a[0]) or differ(bad, labelled, a[2], a[1]) or differ(ends, n, a[3], a[0])):
                literal.add((host, t, seg))
        for k, seg in segments.items():
            if level < len(seg):
                template[k] += "/" + (seg[level] if (k[0], template[k], seg[level]) in literal else "*")
    whole = defaultdict(lambda: [0, 0])
    for k, s in sums.items():
        whole[k[0], template[k]][0] += s[2]
        whole[k[0], template[k]][1] += s[1]
    purity = {k: (b + url_filter.SMOOTH / 2) / (n + url_filter.SMOOTH) for k, (b, n) in whole.items()}
    return {k: (template[k], purity[k[0], template[k]]) for k in sums}


def test_the_template_tree_is_that_of_a_plain_version(spark):
    r = random.Random(5)
    paths = ["/" + "/".join(r.choice(["a", "b", f"i{r.randint(1, 99)}", "list", "x", ""]) for _ in range(r.randint(0, 6))) for _ in range(900)]
    rows = [(r.choice(["h", "k"]), p, r.choice([None, 0, 1]) if "list" not in p else 1) for p in paths] + [("deep", "/a/b/c/d/e/f/g/h", 1)] * 7 + [("", "", None)]
    df = spark.createDataFrame(rows, "host string, path string, bad int")
    got = {(x.host, x.shape): (x.template, x.purity) for x in url_filter.templates(df, 5).collect()}
    want = tree(rows, 5)
    assert got.keys() == want.keys()
    for k, (template, purity) in want.items():
        assert got[k][0] == template and abs(got[k][1] - purity) < 1e-9, k


def test_verdicts_of_the_query_are_those_of_a_plain_version(spark):
    from tests.llm.test_urls_and_pipeline import rule_of, split

    pages = {p.page_id: split(p.url) for p in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    ruled = {i: rule_of(*hp) for i, hp in pages.items()}
    found = tree([(*pages[i], None if ruled[i] is None else int(ruled[i][0] == "block")) for i in pages])
    from millrace.llm.queries import op6_url_filter

    for x in op6_url_filter(spark, SF).collect():
        host, path = pages[x.page_id]
        template, purity = found[host, re.sub("[0-9]+", "#", path)]
        assert (x.template, x.verdict) == (template, ruled[x.page_id][0] if ruled[x.page_id] else "block" if purity >= url_filter.REJECT else "allow")


def test_findings_are_those_of_comparing_every_document_with_every_item(spark):
    docs, items = read_table(spark, SF, "documents"), read_table(spark, SF, "benchmark")
    cut = lambda t: re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    r = random.Random(3)
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    asked = [(x.item_id, x.text) for x in items.collect()]
    for k, (_, t) in enumerate(asked[:30]):  # with some words replaced
        w = t.split()
        for _ in range(k % 5):
            w[r.randrange(len(w))] = "swapped"
        rows.append((10_000 + k, f"something before {' '.join(w)} and after"))
    got = {(x.doc_id, x.item_id): (x.matched, x.width) for x in decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    codes: dict[str, int] = {}
    code = lambda ts: np.array([codes.setdefault(t, len(codes)) for t in ts], np.int64)
    texts, wanted = [(i, code(cut(t))) for i, t in rows], [(i, code(cut(t))) for i, t in asked]
    want = {}
    for i, d in texts:
        for j, q in wanted:
            width = min(13, len(q))
            if not width or len(d) < width:
                continue
            best = 0
            for a in range(len(q) - width + 1):  # every stretch of the item over every place of the document
                best = max(best, int((np.lib.stride_tricks.sliding_window_view(d, width) == q[a : a + width]).sum(1).max()))
            if best >= math.ceil(0.8 * width - 1e-9):
                want[i, j] = (best, width)
    assert got == want and len(want) > 20


def test_language_scores_are_those_of_a_plain_version(spark):
    rows = [(i, t, lang) for i, t, lang in data.texts()]
    docs = data.docs(spark)
    word = re.compile(r"[^\W\d_]+")
    counts = defaultdict(lambda: defaultdict(Counter))  # size, unit, language; size 0 are words
    for i, t, lang in {(i, t, lang) for i, t, lang in rows if t is not None and lang is not None}:
        for w, n in Counter(word.findall(t.lower())).items():
            counts[0][w][lang] += n
            m = f"<{w}>"
            for size in range(1, langid.LONGEST + 1):
                for k in range(len(m) - size + 1):
                    counts[size][m[k : k + size]][lang] += n
    langs = sorted({lang for _, t, lang in rows if t is not None and lang is not None})
    total = {size: {lang: sum(c[lang] for c in units.values()) + 0.5 * len(units) for lang in langs} for size, units in counts.items()}
    row = lambda size, unit: np.array([math.log((counts[size][unit][lang] + 0.5) / total[size][lang]) for lang in langs])

    def scores(w):
        if w in counts[0]:
            return row(0, w)
        m = f"<{w}>"
        for size in range(min(langid.LONGEST, len(m)), 0, -1):
            known = [m[k : k + size] for k in range(len(m) - size + 1) if m[k : k + size] in counts[size]]
            if known:
                return np.mean([row(size, u) for u in known], 0)
        return np.zeros(len(langs))

    more = [(900, "theless unseenly wordings derart", None), (901, "zzz qqq", None), (902, "ñandú über", None)]
    asked = docs.select("doc_id", "text").union(spark.createDataFrame([x[:2] for x in more], "doc_id long, text string"))
    got = langid.predict(asked, langid.fit(docs)).collect()
    for x in got:
        ws = word.findall((x.text or "").lower())
        if not ws:
            assert tuple(x.language) == ("und", 0.0)
            continue
        sums = sum(scores(w) for w in ws)
        share = np.exp((sums - sums.max()) / math.sqrt(len(ws)))
        assert x.language.lang_pred == langs[int(np.argmax(sums))] and abs(x.language.score - share[np.argmax(sums)] / share.sum()) < 1e-4


def test_the_pipeline_is_its_stages_one_after_the_other(spark, tmp_path):
    """Copies, near copies by all pairs, and leaks by all pairs, over the documents of the test tables."""
    docs = read_table(spark, SF, "documents")
    kept = corpus_pipeline.language_id(spark, docs, SF).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    first = {}
    for x in sorted(kept, key=lambda x: x.doc_id):
        first.setdefault(norm(x.text), x)
    texts = list(first.values())
    sets = []
    for x in texts:
        w = re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", "".join(c.lower() if "A" <= c <= "Z" else c for c in x.text))
        sets.append({" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else {""})
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if group[i] != group[j] and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    best = {}
    for g, x in zip(group, texts, strict=True):
        best[g] = min(best.get(g, x.doc_id), x.doc_id)
    left = set(best.values())
    survivors = docs.where(docs.doc_id.isin(left))
    leaks = {x.doc_id for x in decontam.contaminated(survivors, read_table(spark, SF, "benchmark")).collect()}
    got = {x.doc_id for x in corpus_pipeline.run(spark, SF).select("doc_id").collect()}
    assert got == left - leaks and len(got) > 100


def test_a_tree_of_every_depth(spark):
    rows = [(i, f"http://h/a/b/c/{'good' if i % 2 else 'bad'}/x", int(i % 2 == 0)) for i in range(20)]
    rows += [(20, "http://h/" + "x" * 100_000, 1), (21, None, None), (22, "http://h/" + "9" * 100_000 + "?q", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, bad int")
    told = {x.page_id: x.verdict for x in url_filter.judge(df, [], label_col="bad", depth=None).collect()}
    assert len(told) == 23 and all(told[i] == ("block" if b else "allow") for i, _, b in rows[:20])
