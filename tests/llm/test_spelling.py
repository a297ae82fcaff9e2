import random
import re
import zlib
from collections import Counter

import pytest

from millrace.llm import spelling
from millrace.llm.queries import ORACLES, QUERIES
from tests import oracle
from tests.llm import data


def brute_words(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n):
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        if vs and n[best := min(vs, key=lambda v: (-n[v], v))] >= 5 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def vocabulary(seed, letters, count):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(6, 9))): r.choice((5, 6, 30, 200, 1500)) for _ in range(count)}


@pytest.mark.parametrize("limit", [2, 60, 10_000])
def test_near_words_are_those_of_brute_force_however_deep_the_trie_is_cut(spark, limit):
    n = vocabulary(limit, "abcé", 900) | {"aaaaaa" + "a" * k: 5 + k for k in range(4)} | {"prefixe" + c: 9 for c in "abcd"} | {"prefix": 9, "prefixe": 9}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = spelling.near_words(words, limit).collect()
    assert len(got) == len({(r.a, r.b) for r in got}) and all(r.b < r.a and (r.a_n, r.b_n) == (n[r.a], n[r.b]) for r in got)
    assert {(r.a, r.b) for r in got} == {(a, b) for a in n for b in n if b < a and one_apart(a, b)}


def test_the_local_descent_takes_empty_and_repeated_letters():
    for seed in range(20):
        words = sorted(vocabulary(seed, "ab", 40)) + ["", "a", "aa", "b"]
        got = list(spelling.trie_pairs(words))
        assert len(got) == len(set(got)) and {(words[i], words[j]) for i, j in got} == {(a, b) for a in words for b in words if b < a and one_apart(a, b)}


def corpus(spark):
    r = random.Random(11)
    base = ["recieve", "receive", "receives", "Éclair", "éclairs", "eclair", "colours", "colour", "colouur", "splendid", "splended", "straße", "strasse", "internationalisation", "internationalization", "abcdef", "abcdeg", "abcdeh"]
    rows = [(i, " ".join(r.choices(base, [2 ** (k % 9) for k in range(len(base))], k=60)) + ("," if i % 2 else "×x÷")) for i in range(150)]
    rows += [(i, t) for i, t, _ in data.texts()] + [(None, "receive " * 900), (5, None), (6, ""), (7, "l" * 3000 + " "), (8, ("l" * 3000 + " ") * 6), (9, "RECEIVE received" * 3)]
    rows += [(500 + i, "tiebreaka tiebreakb tiebreak") for i in range(6)]
    rows += [(600 + i, "chainab " + "chainabc " * 8 + "chainabcd " * 70) for i in range(7)]
    return rows, spark.createDataFrame([(i, t, 1, "p", "word") for i, t in rows], "doc_id long, text string, n int, p string, word string")


def test_variants_follow_the_definition(spark):
    rows, docs = corpus(spark)
    want = brute(brute_words(rows))
    assert any(f and f != r for _, f, r, *_ in want)
    for limit in (3, spelling.LIMIT):
        got = spelling.variants(docs.repartition(5), limit=limit).collect()
        assert len(got) == len(want) and {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want


def test_held_words_are_handed_on_and_long_texts_are_read_whole(spark, monkeypatch):
    rows, docs = corpus(spark)
    want = brute_words(rows)
    monkeypatch.setattr(spelling, "HELD", 7)
    monkeypatch.setattr(spelling, "LONG", 100)
    assert {(r.word, r.n) for r in spelling.counted(docs).collect()} == set(want.items())


def test_a_table_without_words(spark):
    assert spelling.variants(data.empty(spark)).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (2, "a b c")], "doc_id long, text string")).count() == 0


def test_the_query_gives_the_rows_of_its_sql(spark):
    name = "op13_spelling_variants"
    assert oracle.differs(QUERIES[name](spark, oracle.SF), ORACLES[name], oracle.connect()) == ""
