import random
import re

import pytest

from millrace.llm import licences
from millrace.llm.queries import ORACLES, QUERIES
from tests import oracle
from tests.llm import data

TEXTS = [
    "Licensed under CC BY-NC 4.0.\nAll rights\treserved; all RIGHTS reserved all rights reserved",
    "cc by cc by cc-by, cc0 by",
    "accc by: general public licenses, General Public\nLicense",
    "// SPDX-License-Identifier: (MIT OR GPL-2.0-or-later) AND Apache-2.0\nand more",
    "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */",
    "spdx license identifier: MIT. The rest of the line, or not",
    "SPDX-License-Identifier: mit or the rest",
    "SPDX-License-Identifier: (MIT OR",
    "SPDX-License-Identifier: Whatever-1.0",
    "SPDX-License-Identifier:\nMIT",
    "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: GPL-3.0-only\n",
    "license expression = 'LicenseRef-Mine'",
    "é general public license é",
    "apache license, version 2.0 " * 3,
    "all rights all rights reserved\x00cc\x00by",
]


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = []
    for kind, of in (("base", licences.BASE), ("notice", licences.NOTICES)):
        for phrase, label in of.items():
            p = phrase.split()
            places += [(i, len(p), kind, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), places


def table(spark):
    r = random.Random(2)
    bits = ["cc", "by", "nc", "sa", "all", "rights", "reserved", "general", "public", "license", "mit", "x", "\n", "-", "é", "version", "3", "apache"]
    texts = TEXTS + [" ".join(r.choice(bits) for _ in range(r.randint(0, 200))) for _ in range(60)] + ["word " * 200_000 + "cc by", None, "", " \n"] + [t for _, t, _ in data.texts()]
    return texts, spark.createDataFrame([(i // 2 if i % 5 else None, t, 1, "b", 2) for i, t in enumerate(texts)], "doc_id long, text string, n_words int, places string, `a.b` int")


def test_places_are_those_of_brute_force(spark):
    texts, docs = table(spark)
    got = licences.scan(docs.coalesce(1)).collect()
    assert len(got) == len(texts)
    for r, t in zip(got, texts, strict=True):
        n, places = brute(t)
        assert r.n_words == n and sorted(tuple(p) for p in r.places) == sorted(places)


def test_the_digest_follows_from_the_places(spark):
    texts, docs = table(spark)
    for r, t in zip(licences.digest(licences.scan(docs.coalesce(1))).collect(), texts, strict=True):
        n, places = brute(t)
        base = [p for p in places if p[2] == "base"]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(base), min((p[0] for p in base), default=None), max((p[0] for p in base), default=None))
        assert r.base_labels == ",".join(sorted({p[3] for p in base}))
        assert set(filter(None, r.labels.split(","))) >= {p[3] for p in places} and r.labels.split(",") == sorted(set(r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


@pytest.mark.parametrize(
    ("text", "parts", "order", "ids", "permitted"),
    [
        ("MIT", "mit", "mit", ["mit"], True),
        ("MIT OR GPL-2.0-only AND ISC", "mit or gpl-2.0-only and isc", "mit gpl-2.0-only isc and or", ["gpl-2.0-only", "isc", "mit"], True),
        ("(MIT OR GPL-2.0-only) AND GPL-3.0-only", "( mit or gpl-2.0-only ) and gpl-3.0-only", "mit gpl-2.0-only or gpl-3.0-only and", ["gpl-2.0-only", "gpl-3.0-only", "mit"], False),
        ("GPL-2.0-only with LLVM-exception or Apache-1.1", "gpl-2.0-only with llvm-exception or apache-1.1", "gpl-2.0-only llvm-exception with apache-1.1 or", ["apache-1.1", "gpl-2.0-only"], False),
        ("MIT and and ISC", "mit", "mit", ["mit"], True),
        ("((MIT) AND ISC)) AND Zlib", "( ( mit ) and isc )", "mit isc and", ["isc", "mit"], True),
        ("MIT AND (ISC OR", "mit", "mit", ["mit"], True),
        ("gpl-2.0+ next", "gpl-2.0+", "gpl-2.0+", ["gpl-2.0"], False),
        (") MIT", "", "", [], False),
        ("", "", "", [], False),
    ],
)
def test_expressions(text, parts, order, ids, permitted):
    got = licences.tokens(text)
    assert " ".join(got) == parts and " ".join(licences.postfix(got)) == order
    assert licences.evaluate(licences.postfix(got), licences.PERMISSIVE) == (ids, permitted)


def test_an_exception_can_be_what_is_allowed():
    order = licences.postfix(licences.tokens("GPL-2.0-only WITH Classpath-exception-2.0"))
    assert not licences.evaluate(order, frozenset({"mit"}))[1]
    assert licences.evaluate(order, frozenset({"gpl-2.0-only with classpath-exception-2.0"}))[1]


def test_random_expressions_agree_with_python():
    r = random.Random(4)
    ids = ["mit", "isc", "gpl-3.0-only", "mpl-2.0"]

    def made(depth):
        if depth == 0 or r.random() < 0.3:
            return r.choice(ids)
        one = f"{made(depth - 1)} {r.choice(['and', 'or'])} {made(depth - 1)}"
        return f"({one})" if r.random() < 0.5 else one

    for _ in range(300):
        text = made(4)
        allowed = frozenset(r.sample(ids, 2))
        want = eval(re.sub(r"[a-z0-9.]+(?:-[a-z0-9.]+)*", lambda m: m[0] if m[0] in ("and", "or") else str(m[0] in allowed), text))  # noqa: S307
        order = licences.postfix(licences.tokens(text))
        assert licences.evaluate(order, allowed) == (sorted({i for i in ids if i in re.findall(r"[a-z0-9.-]+", text)}), want)


def test_tags_in_texts(spark):
    _, docs = table(spark)
    got = {t: r for t, r in zip(TEXTS, licences.scan(docs.coalesce(1)).collect(), strict=False)}
    said = lambda t: [(e.word, e.expression, e.valid, e.permitted) for e in got[t].expressions]
    assert said(TEXTS[3]) == [(3, "( mit or gpl-2.0-or-later ) and apache-2.0", True, True)]
    assert said(TEXTS[4]) == [(3, "gpl-2.0-only with classpath-exception-2.0", True, False)]
    assert said(TEXTS[5]) == [(3, "mit", True, True)] and said(TEXTS[6]) == [(3, "mit", True, True)]
    assert [x[2] for t in TEXTS[7:10] for x in said(t)] == [False, False, False]
    assert said(TEXTS[10]) == [(3, "mit", True, True), (7, "gpl-3.0-only", True, False)]
    assert said(TEXTS[11]) == [(2, "licenseref-mine", True, False)]
    digests = dict(zip(TEXTS, licences.digest(licences.scan(docs.coalesce(1))).collect(), strict=False))
    assert digests[TEXTS[10]].labels == "gpl-3.0-only,mit" and digests[TEXTS[10]].score == 1 and digests[TEXTS[10]].permitted is False
    assert digests[TEXTS[8]].labels == "" and digests[TEXTS[8]].score == 0 and digests[TEXTS[8]].permitted is None


def test_an_empty_table(spark):
    assert licences.digest(licences.scan(data.empty(spark))).count() == 0


def test_the_query_gives_the_rows_of_its_sql(spark):
    name = "op11_license_scan"
    assert oracle.differs(QUERIES[name](spark, oracle.SF), ORACLES[name], oracle.connect()) == ""
