import math
import random

import numpy as np

from millrace.llm import vector_codes as vc
from tests import oracle
from millrace.llm.queries import ORACLES

SCHEMA = "vec_id long, embedding array<float>, label int, v int, id string, key string, code string, `a.b` int"


def row(i, vec, label=None):
    return (i, vec, label, 1, "id", "key", "code", 2)


def table(spark):
    r = random.Random(3)
    rows = [row(i, [r.gauss(0, 0.2) for _ in range(16)], i % 3 or None) for i in range(300)]
    rows += [row(7, rows[7][1], 9), row(7, rows[7][1], 9), row(None, [0.5] * 16, 4), row(900, [-1e-9] * 16, 4), row(901, [1e30] * 16, 5)]
    rows += [row(902, None, 1), row(903, [], 1), row(904, [0.1] * 15 + [None], 1), row(905, [0.1] * 15 + [math.nan], 1), row(906, [0.1] * 15 + [-math.inf], 1), row(907, [0.1] * 8, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows):
    """Codes, errors and codebooks by measuring every entry, in Python's integers."""
    own = [(i, v, lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [max(-vc.MOST, min(vc.MOST, math.floor(4096 * float(np.float32(x))))) for x in v], lab) for i, v, lab in own]
    ints.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [r for r in ints if len(r[1]) == len(ints[0][1])]
    w = len(ints[0][1]) // 8
    cutv = [(i, [v[p * w : p * w + w] for p in range(8)], lab) for i, v, lab in ints]
    books = [[r[1][p] for r in cutv[:16]] for p in range(8)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(6):
        new = [list(b) for b in books]
        for p in range(8):
            at = {}
            for _, parts, _ in cutv:
                at.setdefault(near(p, parts[p])[1], []).append(parts[p])
            for k, xs in at.items():
                new[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
        books = new
    out = []
    for i, parts, lab in cutv:
        found = [near(p, parts[p]) for p in range(8)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab))
    return out, books


def test_codes_errors_and_codebooks_are_those_of_measuring_every_entry(spark):
    df = table(spark)
    want, books = brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    total = {}
    for _, _, e, lab in want:
        total[lab] = total.get(lab, 0) + e
    got = vc.compressed(df).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=key) == sorted(((i, c, e, total[lab]) for i, c, e, lab in want), key=key)
    assert {r.codebooks_sha256 for r in got} == {vc.digest([np.array(b) for b in books])}


def test_partitions_do_not_matter(spark):
    a, b = (sorted(map(str, vc.compressed(table(spark).repartition(n)).collect())) for n in (1, 9))
    assert a == b


def test_bounds_lose_no_nearest_entry_and_spare_distances():
    r = np.random.default_rng(1)
    for width in (1, 2, 3, 7, 8, 16, 33):
        for scale in (2, 1000, vc.MOST):
            entries, x = r.integers(-scale, scale + 1, (16, width)), r.integers(-scale, scale + 1, (500, width))
            entries[5] = entries[9]
            of = vc.Bounds(entries)
            at, d = of.nearest(x)
            every = ((x[:, None] - entries) ** 2).sum(2)
            assert (at == every.argmin(1)).all() and (d == every.min(1)).all()
    r = np.random.default_rng(2)
    centres = np.cumsum(r.integers(-500, 500, (16, 32)), 1)
    of = vc.Bounds(centres)
    of.nearest(centres[r.integers(0, 16, 1000)] + r.integers(-50, 50, (1000, 32)))
    assert of.measured < 16 * 1000 / 4


def test_decoded_vectors_are_as_far_as_the_error_says(spark):
    vectors = vc.kept(table(spark))
    books = vc.fit(vectors)
    for r in vc.decode(vc.encode(vectors, books), books).join(vectors.select("id", "v"), "id").where("id > 10 and id < 300").collect():
        assert len(r.decoded) == 16
        assert round(sum((a - 4096 * b) ** 2 for a, b in zip(r.v, r.decoded))) == r.error


def test_few_vectors_and_none(spark):
    few = spark.createDataFrame([row(i, [0.1 * i, -0.3] + [0.0] * 3) for i in range(3)], SCHEMA)  # five components are filled up to eight
    got = {r.vec_id: (r.code, r.error) for r in vc.compressed(few).collect()}
    assert got[0] == ("00" * 8, 0) and got[2] == ("02" + "00" * 7, 0)
    assert vc.compressed(spark.createDataFrame([], SCHEMA)).count() == 0
    assert vc.compressed(spark.createDataFrame([row(1, None), row(2, [])], SCHEMA)).count() == 0


def test_the_query_gives_the_rows_of_its_sql(spark):
    from millrace.llm.queries import QUERIES

    assert oracle.differs(QUERIES["op12_vector_codes"](spark, oracle.SF), ORACLES["op12_vector_codes"], oracle.connect()) == ""
