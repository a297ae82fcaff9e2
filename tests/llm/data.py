"""Small tables with what real ones hold: nulls in any column, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, norm string, id long, bucket int"
EN = "the of and to in that is was for with this from have they which their there would about other".split()
DE = "der die das und ist nicht ein eine mit auf sich auch nach werden wird einer sind zu im dem".split()


def words(r: random.Random, base: list[str], n: int) -> str:
    made = ["".join(r.choice(base) for _ in range(r.randint(1, 3))) for _ in range(40)]
    return " ".join(r.choice(base) if r.random() < 0.4 else r.choice(made) for _ in range(n))


def texts() -> list[tuple]:
    r = random.Random(5)
    rows = []
    for i in range(40):
        lang = "en" if i % 2 else "de"
        rows.append((i, words(r, EN if i % 2 else DE, r.randint(20, 80)), lang))
    copy = rows[3][1]
    rows += [(40 + i, copy.replace(" ", "  \n" if i % 2 else " "), "en") for i in range(6)]  # equal but for white space
    near = rows[5][1].split()
    for i in range(4):
        some = list(near)
        some[(0, 1, -1, -2)[i]] = "changed"
        rows.append((50 + i, " ".join(some), "en"))
    rows += [(60, None, "en"), (61, "", None), (62, " \n\t ", "de"), (63, "12 34 --", "en"), (64, "É è ß Ü", None), (None, "a row without an id", "en"), (None, None, None)]
    rows += [(70, "the same row", "en"), (70, "the same row", "en"), (70, "the same id", "en"), (71, "x", "en"), (72, "tab\tand\x0bvertical\x0c form", "en")]
    rows.append((80, words(r, EN, 6000), "en"))
    rows.append((81, "long" * 20000, "en"))
    return rows


def docs(spark):
    return spark.createDataFrame([(i, t, lang, f"src{(i or 0) % 3}", None if t is None else len(t), "row", "norm", 7, 1) for i, t, lang in texts()], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
