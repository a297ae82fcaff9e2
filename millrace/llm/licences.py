"""Operator 11, licence scans: notice phrases and identifier tags by Aho-Corasick, licence expressions by a shunting-yard parser.

A text, with A-Z lower-cased, is a sequence of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. One automaton over the words joined by spaces finds every place where
the words of a phrase or of a tag stand consecutively, overlapping places too. What follows a tag on its line is read as an expression
of identifiers, ``and``, ``or``, ``with`` (all upper or all lower case), ``+`` and parentheses: the shunting-yard algorithm puts it into postfix order, ``with``
binding closest, then ``and``, then ``or``, and the postfix form is evaluated to the licences that it names and to whether a set of
allowed licences permits it (``and``: both, ``or``: either, ``with``: the licence, or the licence with that exception).

Labels are those of the phrases found, and the identifiers of the expressions, lower-cased. The score is 1 - 2^-e, where e is the number
of words of the longest phrase found for each label, summed over labels; a text with an expression that can be read scores 1.

Each row is scanned by itself, so no shuffle and no skew arises. Defined results: null is the empty text, without words, labels or score (0);
an expression ends before what cannot go on with it, and at the end of the line; one whose first identifier is unknown, or whose
parentheses do not close, is kept as not valid and gives no labels; repeated rows are scanned one by one; other columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import islice

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Names of public licences and first words of their notices, with the label of each.
NOTICES = {
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "apache software license": "apache",
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "free and unencumbered software released into the public domain": "unlicense",
    "dedicated to the public domain": "public-domain",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc0 1 0": "cc0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
}
TAGS = ("spdx license identifier", "license expression", "licence expression")
#: Licence and exception identifiers as they stand in public lists. Names that begin with ``licenseref-`` are known as well.
IDENTIFIERS = frozenset(
    """0bsd afl-3.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 artistic-2.0 bsd-2-clause bsd-3-clause bsl-1.0 cc-by-3.0 cc-by-4.0
    cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 ecl-2.0 epl-1.0 epl-2.0 eupl-1.2 gpl-2.0 gpl-2.0-only
    gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later isc lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later mit mit-0 mpl-1.1
    mpl-2.0 ms-pl ofl-1.1 postgresql psf-2.0 python-2.0 ruby unlicense upl-1.0 w3c wtfpl x11 zlib
    autoconf-exception-3.0 bison-exception-2.2 classpath-exception-2.0 gcc-exception-3.1 linux-syscall-note llvm-exception openssl-exception""".split()
)
#: Licences that ``permitted`` goes by where the caller names none: those that ask for notice at most.
PERMISSIVE = frozenset("0bsd apache-2.0 bsd-2-clause bsd-3-clause bsl-1.0 cc-by-4.0 cc0-1.0 isc mit mit-0 python-2.0 unlicense zlib".split())

_SEPARATORS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010FFFF]+")
_TOKEN = re.compile(r"\s*(?:([()])|([A-Za-z0-9][A-Za-z0-9.-]*\+?))")
_BINDS = {"or": 1, "and": 2, "with": 3}
#: Words of evidence that make the score 1.
SURE = 64


def tokens(text: str) -> list[str]:
    """The tokens of the expression that ``text`` begins with: as far as it can go on, and no further than its parentheses close."""
    out: list[str] = []
    open_, at, whole = 0, 0, 0
    operand = True  # an identifier or an opening parenthesis is due
    while m := _TOKEN.match(text, at):
        bracket, word = m.groups()
        low = (word or "").lower().rstrip(".-")
        if operand and bracket == "(":
            open_ += 1
        elif not operand and bracket == ")" and open_:
            open_ -= 1
        elif operand and word and low not in _BINDS and (low.rstrip("+") in IDENTIFIERS or low.startswith("licenseref-")):
            operand = False
        elif not operand and word in ("and", "or", "with", "AND", "OR", "WITH"):
            operand = True
        else:
            break
        out.append(bracket or low)
        if not operand and not open_:
            whole = len(out)
        at = m.end()
        if word and word.endswith("."):
            break
    return out[:whole]


def postfix(parts: Iterable[str]) -> list[str]:
    """Shunting-yard: what ``tokens`` returned, in postfix order."""
    out, held = [], []
    for t in parts:
        if t in _BINDS:
            while held and _BINDS.get(held[-1], 0) >= _BINDS[t]:
                out.append(held.pop())
            held.append(t)
        elif t == "(":
            held.append(t)
        elif t == ")":
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        else:
            out.append(t)
    return out + held[::-1]


def evaluate(order: Iterable[str], allowed: frozenset[str]) -> tuple[list[str], bool]:
    """The licences (exceptions left out) that a postfix expression names, and whether ``allowed`` permits it. Malformed operands of ``with`` are taken as licences."""
    stack: list[tuple[list[str], bool, str]] = []
    for t in order:
        if t in _BINDS:
            (b_ids, b_ok, b_name), (a_ids, a_ok, a_name) = stack.pop(), stack.pop()
            if t == "with":
                stack.append((a_ids, a_ok or f"{a_name} with {b_name}" in allowed, ""))
            else:
                stack.append((a_ids + b_ids, a_ok and b_ok if t == "and" else a_ok or b_ok, ""))
        else:
            stack.append(([t.rstrip("+")], t in allowed or t.rstrip("+") in allowed, t))
    return (sorted(set(stack[0][0])), stack[0][1]) if stack else ([], False)


class Scanner:
    """Phrases, tags and allowed licences, and what they say of a text."""

    def __init__(self, base: dict[str, str], notices: dict[str, str], tags: Iterable[str], allowed: frozenset[str]):
        self.automaton, self.allowed = ahocorasick.Automaton(), allowed
        found: dict[str, list[tuple[str, str]]] = {}
        for kind, phrases in (("base", base), ("notice", notices), ("tag", dict.fromkeys(tags, ""))):
            for phrase, label in phrases.items():
                found.setdefault(f" {phrase} ", []).append((kind, label))
        for phrase, meant in found.items():
            self.automaton.add_word(phrase, (phrase.count(" ") - 1, meant))
        self.automaton.make_automaton()

    def scan(self, text: str | None) -> dict:
        """Words, places (first word, words, kind, label) in the order of their ends, and expressions."""
        words = (text or "").encode().lower().translate(_SEPARATORS).split()
        line = " " + b" ".join(words).decode() + " "
        places, tagged, at, before = [], [], 0, 0
        for end, (size, meant) in self.automaton.iter(line):
            before += line.count(" ", at, end)
            at = end
            for kind, label in meant:
                if kind == "tag":
                    tagged.append(before - 1)
                else:
                    places.append((before - size, size, kind, label))
        return {"n_words": len(words), "places": places, "expressions": list(self.expressions(text or "", tagged))}

    def expressions(self, text: str, last: list[int]) -> Iterator[dict]:
        """The expressions after the tags whose last words are numbered ``last`` (ascending)."""
        each, done = _WORD.finditer(text), 0
        for number in last:
            if number < done:  # two tags with the same last word
                continue
            start = next(islice(each, number - done, None)).end()
            done = number + 1
            rest = text[start : (n if (n := text.find("\n", start)) >= 0 else len(text))].lstrip(" \t\r:=\"'")
            parts = tokens(rest)
            order = postfix(parts)
            ids, permitted = evaluate(order, self.allowed)
            yield {"word": number + 1, "expression": " ".join(parts), "postfix": order, "licences": ids, "valid": bool(parts), "permitted": permitted}


FOUND = (
    "n_words long, places array<struct<word: long, words: long, kind: string, label: string>>, "
    "expressions array<struct<word: long, expression: string, postfix: array<string>, licences: array<string>, valid: boolean, permitted: boolean>>"
)
_PLACES = pa.list_(pa.struct([("word", pa.int64()), ("words", pa.int64()), ("kind", pa.string()), ("label", pa.string())]))
_EXPRESSIONS = pa.list_(
    pa.struct([("word", pa.int64()), ("expression", pa.string()), ("postfix", pa.list_(pa.string())), ("licences", pa.list_(pa.string())), ("valid", pa.bool_()), ("permitted", pa.bool_())])
)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: dict[str, str] = BASE,
    notices: dict[str, str] = NOTICES,
    tags: Iterable[str] = TAGS,
    allowed: frozenset[str] = PERMISSIVE,
) -> DataFrame:
    """Per row: id, n_words, places (word, words, kind base or notice, label) and expressions (word, expression, postfix, licences, valid, permitted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices, tags, allowed)
        for b in batches:
            found = [scanner.scan(t.as_py()) for t in b.column(1)]
            names = ("word", "words", "kind", "label")
            places = pa.array([[dict(zip(names, p, strict=True)) for p in f["places"]] for f in found], _PLACES)
            columns = [b.column(0), pa.array([f["n_words"] for f in found], pa.int64()), places, pa.array([f["expressions"] for f in found], _EXPRESSIONS)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "places", "expressions"])

    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, {FOUND}").withColumnRenamed("id", id_col)


def evidence(places: Column) -> Column:
    """Words of the longest phrase found for each label, summed over labels."""
    labels = F.array_distinct(F.transform(places, lambda p: p["label"]))
    return F.aggregate(
        F.transform(labels, lambda k: F.array_max(F.transform(F.filter(places, lambda p: p["label"] == k), lambda p: p["words"]))), F.lit(0).cast("long"), lambda a, b: a + b
    )


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What ``scan`` found as a row of scalars: places of base phrases, labels, score, expressions and whether all of them are permitted (null: none)."""
    base = F.filter("places", lambda p: p["kind"] == "base")
    valid = F.filter("expressions", lambda e: e["valid"])
    starts = F.transform(base, lambda p: p["word"])
    labels_of = lambda places: F.array_join(F.array_sort(F.array_distinct(places)), ",")
    named = F.flatten(F.transform(valid, lambda e: e["licences"]))
    return found.select(
        f"`{id_col}`",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels_of(F.transform(base, lambda p: p["label"])).alias("base_labels"),
        labels_of(F.concat(F.transform("places", lambda p: p["label"]), named)).alias("labels"),
        F.when(F.size(valid) > 0, 1.0).otherwise(1 - F.pow(F.lit(2.0), -F.least(evidence(F.col("places")), F.lit(SURE)))).alias("score"),
        F.size("expressions").cast("long").alias("n_expressions"),
        F.when(F.size(valid) > 0, F.forall(valid, lambda e: e["permitted"])).alias("permitted"),
    )
