"""Records out of pages: text nodes with their tags and regions, label and value pairs, rows of cells, dates.

A page is cut at its tags by marks that regular expressions set and ``split`` reads, so each function is a fold of a few linear passes
over an array of pieces, without Python. Scripts, styles and comments are no text; broken markup gives what its tags say.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.scalars import plain_text

_OPENING = r"<[A-Za-z][^>]*>"
#: Marks that are taken out of pages first.
_REGION, _TAG = "\x01", "\x02"


def _clean(html: Column) -> Column:
    c = F.translate(F.coalesce(html, F.lit("")), _REGION + _TAG, "  ")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    return F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>", "")


def _cut(c: Column, pattern: str, mark: str) -> Column:
    """The pieces of a text, a new one beginning wherever the pattern is found."""
    return F.split(F.regexp_replace(c, f"({pattern})", f"{mark}$1"), mark)


def nodes(html: Column, regions: dict[str, str]) -> Column:
    """array<struct<region, tag, text>>: each text of the page that is not blank, in order, with the last opening tag before it as it stands.

    ``regions`` are names and patterns of opening tags. A text is in the region whose tag came last, however deep it is, or in none
    (empty name); of several patterns that a tag meets, the first counts.
    """
    def texts(region: Column, part: Column) -> Column:
        def of(piece: Column) -> Column:
            tag = F.regexp_extract(piece, f"^{_OPENING}", 0)
            found = F.filter(F.transform(F.split(piece, "<[^>]*>"), plain_text), lambda t: t != "")
            return F.transform(found, lambda t: F.struct(region.alias("region"), tag.alias("tag"), t.alias("text")))

        return F.flatten(F.transform(_cut(part, _OPENING, _TAG), of))

    def name(part: Column) -> Column:
        return F.coalesce(*[F.when(part.rlike(f"^(?:{p})"), F.lit(n)) for n, p in regions.items()], F.lit(""))

    either = "|".join(f"(?:{p})" for p in regions.values())
    parts = _cut(_clean(html), either, _REGION) if regions else F.array(_clean(html))
    return F.flatten(F.transform(parts, lambda part: texts(name(part), part)))


def pairs(found: Column, label: str) -> Column:
    """array<struct<label, value>> of ``nodes``: each text whose tag meets the pattern, without a colon at its end, and the text after it.

    A label that is followed by another one, or by nothing, has the value null.
    """
    is_label = lambda s: s["tag"].rlike(label)
    after = F.concat(F.slice(found, 2, F.greatest(F.size(found), F.lit(1))), F.array(F.lit(None).cast("struct<region:string,tag:string,text:string>")))
    both = F.filter(F.zip_with(found, after, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda s: is_label(s["a"]))
    return F.transform(both, lambda s: F.struct(F.rtrim(F.regexp_replace(s["a"]["text"], r"\s*:\s*$", "")).alias("label"), F.when(~is_label(s["b"]), s["b"]["text"]).alias("value")))


def rows(html: Column, row: str = "tr", cell: str = "t[dh]") -> Column:
    """array<array<string>>: the cells of each row as plain texts, blank ones too. Rows without a cell are left out."""
    inside = lambda c, tag: F.transform(F.slice(F.split(c, rf"(?i)<{tag}\b[^>]*>"), 2, F.greatest(F.length(c), F.lit(1))), lambda x: F.get(F.split(x, rf"(?i)</{tag}\s*>"), 0))
    return F.filter(F.transform(inside(_clean(html), row), lambda r: F.transform(inside(r, cell), plain_text)), lambda r: F.size(r) > 0)


def earliest(c: Column, pattern: str, date_format: str) -> Column:
    """The earliest date of those that the pattern's first group finds and the format reads; null if there is none."""
    return F.array_min(F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), lambda d: F.try_to_date(d, date_format)))
