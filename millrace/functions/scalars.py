"""Scalar functions as column expressions. None of them raises under ANSI mode; what cannot be read becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's str.strip() removes, as Java's regular expressions read it with (?U).
_BLANK = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    """White space of any kind off both ends (Spark's trim takes spaces only)."""
    return F.regexp_replace(c, _BLANK, "")


def non_blank(c: Column) -> Column:
    """The stripped text, or null if nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def first_non_blank(*cs: Column) -> Column:
    return F.coalesce(*[non_blank(c) for c in cs])


def normalized_line(c: Column) -> Column:
    """Runs of white space as one space, upper case, no separators at either end."""
    return F.btrim(F.upper(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(",.;: \t"))


def leading_number(c: Column) -> Column:
    """The number that a text begins with, or the range of two, each with one letter at most, upper case without spaces; empty if there is none."""
    one = r"\d+[A-Z]?"
    return F.regexp_replace(F.regexp_extract(F.upper(c), rf"^\s*({one}(?:\s*-\s*{one})?)", 1), r"\s+", "")


def tokens(c: Column, least: int = 1) -> Column:
    """Distinct alphanumeric words of ``least`` characters or more, upper case, in order."""
    words = F.split(F.regexp_replace(F.upper(c), r"(?U)[^\p{Alnum}]+", " "), " ")
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= least))


def slug(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.upper(c), "[^A-Z0-9]+", "_"), F.lit("_"))


def label_of(key: Column) -> Column:
    """A key in words: underscores as spaces, first letters upper case."""
    return F.initcap(F.replace(key, F.lit("_"), F.lit(" ")))


def to_number(c: Column) -> Column:
    """A number out of a text such as ``$1,234.50``."""
    return F.regexp_replace(c.cast("string"), r"[$,\s]", "").try_cast("double")


def to_int(c: Column) -> Column:
    """Truncated toward zero."""
    n = to_number(c)
    return F.when(n.isNotNull(), F.when(n >= 0, F.floor(n)).otherwise(F.ceil(n)).try_cast("bigint"))


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def ratio_at_least(a: Column, b: Column, k: float) -> Column:
    """Both are there and not zero, and a is k times b at least."""
    return F.coalesce((a != 0) & (b != 0) & (a >= k * b), F.lit(False))


def iso_date(c: Column) -> Column:
    """The date in the first ten characters."""
    return F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")


def date_of(c: Column, *formats: str) -> Column:
    """The date by the first format that reads the text."""
    return F.coalesce(*[F.try_to_date(strip(c), f) for f in formats])


def first_weekday(c: Column, day: str) -> Column:
    """The first such day ("Tue") of the month."""
    return F.next_day(F.date_sub(F.trunc(c, "MM"), 1), day)


def off_days(c: Column, closed: list[str], step: int = 1) -> Column:
    """The date, moved by ``step`` days while it is one of the closed days ("MM-dd"), at most once for each of them."""
    first = F.get(F.filter(F.sequence(F.lit(0), F.lit(len(closed))), lambda i: ~F.date_format(F.date_add(c, i * step), "MM-dd").isin(closed)), 0)
    return F.date_add(c, F.coalesce(first, F.lit(len(closed))) * step)


def business_day(c: Column) -> Column:
    """The date itself, or the Monday after it if it falls on a weekend."""
    return F.when(F.weekday(c) >= 5, F.next_day(c, "Mon")).otherwise(c)


def stable_id(*parts: Column, length: int = 16, prefix: str = "") -> Column:
    """Hexadecimal digits of the SHA-1 of the parts between pipes; null counts as the empty text."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha1(joined), 1, length))


def plain_text(html: Column) -> Column:
    """A page's text: no scripts, styles or tags, the five named entities read, runs of white space as one space."""
    c = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    c = F.regexp_replace(c, r"(?s)<[^>]*>", " ")
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(sign))
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def labelled(c: Column, labels: list[str], until: str = r"[^\n;]") -> Column:
    """The value after the first of the labels that has one, up to a line's end or a semicolon."""
    return F.coalesce(*[F.nullif(strip(F.regexp_extract(c, rf"(?i)\b{label}\s*:\s*({until}+)", 1)), F.lit("")) for label in labels])


def cleaned_name(c: Column) -> Column:
    """Runs of white space as one space, without quotes around it or punctuation after it."""
    text = F.btrim(strip(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit("\"'"))
    return F.rtrim(text, F.lit(" ,.;:"))


def _words(c: Column) -> Column:
    """Upper case, single spaces, without a first word that begins with a digit."""
    text = F.trim(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"(?U)\s+", " "))
    return F.regexp_replace(text, r"^\d[^ ]*(?: |$)", "")


def _any_of(words: list[str]) -> str:
    return "(?:" + "|".join(rf"\Q{w.upper()}\E" for w in words) + ")" if words else "(?!)"


def body_words(c: Column, leading: list[str], trailing: list[str]) -> Column:
    """The words (upper case) without a number in front, then without any leading and trailing words of the lists, however many; none may be left."""
    text = F.regexp_replace(_words(c), f"^(?:{_any_of(leading)}(?: |$))+", "")
    return F.filter(F.split(F.regexp_replace(text, f"(?:(?:^| ){_any_of(trailing)})+$", ""), " "), lambda w: w != "")


def root_word(c: Column, leading: list[str]) -> Column:
    """The first word after the number and the leading words; empty if there is none."""
    return F.split_part(F.regexp_replace(_words(c), f"^(?:{_any_of(leading)}(?: |$))+", ""), F.lit(" "), F.lit(1))


def listed(c: Column, code: str) -> Column:
    """Whether a list of codes between commas or semicolons has the code, whatever the case."""
    codes = F.transform(F.split(F.upper(F.coalesce(c, F.lit(""))), "[,;]"), lambda x: F.trim(x))
    return F.array_contains(codes, code.upper())


def found(c: Column, patterns: dict[str, str]) -> Column:
    """An array of struct<kind, value>: the first group of each pattern that is found, in order."""
    hits = [F.when(c.rlike(p), F.struct(F.lit(k).alias("kind"), F.regexp_extract(c, p, 1).alias("value"))) for k, p in patterns.items()]
    return F.array_compact(F.array(*hits))


def entity_name(c: Column, forms: dict[str, str], noise: list[str] = ()) -> Column:
    """A name as names are compared: upper case words of letters and digits, those of ``noise`` left out, and the longest phrase of ``forms`` that it ends with
    in its short form, so ``Acme, L.L.C.`` and ``THE ACME limited liability company`` agree. Letters with points between them are one word."""
    text = F.regexp_replace(F.upper(c), r"(?<=\b[A-Z])\.(?=[A-Z]\b)", "")
    text = F.split(F.trim(F.regexp_replace(text, r"(?U)[^\p{Alnum}]+", " ")), " ")
    text = F.array_join(F.filter(text, lambda w: ~w.isin([n.upper() for n in noise])), " ") if noise else F.array_join(text, " ")
    ends = {long: rf"(^| )\Q{long.upper()}\E$" for long in sorted(forms, key=lambda f: (-len(f.split()), f))}
    return F.coalesce(*[F.when(text.rlike(e), F.regexp_replace(text, e, f"$1{forms[long].upper()}")) for long, e in ends.items()], text)
