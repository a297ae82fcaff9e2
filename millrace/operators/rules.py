"""Rule tables compiled to column expressions. The rules are data of the caller; none are built in."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import slug


def first_match(c: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The label of the first (pattern, label) whose regular expression is found."""
    out = F
    for pattern, label in rules:
        out = out.when(c.rlike(pattern), label)
    return out.otherwise(default) if rules else F.lit(default)


def lookup(c: Column, *layers: tuple[dict[str, str], int, str]) -> Column:
    """struct<value, confidence, layer> of the first layer (map, confidence, name) that has the key; null if none has."""
    hits = []
    for table, confidence, name in layers:
        if table:
            found = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])[c]
            hits.append(F.when(found.isNotNull(), F.struct(found.alias("value"), F.lit(confidence).alias("confidence"), F.lit(name).alias("layer"))))
    return F.coalesce(*hits)


def flags(rules: dict[str, Column]) -> Column:
    """Sorted names of the conditions that hold; a null condition does not."""
    return F.array_sort(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()])))


def points(rules: dict[str, tuple[Column, float]], most: float | None = None) -> Column:
    """Sum of the points of the conditions that hold, up to ``most``."""
    total = F.lit(0.0)
    for c, value in rules.values():
        total = total + F.when(F.coalesce(c, F.lit(False)), F.lit(float(value))).otherwise(0.0)
    return total if most is None else F.least(total, F.lit(float(most)))


def band(c: Column, bands: list[tuple[float, str]], lowest: str) -> Column:
    """The name of the first band whose bound the value reaches; bands from high to low."""
    out = F
    for bound, name in bands:
        out = out.when(c >= bound, name)
    return out.otherwise(lowest)


def ordered_paths(rules: list[tuple[str, Column, bool]]) -> Column:
    """Names of the conditions that hold, in order, each once; nothing after one that stops (the third item)."""
    stopped, out = F.lit(False), []
    for name, c, stops in rules:
        holds = F.coalesce(c, F.lit(False)) & ~stopped
        out.append(F.when(holds, F.lit(name)))
        if stops:
            stopped = stopped | holds
    return F.array_distinct(F.array_compact(F.array(*out)))


def repeated(items: Column, count: str, value: str) -> Column:
    """Of an array of structs, each one's ``value`` as often as its ``count`` says."""
    return F.flatten(F.transform(items, lambda s: F.array_repeat(s[value], s[count].cast("int"))))


def allowed(c: Column, values: list[str], policy: str) -> Column:
    """struct<keep, flag> of a value against a list, upper case and trimmed: ``drop`` keeps listed values only, ``flag`` and ``warn`` keep all and name the others.
    Blank values and an empty list keep."""
    text = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    known = (text == "") | text.isin([v.upper() for v in values]) if values else F.lit(True)
    flag = F.when(~known & F.lit(policy != "drop"), F.lit(policy))
    return F.struct((known | F.lit(policy != "drop")).alias("keep"), flag.alias("flag"))


def has_fragment(c: Column, fragments: list[str]) -> Column:
    """Whether the text has any of the fragments, whatever the case."""
    out = F.lit(False)
    for f in fragments:
        out = out | F.contains(F.upper(c), F.lit(f.upper()))
    return F.coalesce(out, F.lit(False))


def any_present(*cs: Column) -> Column:
    out = F.lit(False)
    for c in cs:
        out = out | F.coalesce(F.trim(c) != "", F.lit(False))
    return out


def fan_out(broad: dict[str, list[str]], explicit: dict[str, object], values: dict[str, object], override: dict[str, object] | None = None) -> dict[str, object]:
    """A rule table in which each alias of a broad key has that key's value, explicit rows win over those, and a run's own rows over all."""
    return {a: values[k] for k, aliases in broad.items() for a in aliases if k in values} | explicit | (override or {})


def fan_out_rows(broad: DataFrame, values: DataFrame, explicit: DataFrame, override: DataFrame | None = None) -> DataFrame:
    """The same with tables: (alias, value, origin) from broad (key, alias), values (key, value), explicit and override (alias, value).

    Each alias of a key has that key's value; an explicit row wins over those, and a run's own over all. origin says which it was. Of several values of one
    alias and origin the smallest counts.
    """
    ranked = [(broad.join(values, "key"), "broad", 2), (explicit, "explicit", 1)] + ([(override, "override", 0)] if override is not None else [])
    rows = reduce(DataFrame.unionByName, [df.select("alias", F.struct(F.lit(rank).alias("rank"), F.col("value").alias("value"), F.lit(name).alias("origin")).alias("v")) for df, name, rank in ranked])
    return rows.groupBy("alias").agg(F.min("v").alias("v")).select("alias", "v.value", "v.origin")


def review(seeds: Column, rules: dict[str, Column]) -> Column:
    """struct<reasons, status>: the seeds and the names of the conditions that hold, in order and each once; status is ``review`` if there is any, else ``clear``."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    reasons = F.array_distinct(F.concat(F.coalesce(seeds, F.array().cast("array<string>")), found))
    return F.struct(reasons.alias("reasons"), F.when(F.size(reasons) > 0, "review").otherwise("clear").alias("status"))


def fuzzy_label(c: Column, labels: list[str], least: float = 0.9, opposites: tuple[str, ...] = ()) -> Column:
    """The label most like the text by edit distance, if 1 - distance / length reaches ``least``; of equals, the first. A text and a label
    of which only one has a word out of ``opposites`` are never alike."""
    scored = []
    for i, label in enumerate(labels):
        like = 1 - F.levenshtein(c, F.lit(label)) / F.greatest(F.length(c), F.lit(max(1, len(label))))
        for word in opposites:
            like = F.when(F.contains(c, F.lit(word)) == F.lit(word in label), like).otherwise(-1.0)
        scored.append(F.struct(like.alias("like"), F.lit(-i).alias("place"), F.lit(label).alias("label")))
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return F.when(best["like"] >= least, best["label"])


def prefix_class(c: Column, usable: list[str], review: list[str], noise: list[str]) -> Column:
    """What the letters that a code begins with (in any case) make of it: ``usable``, ``review``, ``noise`` or ``unsupported``; a code without letters in front is noise, and so is none."""
    prefix = F.regexp_extract(F.upper(F.coalesce(c, F.lit(""))), r"^\s*([A-Z]+)", 1)
    of = lambda values: prefix.isin([v.upper() for v in values])
    return F.when(prefix == "", "noise").when(of(usable), "usable").when(of(review), "review").when(of(noise), "noise").otherwise("unsupported")


def elsewhere(region: Column, zone: Column, home: str, known: list[str], home_zones: list[str]) -> Column:
    """Whether a row is from a known region other than ``home``, and its zone (a postal code, say) does not begin like one of home's. Anything missing or unknown is not elsewhere."""
    code, begins = F.upper(F.trim(region)), F.lit(False)
    for z in home_zones:
        begins = begins | F.startswith(F.coalesce(F.trim(zone), F.lit("")), F.lit(z))
    return F.coalesce(code.isin([k.upper() for k in known]) & (code != home.upper()) & ~begins, F.lit(False))


def regime(c: Column, modes: list[tuple[str, str]]) -> Column:
    """The mode of the first (fragment, mode) that a free text contains, whatever the case; null if it has none."""
    text = F.upper(c)
    return F.coalesce(*[F.when(F.contains(text, F.lit(f.upper())), F.lit(m)) for f, m in modes])


def by_regime(name: Column, table: dict[str, str], mode: Column, variants: dict[str, dict[str, str]], sentinel: str = "by_regime") -> Column:
    """What a table has for a name; where that is the sentinel, what the name's ``variants`` have for the mode. Null if there is nothing."""
    def lookup(pairs: dict[str, str], key: Column) -> Column:
        return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), F.lit(v))])[key] if pairs else F.lit(None).cast("string")

    found = lookup(table, name)
    inner = F.coalesce(*[F.when(name == n, lookup(pairs, mode)) for n, pairs in variants.items()], F.lit(None).cast("string"))
    return F.when(found == sentinel, inner).otherwise(found)


def normalized(raw: Column, exact: dict[str, str], synonyms: dict[str, tuple[str, int]], registry: dict[str, list[str]]) -> Column:
    """struct<value, confidence, reason, review> of a raw label by the first layer that knows it.

    The layers: ``exact`` (as it stands, 100), ``synonyms`` of the user (value and confidence, whatever the case), the keys of ``registry`` (100), their
    abbreviations (100), and the slugs of both (95). What none knows has no value, confidence 0 and is for review, and so are blank labels.
    """
    text = F.trim(raw)
    upper, form = F.upper(text), slug(raw)

    def layer(table: dict[str, tuple[str, int]], c: Column, reason: str) -> Column:
        if not table:
            return F.lit(None).cast("struct<value:string,confidence:int,reason:string,review:boolean>")
        hit = F.create_map(*[x for k, (v, n) in table.items() for x in (F.lit(k), F.struct(F.lit(v).alias("value"), F.lit(n).alias("confidence"), F.lit(reason).alias("reason"), F.lit(False).alias("review")))])[c]
        return hit

    keys = {k.upper(): (k, 100) for k in registry}
    short = {a.upper(): (k, 100) for k, of in reversed(registry.items()) for a in of}
    slugs = {re.sub("[^A-Z0-9]+", "_", a.upper()).strip("_"): (k, 95) for k, of in reversed(registry.items()) for a in [*of, k]}
    none = lambda why: F.struct(F.lit(None).cast("string").alias("value"), F.lit(0).alias("confidence"), F.lit(why).alias("reason"), F.lit(True).alias("review"))
    found = F.coalesce(
        layer({k: (v, 100) for k, v in exact.items()}, text, "exact"), layer({k.strip().upper(): v for k, v in synonyms.items()}, upper, "synonym"), layer(keys, upper, "key"), layer(short, upper, "abbreviation"), layer(slugs, form, "slug"), none("unknown")
    )
    return F.when(F.coalesce(text, F.lit("")) == "", none("empty")).otherwise(found)


def derived(rules: list[tuple[str, Column | Callable[[dict[str, Column]], Column], list[str]]]) -> Column:
    """Sorted names of the flags that hold. A rule is a name, its condition (a column, or a function of the flags before it) and flags that hold with it."""
    held: dict[str, Column] = {}
    for name, condition, implied in rules:
        c = F.coalesce(condition(held) if callable(condition) and not isinstance(condition, Column) else condition, F.lit(False))
        for n in (name, *implied):
            held[n] = held[n] | c if n in held else c
    return F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in held.items()])))


def with_history(history: Column, status: Column, reasons: Column, run: Column) -> Column:
    """A history (array<struct<run, status, reasons>>) with an entry for this run, if status or reasons are others than those of the last entry."""
    entry = F.struct(run.alias("run"), status.alias("status"), reasons.alias("reasons"))
    old = F.coalesce(history, F.array().cast("array<struct<run:date,status:string,reasons:array<string>>>"))
    last = F.when(F.size(old) > 0, F.element_at(old, -1))
    same = F.coalesce(last["status"].eqNullSafe(status) & last["reasons"].eqNullSafe(reasons), F.lit(False)) & last.isNotNull()
    return F.when(same, old).otherwise(F.concat(old, F.array(entry)))
