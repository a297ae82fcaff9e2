"""Records of one stage built from those of the stage before: raw events, base records, parties by class, what is carried forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import non_blank, stable_id, to_int


def mapped(c: Column, types: dict[str, str]) -> Column:
    """The canonical type of a raw one, whatever its case and the blanks around it; null if there is none."""
    keys = {k.strip().upper(): v for k, v in types.items()}
    return F.create_map(*[x for k, v in keys.items() for x in (F.lit(k), F.lit(v))])[F.upper(F.trim(c))]


def raw_events(signals: DataFrame, types: dict[str, str], raw_type: str, dimension: DataFrame, key: str, dimension_key: str, groups: dict[str, dict[str, Column]], id_of: list[Column], prefix: str = "raw_") -> DataFrame:
    """Signals whose type is mapped, as events: raw_event_id, canonical_type, raw_type, found (the dimension has the key), and a struct for each of ``groups``.

    Groups name fields by expressions over both sides (``s`` and ``d``). The dimension must have a key once; what it lacks is null. Ids depend on ``id_of`` alone, so
    a signal that comes again gets the same. ``unmapped`` counts what was left out.
    """
    kind = mapped(F.col(f"s.{raw_type}"), types)
    rows = signals.alias("s").where(kind.isNotNull()).join(dimension.withColumn("__there", F.lit(True)).alias("d"), F.col(f"s.{key}") == F.col(f"d.{dimension_key}"), "left")
    structs = [F.struct(*[c.alias(n) for n, c in fields.items()]).alias(name) for name, fields in groups.items()]
    return rows.select(stable_id(*id_of, prefix=prefix).alias("raw_event_id"), kind.alias("canonical_type"), F.col(f"s.{raw_type}").alias("raw_type"), F.coalesce("d.__there", F.lit(False)).alias("found"), *structs)


def unmapped(signals: DataFrame, types: dict[str, str], raw_type: str) -> DataFrame:
    """raw_type and n of the signals that no type is mapped to; null and blank ones are one type."""
    return signals.where(mapped(F.col(raw_type), types).isNull()).groupBy(F.coalesce(non_blank(F.col(raw_type)), F.lit("")).alias("raw_type")).agg(F.count(F.lit(1)).alias("n"))


def resolution(match: Column, candidates: Column) -> Column:
    """``RESOLVED`` with one match, ``AMBIGUOUS`` with several candidates, else ``UNRESOLVED``."""
    return F.when(match.isNotNull() & (F.coalesce(candidates, F.lit(1)) == 1), "RESOLVED").when(candidates > 1, "AMBIGUOUS").otherwise("UNRESOLVED")


def base_records(events: DataFrame, id_col: str, match: Column, candidates: Column, carried: dict[str, Column], defaults: dict[str, Column] | None = None) -> DataFrame:
    """base_id, status, key (only of resolved records), review_reason (of all others) and ``carried`` (a struct of what goes on as it is, blank texts null).

    ``defaults`` stand in for carried fields that are null.
    """
    status = resolution(match, candidates)
    kept = {n: F.coalesce(c, defaults[n]) if defaults and n in defaults else c for n, c in carried.items()}
    return events.select(
        F.concat(F.lit("base_"), F.col(id_col)).alias("base_id"),
        status.alias("status"),
        F.when(status == "RESOLVED", match).alias("key"),
        F.when(status == "AMBIGUOUS", "several_matches").when(status == "UNRESOLVED", "no_match").alias("review_reason"),
        F.struct(*[c.alias(n) for n, c in kept.items()]).alias("carried"),
    )


def tagged_by_class(names: Column, classes: list[tuple[str, str]], tags: dict[str, str], other: str) -> Column:
    """array<struct<name, class, role>>: each name that is not blank with the class of the first (pattern, class) that is found in it, whatever the case
    (``individual`` if none is), and the role that ``tags`` has for the class, or ``other``."""
    def one(n: Column) -> Column:
        kind = F.coalesce(*[F.when(n.rlike(f"(?i){p}"), F.lit(k)) for p, k in classes], F.lit("individual"))
        role = F.coalesce(*[F.when(kind == k, F.lit(r)) for k, r in tags.items()], F.lit(other))
        return F.struct(n.alias("name"), kind.alias("class"), role.alias("role"))

    return F.transform(F.filter(F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda n: F.trim(n)), lambda n: n != ""), one)


def flag_or_code(flag: Column, code: Column, letter: str) -> Column:
    """A truth value that is given, else whether a string of code letters has the letter; null if neither is there."""
    return F.coalesce(flag, F.when(non_blank(code).isNotNull(), F.contains(F.upper(code), F.lit(letter.upper()))))


def translated(df: DataFrame, key: str, texts: dict[str, str], numbers: dict[str, str], flags: dict[str, tuple[str, str, str]]) -> DataFrame:
    """A dimension of another source: rows without a key go, texts are stripped (blank is null), numbers read out of texts of any form, and flags taken from
    (flag column, code column, letter). Each is new name: old name."""
    return df.where(non_blank(F.col(key).cast("string")).isNotNull()).select(
        non_blank(F.col(key).cast("string")).alias("key"),
        *[non_blank(F.col(old).cast("string")).alias(new) for new, old in texts.items()],
        *[to_int(F.col(old)).alias(new) for new, old in numbers.items()],
        *[flag_or_code(F.col(f), F.col(c), letter).alias(new) for new, (f, c, letter) in flags.items()],
    )


def notices(features: DataFrame, address: str, number: str, layer: str, types: dict[str, str], place: list[Column]) -> DataFrame:
    """Features of map layers as notices: number, address, type and place_id; ``features`` without an address or number go.

    A layer without a type has that of the layer that sorts first. Notices have no key of their own, so they share a stand-in, made of ``place``, with all others of
    that place; ``places`` has each of them once.
    """
    kind = F.coalesce(mapped(F.col(layer), types), F.lit(types[min(types)]))
    there = non_blank(F.col(address).cast("string")).isNotNull() & non_blank(F.col(number).cast("string")).isNotNull()
    return features.where(there).select(non_blank(F.col(number).cast("string")).alias("number"), non_blank(F.col(address).cast("string")).alias("address"), kind.alias("type"), stable_id(*place, prefix="place_").alias("place_id"))


def places(found: DataFrame) -> DataFrame:
    """place_id, address (the smallest) and notices of what ``notices`` gave."""
    return found.groupBy("place_id").agg(F.min("address").alias("address"), F.count(F.lit(1)).alias("notices"))
