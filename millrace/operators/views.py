"""What readers of results ask for: facets, sorts, display and export rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def facets(df: DataFrame, chosen: dict[str, list]) -> DataFrame:
    """All facets must hold; within one, any value does. Of an array column, any element does. An empty facet filters nothing."""
    def holds(name: str, values: list) -> Column:
        if df.schema[name].dataType.typeName() == "array":
            return F.arrays_overlap(F.col(name), F.array(*[F.lit(v) for v in values]))
        return F.col(name).isin(values)

    return reduce(lambda d, x: d.where(holds(*x)) if x[1] else d, chosen.items(), df)


def ordered(df: DataFrame, by: str, down: bool, tie: str) -> DataFrame:
    """Sorted by one column in either direction, nulls last both ways."""
    c = F.col(by)
    return df.orderBy(c.desc_nulls_last() if down else c.asc_nulls_last(), tie)


def joined(*parts: Column, between: str = ", ") -> Column:
    """The parts that are not blank."""
    return F.concat_ws(between, *[F.nullif(F.trim(p), F.lit("")) for p in parts])


def flat(df: DataFrame, between: str = "|") -> DataFrame:
    """Arrays of scalars as one text each, other nested columns as JSON, for export."""
    out = []
    for f in df.schema:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind == "array" and f.dataType.elementType.typeName() not in ("struct", "array", "map"):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), between)
        elif kind in ("array", "struct", "map"):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def aged(df: DataFrame, first_seen: str, as_of: Column) -> DataFrame:
    """``df`` with is_new (first seen on the day) and days_known."""
    return df.withColumns({"is_new": F.to_date(first_seen) == as_of, "days_known": F.date_diff(as_of, F.to_date(first_seen))})


def canned(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """``df`` once for each of the named views whose condition holds, with column ``view``."""
    names = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in conditions.items()]))
    return df.withColumn("view", F.explode(names))


def as_json(df: DataFrame) -> Column:
    """A row as JSON with its columns in the order of their names, nulls included, so equal rows give equal bytes."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"})


def with_firsts(df: DataFrame, firsts: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with columns for a field of the first element of an array of structs: new name: (array, field). Null where the array is null or empty."""
    return df.withColumns({new: F.get(F.col(array), F.lit(0))[field] for new, (array, field) in firsts.items()})


def depth_or(depth: Column, items: Column) -> Column:
    """A count that is given and not 0, else how many different items there are."""
    return F.coalesce(F.nullif(depth.cast("int"), F.lit(0)), F.size(F.array_distinct(F.coalesce(items, F.array().cast("array<string>")))))


def decorated(df: DataFrame, history: DataFrame, key: str, today: Column) -> DataFrame:
    """``df`` with what the state of ``snapshots.upsert`` says of its key: is_new, is_updated (seen today, with another value than before), days_known and change. Without a history, a row is new."""
    rows = df.join(history.select(key, "first_seen", "last_seen", "delta"), key, "left")
    new = F.coalesce(F.col("first_seen") == today, F.lit(True))
    out = rows.withColumns({"is_new": new, "is_updated": ~new & F.coalesce((F.col("last_seen") == today) & (F.col("delta") != 0), F.lit(False)), "days_known": F.coalesce(F.date_diff(today, "first_seen"), F.lit(0)), "change": F.coalesce("delta", F.lit(0))})
    return out.drop("first_seen", "last_seen", "delta")


def seen_by(df: DataFrame, role: str, hidden: dict[str, Column]) -> DataFrame:
    """What a role sees: all rows but those that ``hidden`` has a condition for. A role that is not named sees all; a null condition hides nothing."""
    return df.where(~F.coalesce(hidden[role], F.lit(False))) if role in hidden else df


def best_first(df: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """The best row of each key (see ``snapshots.best_per_key``), the highest score first, nulls last, ties by ``tie``."""
    from .snapshots import best_per_key

    return best_per_key(df, key, score, tie).orderBy(F.col(score).desc_nulls_last(), tie)
