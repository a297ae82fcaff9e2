"""Aggregations over keys that may be missing, two-level nesting, roll-ups and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_group_key(df: DataFrame, key: str, fallbacks: list[str]) -> DataFrame:
    """``df`` with ``group_key`` and ``key_missing``: the key, or else the first fallback that is there. So rows without a key are
    told apart by what else they have, and never meet a row that has one."""
    return df.withColumns({"key_missing": F.col(key).isNull(), "group_key": F.coalesce(*[F.col(c).cast("string") for c in [key, *fallbacks]])})


def set_size(c: Column) -> Column:
    """Distinct non-blank values, and each blank or null one counted for itself."""
    filled = F.nullif(F.trim(c), F.lit(""))
    return F.count_distinct(filled) + F.count_if(filled.isNull())


def merge_groups(df: DataFrame, keys: list[str], instrument: str, lists: list[str], date: str) -> DataFrame:
    """One row for each group: n (see set_size), the sorted distinct values of each list column, earliest and latest date."""
    gathered = [F.array_sort(F.collect_set(c)).alias(c) for c in lists]
    return df.groupBy(*keys).agg(set_size(F.col(instrument)).alias("n"), *gathered, F.min(date).alias("earliest"), F.max(date).alias("latest"))


def nest(groups: DataFrame, key: str, order: list[str], name: str = "groups") -> DataFrame:
    """One row for each key with its groups as an array of structs, sorted by the given columns."""
    rest = [c for c in groups.columns if c != key and c not in order]
    return groups.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias(name))


def representative(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The row with the smallest ``by`` of each key."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), by).alias("row")).select(*keys, "row.*")


def weakest(df: DataFrame, key: str, label: str, ranks: dict[str, int], unknown: str) -> DataFrame:
    """The label of the lowest rank of each key; labels that are not ranked, and none, are ``unknown`` (rank -1)."""
    table = F.create_map(*[x for k, v in ranks.items() for x in (F.lit(k), F.lit(v))])
    names = F.create_map(*[x for k, v in ranks.items() for x in (F.lit(v), F.lit(k))])
    low = df.groupBy(key).agg(F.min(F.coalesce(table[F.col(label)], F.lit(-1))).alias("rank"))
    return low.select(key, F.coalesce(names[F.col("rank")], F.lit(unknown)).alias(label))


def histogram(df: DataFrame, value: str) -> DataFrame:
    """Rows by value; of an array, its elements, repeats counted."""
    is_array = df.schema[value].dataType.typeName() == "array"
    values = df.select(F.explode(value).alias("value")) if is_array else df.select(F.col(value).alias("value"))
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def header(df: DataFrame, values: list[str]) -> DataFrame:
    """Histograms of several columns in one pass over the rows: column, value, n."""
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in values]))
    return df.select(stacked.alias("x")).groupBy("x.column", "x.value").agg(F.count(F.lit(1)).alias("n"))


def union_arrays(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The sorted distinct elements of all arrays of a group. Elements are combined before the shuffle; a group without any has an empty array."""
    return df.select(*keys, F.explode_outer(column).alias("__x")).groupBy(*keys).agg(F.array_sort(F.collect_set("__x")).alias(column))


def holders(df: DataFrame, name: Column, key: str, least: int, sentinels: list[str]) -> DataFrame:
    """Names (upper case, trimmed) with ``least`` or more distinct keys, and the keys in order. Blank names and those with a sentinel word go."""
    named = df.select(F.upper(F.trim(name)).alias("name"), key).where("name <> ''")
    words = F.split("name", r"\s+")
    kept = named.where(~F.arrays_overlap(words, F.array(*[F.lit(s.upper()) for s in sentinels]))) if sentinels else named
    return kept.groupBy("name").agg(F.array_sort(F.collect_set(key)).alias("keys")).where(F.size("keys") >= least)


def metrics(df: DataFrame, shares: dict[str, Column], averages: dict[str, Column]) -> DataFrame:
    """metric and value, from one pass: the share of rows that meet a condition (null does not), and averages over the rows that have a value."""
    found = df.agg(*[F.avg(F.when(F.coalesce(c, F.lit(False)), 1.0).otherwise(0.0)).alias(f"m{i}") for i, c in enumerate(shares.values())], *[F.avg(c).alias(f"a{i}") for i, c in enumerate(averages.values())])
    names = [(n, f"m{i}") for i, n in enumerate(shares)] + [(n, f"a{i}") for i, n in enumerate(averages)]
    return found.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(c).cast("double").alias("value")) for n, c in names])).alias("x")).select("x.*")
