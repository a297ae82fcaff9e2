"""Entity merge: rows that share two strong identifiers are one entity, rows that share only one are for review.

No pairs of rows are made. Two rows share two identifiers if they have the same value in both of two kinds, so every combination of two
kinds is a key, and the rows of a key are one entity, however many they are. A key links its rows to the smallest of them, and from there on
only links of two ids travel. In each round an id goes to its smallest neighbour, if that is smaller, and on along where that goes, which is followed by
doubling; links are then drawn anew between where their ends went. So every round at least halves the ids that still have links. Sides of
a join are shuffled, so Spark splits what a hot key has.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import kept


def _present(c: Column) -> Column:
    """A value as text; blank and null ones identify nothing."""
    text = c.cast("string")
    return F.when(F.trim(text) != "", text)


def strong_values(df: DataFrame, id_col: str, kinds: dict[str, list[Column]]) -> DataFrame:
    """id and a column for each kind of identifier: its parts as JSON, or the digest of that if it is longer; null unless all parts are there.

    An identifier of several parts (a name with an address, say) is strong only as a whole.
    """

    def digest(parts: list[Column]) -> Column:
        texts = [_present(p) for p in parts]
        whole = F.to_json(F.array(*texts))
        return F.when(F.concat(*texts).isNotNull(), F.when(F.length(whole) > 40, F.sha1(whole.cast("binary"))).otherwise(whole))

    return df.select(F.col(id_col).alias("id"), *[digest(parts).alias(name) for name, parts in kinds.items()])


def pair_keys(values: DataFrame, kinds: list[str]) -> DataFrame:
    """id and key: a key for each two kinds that a row has both of."""
    keys = [F.when(F.concat(a, b).isNotNull(), F.to_json(F.array(F.lit(f"{i}"), F.col(a), F.col(b)))) for i, (a, b) in enumerate(combinations(kinds, 2))]
    return values.select("id", F.explode(F.array_compact(F.array(*keys))).alias("key"))


def connected(links: DataFrame) -> DataFrame:
    """id and label (the smallest id reachable through shared keys) from links (id, key), for the ids whose label is not their own."""
    least = links.groupBy("key").agg(F.min("id").alias("v"), F.max("id").alias("last")).where("v < last").drop("last")
    edges = kept(links.join(least, "key").where("id <> v").select(F.col("id").alias("u"), "v").distinct(), "edges")
    moves = []
    while edges.head(1):
        both = edges.union(edges.select("v", "u"))
        to = kept(both.groupBy("u").agg(F.min("v").alias("m")).where("m < u"), "moves")
        while True:
            on = to.select(F.col("u").alias("m"), F.col("m").alias("next"))
            further = kept(to.join(on, "m", "left").select("u", F.coalesce("next", "m").alias("m"), F.col("next").isNotNull().alias("went")), "moves")
            to = further.select("u", "m")
            if not further.where("went").head(1):
                break
        moves.append(to)
        ends = to.withColumnRenamed("m", "new")
        moved = edges.join(ends, "u", "left").select(F.coalesce("new", "u").alias("u"), "v")
        moved = moved.join(ends.withColumnRenamed("u", "v"), "v", "left").select("u", F.coalesce("new", "v").alias("v"))
        edges = kept(moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    if not moves:
        return links.select("id", F.col("id").alias("label")).limit(0)
    # What went in a round is in no later one, so the rounds' ids are disjoint.
    whole = moves.pop()
    while moves:
        to = moves.pop()
        on = whole.select(F.col("u").alias("m"), F.col("m").alias("next"))
        whole = kept(to.join(on, "m", "left").select("u", F.coalesce("next", "m").alias("m")).union(whole), "labels")
    return whole.select(F.col("u").alias("id"), F.col("m").alias("label"))


def merged(df: DataFrame, id_col: str, kinds: dict[str, list[Column]]) -> DataFrame:
    """One row for each id: id, entity (smallest id of its entity), size, and shared: the sorted kinds whose value other entities have too.

    ``shared`` that is not empty is a possible duplicate that no second identifier confirms: it is for review, and never merged.
    Ids must be unique and not null. A row without identifiers is an entity of its own.
    """
    names = list(kinds)
    values = kept(strong_values(df, id_col, kinds), "values")
    found = connected(pair_keys(values, names))
    rows = kept(values.join(found, "id", "left").withColumn("entity", F.coalesce("label", "id")).drop("label"), "entities")
    sizes = rows.groupBy("entity").agg(F.count(F.lit(1)).alias("size"))
    each = rows.select("id", "entity", F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(n).alias("value")) for i, n in enumerate(names)])).alias("x")).select("id", "entity", "x.*").where("value is not null")
    several = kept(each.groupBy("kind", "value").agg(F.min("entity").alias("a"), F.max("entity").alias("b")).where("a < b").select("kind", "value"), "several")
    flagged = each.select("id", "kind", "value").join(several, ["kind", "value"]).groupBy("id").agg(F.collect_set("kind").alias("kinds"))
    labels = F.array_sort(F.transform("kinds", lambda k: F.get(F.array(*map(F.lit, names)), k)))
    out = rows.select("id", "entity").join(sizes, "entity").join(flagged, "id", "left")
    return out.select(F.col("id").alias(id_col), "entity", "size", F.coalesce(labels, F.array().cast("array<string>")).alias("shared"))
