"""Operator 1, exact dedup: local, salted, then global combining of equal texts.

Texts are equal when they are identical after each run of ASCII white space has become one space; null counts as empty.
Texts whose SHA-256 no other row has are equal to nothing and go no further. Every stage of the others groups by the digest *and* the whole normalised
text, and so do rows when they look up their winner, so equality is never taken from a digest alone:

1. each task combines its own rows (Spark's partial aggregation; the salt is the task's partition, so a task hands on one row
   for each different text, however many copies it holds),
2. the salted groups ``(digest, salt, text)`` are merged, so that a text with any number of copies is dealt over many tasks,
3. the winners of the salts are combined globally by ``(digest, text)``: at most one row for each text and salt.

Defined results: empty table, no rows; null text is the empty text; null ids come after all others; of rows that repeat id and
text, one is kept; columns of any name are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, cut, each_of, sized_join, weighed_join, wrapped

SALTS = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _salt() -> Column:
    return F.pmod(F.spark_partition_id(), F.lit(SALTS))


def groups(keyed: DataFrame) -> DataFrame:
    """From rows (id, norm, sha), one row for each different text: sha, norm, keep_id (smallest id), group_size."""
    salted = keyed.withColumn("salt", _salt()).groupBy("sha", "salt", "norm").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("sha", "norm").agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size"))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts leave their task only where their digest is there twice. Rows of a text with many copies look its winner up without leaving their task.
    """
    norm = docs.select(F.col(f"`{id_col}`").alias("id"), normalised(F.col(f"`{text_col}`")).alias("norm"))
    keyed = norm.select("id", "norm", F.sha2("norm", 256).alias("sha"))
    narrow = cut(keyed.select("id", "sha"), "digests")
    twice = cut(narrow.groupBy("sha").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sha"), "twice")
    alone = sized_join(narrow, twice, ["sha"], "left_anti").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")

    shared = cut(sized_join(keyed, twice, ["sha"], "left_semi"), "shared")
    winners = cut(groups(shared), "winners")
    rows = shared.groupBy("id", "sha", "norm").agg(F.count(F.lit(1)).alias("times"))
    found = weighed_join(rows, winners.withColumn("rows", F.col("group_size")), ["sha", "norm"], "rows")
    each = each_of(found.select("id", "sha", "keep_id", "group_size", "times"), "times", "nth")
    several = each.select("id", "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 0)).alias("kept"), "sha")
    return alone.union(several).select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of equal texts, the row with the smallest id.

    The rows themselves travel through the three stages, so nothing is joined back.
    """
    order = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"))
    keyed = docs.select(wrapped(docs).alias("row"), order.alias("o"), normalised(F.col(f"`{text_col}`")).alias("norm"))
    keyed = keyed.select("row", "o", "norm", F.sha2("norm", 256).alias("sha"), _salt().alias("salt"))
    salted = keyed.groupBy("sha", "salt", "norm").agg(F.min_by("row", "o").alias("row"), F.min("o").alias("o"))
    return salted.groupBy("sha", "norm").agg(F.min_by("row", "o").alias("row")).select("row.*")
