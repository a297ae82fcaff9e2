"""Operator 2, sharding: a Feistel permutation with cycle walking over global row numbers.

Rows get dense global row numbers 0..N-1, in the order of a hash bucket of all key columns and then of those columns. A Feistel
network over the grid ``a * b`` (``a = ceil(sqrt N)``, ``b = ceil(N / a)``) permutes the numbers; the few numbers of the grid
at or above N are walked along their cycle until they fall below N. ``shard = position mod shards`` and
``slot = position div shards``: shard counts differ by one at most, slots have no gaps, and both can be computed from the row
number, N and the seed alone. Only DataFrame expressions are used.

Numbering never sorts everything in one task: each bucket numbers its own rows by a running sum, and buckets are offset by a
prefix sum over bucket totals (one row for each bucket). Rows that repeat all key columns are combined before the shuffle and
dealt out again in chunks afterwards, so neither a repeated row nor an id that many rows share (or lack) can fill a bucket or a task.

Defined results: empty table, no rows; null text has no bytes (its crc32 is that of the empty text); null ids are numbered like
any other key; rows that repeat id and text get positions of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, each_of, sized_join

ROUNDS = 6
#: Rows for which one more bucket is made, and the least number of buckets.
BUCKET_ROWS, LEAST_BUCKETS = 1 << 18, 1024
#: Steps of a walk. A step leaves the grid's surplus (under one part in sqrt N) with a chance of 1 - 1/sqrt(N) or more.
WALK = 64


def _rounds(x: Column, a: int, b: int, seed: int) -> Column:
    """One application of the network to a number of the grid a * b."""

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        width = F.when(even, F.lit(a)).otherwise(F.lit(b)).cast("long")
        mixed = F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], i, F.lit(seed)), width), width)
        return F.struct(s["r"].alias("l"), mixed.alias("r"))

    start = F.struct((x % a).cast("long").alias("l"), ((x - x % a) / a).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["r"] * F.lit(a).cast("long") + s["l"])


def permuted(number: Column, rows: int, seed: int = 7) -> Column:
    """The position of a row number among ``rows`` rows; a bijection of 0..rows-1."""
    a = max(1, math.isqrt(max(rows - 1, 0)) + (1 if rows > 1 else 0))
    b = max(1, -(-rows // a))

    def walk(x: Column, _: Column) -> Column:
        return F.when(x >= rows, _rounds(x, a, b, seed)).otherwise(x)

    first = _rounds(number.cast("long"), a, b, seed)
    last = F.when(first < rows, first).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, walk))
    return F.when(last < rows, last).otherwise(F.raise_error(F.lit("a walk did not end")).cast("long"))


def numbered(df: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """``keys`` of each row of ``df`` with a dense number ``row_number`` from 0, and the number of rows."""
    counted = cut(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("times")), "numbered")
    rows = counted.agg(F.sum("times")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, rows // BUCKET_ROWS)
    counted = counted.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    totals = counted.groupBy("bucket").agg(F.sum("times").alias("total"))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    inside = W.partitionBy("bucket").orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("times").over(inside), F.lit(0)))
    placed = sized_join(placed, offsets, ["bucket"], rows=buckets)
    each = each_of(placed.select(*keys, (F.col("offset") + F.col("before")).alias("first"), "times"), "times", "nth")
    return each.select(*keys, (F.col("first") + F.col("nth")).alias("row_number")), rows


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """One row for each row of ``docs``: id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    narrow = docs.select(F.col(f"`{id_col}`").alias("__id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows, n = numbered(narrow, ["__id", "size", "text_crc32"])
    at = rows.withColumn("position", permuted(F.col("row_number"), n, seed))
    return at.select(F.col("__id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), (F.col("position") % shards).cast("int").alias("shard"), ((F.col("position") - F.col("position") % shards) / shards).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
