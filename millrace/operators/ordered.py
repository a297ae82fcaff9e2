"""What comes before (or after) a row among its key's rows, without bringing all rows of a key together.

A plain window sorts a key's rows in one task. Here they are cut by a bucket that grows with the order (a day of the time, say): each
bucket is aggregated on its own, a window over one row for each key and bucket carries what earlier buckets came to, and both are
combined. So the largest group is the rows of a key in one bucket, and maxima, minima and sums are all it takes: the row before is the
maximum of (order, row).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: How two partial results become one.
_JOINED = {"max": F.greatest, "min": F.least, "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))}


def hour_number(ts: str) -> Column:
    """Hours of a time by its own clock, with a zone or without; it never falls as time goes on, also when clocks go back."""
    return F.unix_date(F.to_date(ts)) * 24 + F.hour(ts)


def buckets(ts: str, hours: int) -> Column:
    return F.floor(hour_number(ts) / hours)


def later(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def running(df: DataFrame, keys: list[str], order: list[str], bucket: Column, asked: dict[str, tuple[str, Column]], ahead: bool = False) -> DataFrame:
    """``df`` with a column for each name of ``asked``: (max, min or sum, column) over the key's rows that come before a row; after it, if ``ahead``.

    The row itself does not count. ``order`` must leave no ties and ``bucket`` must not fall as it rises. A sum over no row is 0, and
    the other two are null. Rows with a null key are no key's rows and are left out.
    """
    columns, names = df.columns, list(asked)
    rows = df.where(" and ".join(f"`{k}` is not null" for k in keys)).withColumns({"__b": bucket} | {f"__x{i}": c for i, (_, c) in enumerate(asked.values())})
    way: Callable[[str], Column] = (lambda c: F.col(c).desc()) if ahead else (lambda c: F.col(c).asc())
    inside = W.partitionBy(*keys, "__b").orderBy(*[way(c) for c in order]).rowsBetween(W.unboundedPreceding, -1)
    across = W.partitionBy(*keys).orderBy(way("__b")).rowsBetween(W.unboundedPreceding, -1)
    calls = [getattr(F, f) for f, _ in asked.values()]
    carried = rows.groupBy(*keys, "__b").agg(*[f(f"__x{i}").alias(f"__p{i}") for i, f in enumerate(calls)])
    carried = carried.select(*keys, "__b", *[f(f"__p{i}").over(across).alias(f"__c{i}") for i, f in enumerate(calls)])
    rows = rows.select(*columns, "__b", *[f(f"__x{i}").over(inside).alias(f"__i{i}") for i, f in enumerate(calls)])
    joined = rows.join(carried, [*keys, "__b"])
    return joined.select(*columns, *[_JOINED[f](F.col(f"__i{i}"), F.col(f"__c{i}")).alias(n) for i, (n, (f, _)) in enumerate(zip(names, asked.values(), strict=True))])


def with_previous(df: DataFrame, keys: list[str], order: list[str], bucket: Column, columns: list[str], name: str = "previous") -> DataFrame:
    """``df`` with ``name``: a struct of the order and ``columns`` of the key's row before, null for its first."""
    return running(df, keys, order, bucket, {name: ("max", F.struct(*order, *[c for c in columns if c not in order]))})


def distinct_within(df: DataFrame, keys: list[str], value: str, ts: str, seconds: int, bucket_hours: int) -> DataFrame:
    """keys, ts and n: how many different values the key's rows have in the ``seconds`` up to and with each of their times.

    A value counts from each of its rows until its next row takes over or the time has passed; so the number of values is a running sum of
    such beginnings and ends, which no frame has to gather.
    """
    once = df.select(*keys, F.col(value).alias("__v"), F.col(ts).alias("ts")).where("__v is not null and ts is not null").distinct()
    after = running(once, [*keys, "__v"], ["ts"], buckets("ts", bucket_hours), {"__next": ("min", F.col("ts"))}, ahead=True)
    past = later(F.col("ts"), F.lit(f"{seconds}.000001"))
    spans = after.withColumn("__end", F.least(F.coalesce("__next", past), past))
    changes = spans.select(*keys, "ts", F.lit(1).alias("__d")).union(spans.select(*keys, F.col("__end").alias("ts"), F.lit(-1).alias("__d")))
    changes = changes.groupBy(*keys, "ts").agg(F.sum("__d").alias("__d"), F.max("__d").alias("__starts"))
    summed = running(changes, keys, ["ts"], buckets("ts", bucket_hours), {"n": ("sum", F.col("__d"))})
    return summed.where("__starts = 1").select(*keys, "ts", (F.col("n") + F.col("__d")).alias("n"))
