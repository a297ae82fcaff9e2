"""Snapshots and keyed state: change detection, upserts, merges and keyed picks. All are one shuffle by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def pick(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order, which must leave no ties. Null keys are a key.

    ``min_by`` over a struct combines before the shuffle, so a key with any number of rows sends one row from each task.
    """
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("__row")).select(*keys, "__row.*").select(*df.columns)


def last_wins(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The row with the largest ordinal of each key, whatever its type; null ordinals come before all others."""
    rest = [c for c in df.columns if c not in keys]
    latest = F.struct(F.col(ordinal).isNotNull(), F.col(ordinal))
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), latest).alias("__row")).select(*keys, "__row.*").select(*df.columns)


def first_wins_union(frames: list[DataFrame], keys: list[str], tie: str) -> DataFrame:
    """Rows of several sources; of equal keys, the one of the earliest source stays, and there the smallest ``tie``."""
    ranked = [f.withColumn("__source", F.lit(i)) for i, f in enumerate(frames)]
    return pick(reduce(DataFrame.unionByName, ranked), keys, [F.col("__source"), F.col(tie)]).drop("__source")


def diff(old: DataFrame, new: DataFrame, keys: list[str], compare: list[str], labels: tuple[str, str, str, str] = ("NEW", "SAME", "UPDATED", "GONE")) -> DataFrame:
    """Every key of either snapshot with a change status. Columns of the new snapshot, or of the old one for rows that are gone.

    A null equals a null. Both snapshots must have one row for each key.
    """
    new_label, same, updated, gone = labels
    rest = [c for c in new.columns if c not in keys]
    a = old.select(*keys, F.struct(*rest).alias("__old"))
    b = new.select(*keys, F.struct(*rest).alias("__new"))
    equal = reduce(lambda x, y: x & y, [F.col(f"__old.{c}").eqNullSafe(F.col(f"__new.{c}")) for c in compare], F.lit(True))
    status = F.when(F.col("__old").isNull(), new_label).when(F.col("__new").isNull(), gone).when(equal, same).otherwise(updated)
    both = a.join(b, keys, "full_outer").select(*keys, status.alias("change_status"), F.coalesce("__new", "__old").alias("__row"))
    return both.select(*keys, "__row.*", "change_status")


def changed(diffed: DataFrame, *statuses: str) -> DataFrame:
    return diffed.where(F.col("change_status").isin(*statuses))


def upsert(state: DataFrame, batch: DataFrame, key: str, value: str, run_date: Column, ordinal: str, tie: str | None = None) -> DataFrame:
    """State (key, first_seen, last_seen, current, previous, delta) after a batch (key, value, ordinal).

    Keys seen before keep their first date; ``delta`` is the last value of the batch less the one before it, in the batch or in the
    state. Keys that are not in the batch stay as they are. Of rows with the same ordinal, the one with the greater ``tie`` (or else value) is
    the later one; rows count, not ordinals. No more than the last two rows of a key leave a task.
    """
    order = [F.col(ordinal).desc_nulls_last(), F.col(tie or value).desc_nulls_last()]
    last_two = batch.select(key, F.col(value).alias("__value"), F.row_number().over(W.partitionBy(key).orderBy(*order)).alias("__nth")).where("__nth <= 2")
    nth = lambda n: F.max(F.when(F.col("__nth") == n, F.col("__value")))
    fresh = last_two.groupBy(key).agg(nth(1).alias("last"), nth(2).alias("inner"), F.count(F.lit(1)).alias("times"))
    old = state.select(key, F.col("first_seen").alias("__first"), F.col("last_seen").alias("__last"), F.col("current").alias("__current"), F.col("previous").alias("__previous"), F.col("delta").alias("__delta"))
    both = old.join(fresh, key, "full_outer")
    hit = F.col("times").isNotNull()
    before_last = F.when(F.col("times") > 1, F.col("inner")).otherwise(F.col("__current"))
    return both.select(
        key,
        F.coalesce("__first", run_date).alias("first_seen"),
        F.when(hit, run_date).otherwise(F.col("__last")).alias("last_seen"),
        F.when(hit, F.col("last")).otherwise(F.col("__current")).alias("current"),
        F.when(hit, before_last).otherwise(F.col("__previous")).alias("previous"),
        F.when(hit, F.col("last") - before_last).otherwise(F.col("__delta")).alias("delta"),
    )


def merge(master: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the delta replace whole rows of the master by key; the others stay."""
    return master.join(delta.select(*keys).distinct(), keys, "left_anti").unionByName(delta)


def best_per_key(df: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """The row with the highest score of each key; of equal scores, the smallest ``tie``. Null scores come last."""
    return pick(df, [key], [F.col(score).isNull(), -F.col(score), F.col(tie)])


def ranked(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``df`` with each row's place within its key."""
    return df.withColumn("place", F.row_number().over(W.partitionBy(key).orderBy(*order)))


def dated_diff(old: DataFrame, new: DataFrame, keys: list[str], compare: list[str], run_date: Column, labels: tuple[str, str, str, str] = ("NEW_RECORD", "SAME", "UPDATED", "DISAPPEARED")) -> DataFrame:
    """``diff`` of a snapshot that knows first_seen and last_seen with a new one that does not: rows that are there keep their first_seen and are last seen
    on the run's date; rows that are gone keep both."""
    there = new.withColumns({"first_seen": run_date, "last_seen": run_date})
    rest = [c for c in there.columns if c not in keys]
    a = old.select(*keys, F.struct(*rest).alias("__old"))
    b = there.select(*keys, F.struct(*rest).alias("__new"))
    equal = reduce(lambda x, y: x & y, [F.col(f"__old.{c}").eqNullSafe(F.col(f"__new.{c}")) for c in compare], F.lit(True))
    status = F.when(F.col("__old").isNull(), labels[0]).when(F.col("__new").isNull(), labels[3]).when(equal, labels[1]).otherwise(labels[2])
    both = a.join(b, keys, "full_outer").select(*keys, status.alias("change_status"), F.coalesce("__new", "__old").alias("__row"), F.col("__old.first_seen").alias("__first"))
    return both.select(*keys, "__row.*", "change_status", "__first").withColumn("first_seen", F.coalesce("__first", "first_seen")).drop("__first")


def rebuilt(batch: DataFrame, key: str, value: str, run_date: Column) -> DataFrame:
    """State made anew from one batch, which must have each key once (``quality.unique`` tells)."""
    kind = batch.schema[value].dataType
    return batch.select(key, run_date.alias("first_seen"), run_date.alias("last_seen"), F.col(value).alias("current"), F.lit(None).cast(kind).alias("previous"), F.lit(None).cast(kind).alias("delta"))


def since(state: DataFrame, day: Column) -> DataFrame:
    return state.where(F.col("first_seen") >= day)


def run_change(previous: DataFrame, current: DataFrame, key: str, value: str) -> DataFrame:
    """key, previous, current and change ((current - previous) / previous; null without a previous value or if that is 0)."""
    both = previous.select(key, F.col(value).alias("previous")).join(current.select(key, F.col(value).alias("current")), key, "full_outer")
    return both.withColumn("change", (F.col("current") - F.col("previous")) / F.nullif(F.col("previous"), F.lit(0)))


def lifecycle(events: DataFrame, key: str, ts: str, opens: Column, closes: Column, as_of: Column, days: int) -> DataFrame:
    """key, opened, closed (latest of either kind) and state: ``closed`` if something closed it after it opened, ``conflict`` if both came at once,
    ``expired`` if it opened over ``days`` days ago, else ``open``. Keys that never opened have no row."""
    last = events.groupBy(key).agg(F.max(F.when(opens, F.col(ts))).alias("opened"), F.max(F.when(closes, F.col(ts))).alias("closed")).where("opened is not null")
    state = F.when(F.col("closed") > F.col("opened"), "closed").when(F.col("closed") == F.col("opened"), "conflict").when(F.date_diff(as_of, F.to_date("opened")) > days, "expired").otherwise("open")
    return last.withColumn("state", state)
