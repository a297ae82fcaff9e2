"""Openings and closings of a key over time: episodes with a time to live, states of events in a sequence of stages, run alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import buckets, later, running, with_previous


def episodes(events: DataFrame, keys: list[str], ts: str, tie: str, opens: Column, ttl: Column, as_of: Column, bucket_hours: int = 24) -> DataFrame:
    """keys, opened, refreshed (its last opening event), opens (how many), ended and status of each episode.

    An opening event starts an episode, or refreshes the one that is open; each gives it ``ttl`` seconds from then on (null: for ever; a value of the key). A
    closing event ends the episode that is open and means nothing otherwise, late ones included. status is ``closed``,
    ``expired`` (ended is then the moment its time ran out, before ``as_of``, which no event comes after) or ``open`` (ended is null). Equal times go by ``tie``.
    """
    rows = events.select(*keys, F.col(ts).alias("ts"), F.col(tie).alias("tie"), F.coalesce(opens, F.lit(False)).alias("opens"), ttl.cast("long").alias("ttl"))
    rows = with_previous(rows, keys, ["ts", "tie"], buckets("ts", bucket_hours), ["opens"])
    live = F.coalesce(F.col("previous.opens") & (F.col("ttl").isNull() | (F.col("ts") <= later(F.col("previous.ts"), F.col("ttl")))), F.lit(False))
    rows = rows.withColumn("live", live).where("opens or live").drop("previous")
    numbered = running(rows, keys, ["ts", "tie"], buckets("ts", bucket_hours), {"before": ("sum", (F.col("opens") & ~F.col("live")).cast("int"))})
    numbered = numbered.withColumn("episode", F.col("before") + (F.col("opens") & ~F.col("live")).cast("int"))
    each = numbered.groupBy(*keys, "episode").agg(
        F.min("ts").alias("opened"),
        F.max(F.when(F.col("opens"), F.col("ts"))).alias("refreshed"),
        F.count_if("opens").alias("opens"),
        F.max(F.when(~F.col("opens"), F.col("ts"))).alias("closed"),
        F.max("ttl").alias("ttl"),
    )
    out = F.col("ttl").isNotNull() & (later(F.col("refreshed"), F.col("ttl")) < as_of)
    status = F.when(F.col("closed").isNotNull(), "closed").when(out, "expired").otherwise("open")
    ended = F.coalesce("closed", F.when(out, later(F.col("refreshed"), F.col("ttl"))))
    return each.select(*keys, "opened", "refreshed", "opens", ended.alias("ended"), status.alias("status"))


def lifecycles(events: DataFrame, key: str, ts: str, tie: str, stage: Column, closes: Column, ttl: Column, as_of: Column, bucket_hours: int = 24) -> DataFrame:
    """Each event of a sequence with its state: key, ts, tie, stage, status, closed_by, conflict.

    ``stage`` numbers the steps of the sequence; closing events have none. status of an opening event: ``closed`` if a closing event comes after
    it (``closed_by`` is its tie), else ``superseded`` if one of a later stage does, else ``expired`` if it is over ``ttl`` seconds (null: never) before
    ``as_of``, else ``active``; of a closing event: ``closing``. conflict: an event of an earlier stage than one before it (``early``), of
    a later stage than one after it (``late``), both, or a closing event with nothing to close before it (``premature``); such rows are for review, none is put right.
    """
    rows = events.select(F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(tie).alias("tie"), F.when(~F.coalesce(closes, F.lit(False)), stage).alias("stage"), F.coalesce(closes, F.lit(False)).alias("closes"), ttl.cast("long").alias("ttl"))
    rows = rows.where("closes or stage is not null")
    bucket, order = buckets("ts", bucket_hours), ["ts", "tie"]
    first_close = F.when(F.col("closes"), F.struct("ts", "tie"))
    rows = running(rows, ["key"], order, bucket, {"highest": ("max", F.col("stage"))})
    rows = running(rows, ["key"], order, bucket, {"close": ("min", first_close), "further": ("max", F.col("stage")), "lowest": ("min", F.col("stage"))}, ahead=True)
    early, late = F.coalesce(F.col("highest") > F.col("stage"), F.lit(False)), F.coalesce(F.col("lowest") < F.col("stage"), F.lit(False))
    conflict = F.when(F.col("closes") & F.col("highest").isNull(), "premature").when(early & late, "both").when(early, "early").when(late, "late")
    expired = F.col("ttl").isNotNull() & (later(F.col("ts"), F.col("ttl")) < as_of)
    status = F.when(F.col("closes"), "closing").when(F.col("close").isNotNull(), "closed").when(F.col("further") > F.col("stage"), "superseded").when(expired, "expired").otherwise("active")
    return rows.select(F.col("key").alias(key), "ts", "tie", "stage", status.alias("status"), F.when(~F.col("closes"), F.col("close.tie")).alias("closed_by"), conflict.alias("conflict"))


def alerts(runs: DataFrame, key: str, number: str, ts: str, ok: Column, count: Column, confidence: Column, cursor: Column, failures: int = 3, stuck: int = 3, drop: float = 0.5, lost: float = 10.0, stale_seconds: int = 129_600, bucket: int = 1000) -> DataFrame:
    """key, number, alert: what a log of runs (numbered for each source) gives cause to look at.

    ``failing``: the ``failures``-th failure in a row and each after it; ``empty``: no records where the last good run had some; ``fewer``: over ``drop`` of its records
    gone; ``doubtful``: confidence down by over ``lost``; ``stuck``: the ``stuck``-th good run in a row with the same cursor, and each after it; ``back``: the cursor went back;
    ``stale``: over ``stale_seconds`` since the run before. Counts, confidence and cursor are compared with the last good run; null ones are not compared.
    """
    rows = runs.select(F.col(key).alias("key"), F.col(number).alias("number"), F.col(ts).alias("ts"), F.coalesce(ok, F.lit(False)).alias("ok"), count.alias("count"), confidence.alias("confidence"), cursor.alias("cursor"))
    place, b = F.col("number"), F.floor(F.col("number") / bucket)
    rows = running(rows, ["key"], ["number"], b, {"run": ("max", F.struct("number", "ts")), "good": ("max", F.when(F.col("ok"), F.struct("number", "count", "confidence", "cursor"))), "goods": ("sum", F.col("ok").cast("int")), "all": ("sum", F.lit(1))})
    # A good run whose cursor is not that of the good one before starts a stretch; how long it has lasted is the difference of two counts.
    fresh = F.col("ok") & ~F.coalesce(F.col("cursor") == F.col("good.cursor"), F.lit(False))
    rows = rows.withColumn("fresh", fresh)
    rows = running(rows, ["key"], ["number"], b, {"since": ("max", F.when(F.col("fresh"), F.struct("number", "goods"))), "last_ok": ("max", F.when(F.col("ok"), F.struct("number", "all")))})
    in_a_row = F.col("all") - F.coalesce(F.col("last_ok.all"), F.lit(-1))
    same_for = F.col("goods") - F.coalesce(F.col("since.goods"), F.lit(0)) + 1
    known = F.col("ok") & F.col("good").isNotNull()
    marks = {
        "failing": ~F.col("ok") & (in_a_row >= failures),
        "empty": known & (F.col("count") == 0) & (F.col("good.count") > 0),
        "fewer": known & (F.col("count") > 0) & (F.col("count") < (1 - drop) * F.col("good.count")),
        "doubtful": known & (F.col("good.confidence") - F.col("confidence") > lost),
        "stuck": F.col("ok") & ~F.col("fresh") & (same_for >= stuck),
        "back": known & (F.col("cursor") < F.col("good.cursor")),
        "stale": F.col("ts") > later(F.col("run.ts"), F.lit(stale_seconds)),
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in marks.items()]))
    return rows.select(F.col("key").alias(key), place.alias(number), F.explode(found).alias("alert"))
