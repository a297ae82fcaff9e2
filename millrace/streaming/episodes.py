"""Episodes of keys as a stream: state with a time to live by type, event-time timers, the rows of ``operators.episodes.episodes``."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: What transformWithState keeps its state in.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def use_state_store(spark: SparkSession) -> None:
    """Set the state store that ``episodes`` needs; before its query starts."""
    spark.conf.set(*STORE)


class _Episodes(StatefulProcessor):
    """State of a key: events that the watermark has not passed yet, and the open episode. Events are taken in the order of their time, once
    the watermark has passed them, so batches of any cut give the same episodes; a key without either has no state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us long, tie long, opens boolean, ttl long")
        self.open = handle.getValueState("open", "opened long, refreshed long, opens long, ttl long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        for some in rows:
            fresh = [r for r in zip(some["us"], some["tie"], some["opens"], some["ttl"], strict=True) if r[0] >= passed]
            for us, tie, opens, ttl in fresh:
                self.waiting.appendValue((int(us), int(tie), bool(opens), int(ttl)))
            for ms in {int(r[0]) // 1000 + 1 for r in fresh}:
                self.handle.registerTimer(ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = list(self.waiting.get())
        due, rest = sorted(w for w in waiting if w[0] < passed), [w for w in waiting if w[0] >= passed]
        now = tuple(self.open.get()) if self.open.exists() else None
        out = []
        for us, _, opens, ttl in due:
            if now and now[3] >= 0 and us > now[1] + now[3]:
                out.append((*now[:3], now[1] + now[3], "expired"))
                now = None
            if opens:
                now = (now[0] if now else us, us, (now[2] if now else 0) + 1, ttl)
            elif now:
                out.append((*now[:3], us, "closed"))
                now = None
        if now and now[3] >= 0 and passed > now[1] + now[3]:
            out.append((*now[:3], now[1] + now[3], "expired"))
            now = None
        if due:
            if rest:
                self.waiting.put(rest)
            else:
                self.waiting.clear()
        if now:
            self.open.update(now)
            if now[3] >= 0:
                self.handle.registerTimer((now[1] + now[3]) // 1000 + 1)
        elif self.open.exists():
            self.open.clear()
        if out:
            columns = dict(zip(("opened", "refreshed", "opens", "ended", "status"), map(list, zip(*out, strict=True)), strict=True))
            yield pd.DataFrame({k: [v] * len(out) for k, v in zip(("k0", "k1"), key, strict=True)} | columns)

    def close(self) -> None:
        pass


def episodes(events: DataFrame, keys: list[str], ts: str, tie: str, opens: str, ttl: str, late: str) -> DataFrame:
    """A stream of the episodes that have ended, each once: keys, opened, refreshed, opens, ended, status (closed or expired).

    The two ``keys``, the time, ``tie`` (whole numbers), ``opens`` and ``ttl`` (seconds, null for ever) are columns. Events that come later than ``late`` allows are
    dropped; all others are told as ``operators.episodes.episodes`` tells them of the whole table. State lasts as long as an episode is open.
    """
    one, two = keys
    kinds = {f.name: f.dataType.simpleString() for f in events.schema}
    instant = F.col(ts).cast("timestamp")
    rows = events.select(F.col(one).alias("k0"), F.col(two).alias("k1"), instant.alias("at"), F.unix_micros(instant).alias("us"), F.col(tie).cast("long").alias("tie"), F.coalesce(F.col(opens), F.lit(False)).alias("opens"), F.coalesce(F.col(ttl).cast("long") * 1_000_000, F.lit(-1)).alias("ttl"))
    ended = (
        rows.withWatermark("at", late)
        .groupBy("k0", "k1")
        .transformWithStateInPandas(_Episodes(), f"k0 {kinds[one]}, k1 {kinds[two]}, opened long, refreshed long, opens long, ended long, status string", "Append", "EventTime")
    )
    time = lambda c: F.timestamp_micros(c).cast(kinds[ts]).alias(c)
    return ended.select(F.col("k0").alias(one), F.col("k1").alias(two), time("opened"), time("refreshed"), "opens", time("ended"), "status")
