"""Streams whose finished result equals the batch operator over the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .state import BucketedState, history, keep_history


def source(spark: SparkSession, path: str, schema: StructType, files: int | None = None) -> DataFrame:
    """New parquet files of a folder as a stream; its checkpoint is the cursor."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def deduplicated(events: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """The first event of each key; state is kept for ``late`` beyond the event's time."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(events: DataFrame, keys: list[str], ts: str, width: str, late: str, slide: str | None = None) -> DataFrame:
    """Events by tumbling (or sliding) window and key."""
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    return events.withWatermark(ts, late).groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *keys, "n")


def sessions(events: DataFrame, keys: list[str], ts: str, gap: str, late: str) -> DataFrame:
    """Runs of a key's events with less than ``gap`` between neighbours."""
    return events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "n")


def run_to_end(stream: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """What the stream gives for all rows that are there now, through an in-memory table; for results of bounded size."""
    stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.table(name)


def keep_state(batches: DataFrame, state_path: str, checkpoint: str, key: str, value: str, ordinal: str, run_date: str, buckets: int = 256) -> BucketedState:
    """Upsert every micro-batch into a keyed state under ``state_path``, of which it rewrites the buckets that it touches; see ``state.BucketedState``."""
    kinds = {f.name: f.dataType.simpleString() for f in batches.schema}
    kept = history(state_path, key, kinds[key], kinds[value], buckets)
    keep_history(batches, kept, checkpoint, value, ordinal, run_date)
    return kept
