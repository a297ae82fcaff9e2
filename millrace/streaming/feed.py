"""A stream of snapshots as a feed of what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.snapshots import changed, diff


def change_feed(snapshots: DataFrame, path: str, checkpoint: str, keys: list[str], compare: list[str], statuses: tuple[str, ...] = ("NEW", "UPDATED", "GONE")) -> None:
    """Each micro-batch is a whole snapshot (one file or folder at a time); ``path/changes/batch=<n>`` gets what it changed against the one before.

    ``path/snapshots/v<n>`` keeps the snapshot for the next batch. Both are overwritten when a batch runs again, from the same predecessor, so it writes the same.
    """
    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = spark.read.schema(batch.schema).parquet(f"{path}/snapshots/v{number - 1}") if number else spark.createDataFrame([], batch.schema)
        batch.write.mode("overwrite").parquet(f"{path}/snapshots/v{number}")
        new = spark.read.schema(batch.schema).parquet(f"{path}/snapshots/v{number}")
        changed(diff(old, new, keys, compare), *statuses).write.mode("overwrite").parquet(f"{path}/changes/batch={number}")

    snapshots.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
