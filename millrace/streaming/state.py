"""Keyed state in hash buckets: a batch rewrites the buckets that it touches and leaves the others alone.

Under a folder that all machines share, ``data/v=<batch>/b=<bucket>`` holds what a batch wrote of a bucket, and ``manifest/v=<batch>`` tells for each bucket which
batch wrote it last: one row for each bucket that there is, so its size is bounded by their number. A manifest is written after the data, so a batch
counts once it is there; a batch that runs again finds its own and does nothing, and one that broke off is written anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.snapshots import upsert


class BucketedState:
    """State of the given schema under ``path``, dealt over ``buckets`` buckets (never to be changed) by a hash of ``key``."""

    def __init__(self, path: str, schema: StructType, key: str, buckets: int = 256):
        self.path, self.schema, self.key, self.buckets = path.rstrip("/"), schema, key, buckets

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def manifest(self, spark: SparkSession, batch: int) -> dict[int, int] | None:
        """Bucket and the batch that wrote it last, as of a batch; None if there is no such manifest."""
        try:
            found = spark.read.schema("bucket int, version long").parquet(f"{self.path}/manifest/v={batch}").collect()  # a row for each bucket
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return {r.bucket: r.version for r in found}

    def _read(self, spark: SparkSession, where: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/data/v={v}/b={b}" for b, v in sorted(where.items())]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def read(self, spark: SparkSession, batch: int) -> DataFrame:
        """The whole state after a batch."""
        where = self.manifest(spark, batch)
        if where is None:
            raise ValueError(f"no batch {batch}")
        return self._read(spark, where)

    def apply(self, rows: DataFrame, batch: int, update: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Put batch number ``batch`` (from 0, without gaps) into the state: ``update(state of the touched buckets, rows)`` is their new state."""
        spark = rows.sparkSession
        if self.manifest(spark, batch) is not None:
            return
        before = self.manifest(spark, batch - 1) if batch else {}
        if before is None:
            raise ValueError(f"batch {batch - 1} is missing")
        touched = {r.b for r in rows.where(F.col(self.key).isNotNull()).select(self._bucket().alias("b")).distinct().collect()}  # buckets at most
        old = self._read(spark, {b: v for b, v in before.items() if b in touched})
        new = update(old, rows.where(F.col(self.key).isNotNull())).select(*self.schema.names)
        new.withColumn("b", self._bucket()).repartition("b").write.mode("overwrite").partitionBy("b").parquet(f"{self.path}/data/v={batch}")
        there = sorted((before | dict.fromkeys(touched, batch)).items())
        spark.createDataFrame(there, "bucket int, version long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v={batch}")


def history(path: str, key: str, key_kind: str, value_kind: str, buckets: int = 256) -> BucketedState:
    """State as ``snapshots.upsert`` keeps it."""
    names = {key: key_kind, "first_seen": "date", "last_seen": "date", "current": value_kind, "previous": value_kind, "delta": value_kind}
    return BucketedState(path, StructType.fromDDL(", ".join(f"{k} {v}" for k, v in names.items())), key, buckets)


def keep_history(batches: DataFrame, state: BucketedState, checkpoint: str, value: str, ordinal: str, run_date: str) -> None:
    """Upsert every micro-batch of a stream (key, value, ordinal) into the state."""

    def apply(batch: DataFrame, number: int) -> None:
        state.apply(batch, number, lambda old, rows: upsert(old, rows, state.key, value, F.lit(run_date).cast("date"), ordinal))

    batches.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
