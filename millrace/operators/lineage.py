"""Cut lineage: tables written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes (as JSON) up to which ``probed`` broadcasts.
SMALL_ROWS, SMALL_BYTES = 50_000, 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a local session gets a folder of its own; on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new table of the shared folder and read again, so that later steps and lost executors start from there."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def probed(rows: DataFrame, probes: DataFrame, on: str) -> DataFrame:
    """Inner join of ``rows`` with ``probes``. Spark's estimates do not see what an explode makes, so it may take exploded rows for small
    and broadcast them; here only probes that were counted and are small are broadcast, and else both sides are shuffled."""
    probes = kept(probes, "probes")
    size = probes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.to_json(F.struct("*")))).alias("bytes")).first()
    small = size["n"] <= SMALL_ROWS and (size["bytes"] or 0) <= SMALL_BYTES
    return rows.join(F.broadcast(probes) if small else probes.hint("merge"), on)
