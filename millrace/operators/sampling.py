"""Samples that anyone can draw again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def stratified(df: DataFrame, strata: list[str], ids: list[str], share: float = 0.01, floor: int = 5, cap: int = 50, seed: int = 0) -> DataFrame:
    """``df``'s rows with the smallest hashes of seed and ids in each stratum, with rows (how many it has) and taken (how many are drawn).

    ``share`` of a stratum's rows are drawn, rounded up, but ``floor`` at least, ``cap`` at most, and never more than there are. The rows are the same however the
    table is partitioned, and a sample of parts is a sample of the whole: each task hands on its ``cap`` smallest of a stratum only. Null strata
    are strata; rows that repeat their ids are told apart by nothing, so which of them is drawn is not said.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]))
    nth = F.row_number().over(W.partitionBy(*strata).orderBy("__key", *ids))
    smallest = df.withColumn("__key", key).withColumn("__nth", nth).where(F.col("__nth") <= cap)
    sizes = df.groupBy(*[F.col(s).alias(f"__{s}") for s in strata]).agg(F.count(F.lit(1)).alias("rows"))
    same = [F.col(s).eqNullSafe(F.col(f"__{s}")) for s in strata]
    taken = F.least(F.greatest(F.ceil(F.lit(share) * F.col("rows")), F.lit(floor)), F.lit(cap), F.col("rows")).cast("long")
    found = smallest.join(sizes, same).withColumn("taken", taken).where(F.col("__nth") <= F.col("taken"))
    return found.select(*df.columns, "rows", "taken")
