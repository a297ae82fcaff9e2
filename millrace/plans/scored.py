"""The end-to-end plan: events to normalised types, groups, enriched and scored rows, with neutral weights of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates, matching, rules

#: Neutral example configuration: points of a type, bands of the total.
TYPES = {"click": "INTERACTION", "view": "INTERACTION", "purchase": "TRANSACTION", "error": "FAULT", "signup": "ACCOUNT"}
POINTS = {"INTERACTION": 10.0, "TRANSACTION": 40.0, "FAULT": 5.0, "ACCOUNT": 25.0, "OTHER": 1.0}
BANDS = [(70.0, "high"), (40.0, "middle")]


def typed(events: DataFrame) -> DataFrame:
    """``events`` with kind, from the type table or else OTHER."""
    hit = rules.lookup(F.lower(S.strip(F.col("event_type"))), (TYPES, 100, "table"))
    return events.withColumn("kind", F.coalesce(hit["value"], F.lit("OTHER")))


def groups(events: DataFrame) -> DataFrame:
    """One row for each user and kind: events, first and last time, total value."""
    return typed(events).groupBy("user_id", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("earliest"), F.max("ts").alias("latest"), F.sum("value").alias("total"))


def scored(events: DataFrame, customers: DataFrame) -> DataFrame:
    """One row for each user: kinds, depth, score, band, and what the customer table knows of them.

    Both aggregations are by user, so the second needs no shuffle beyond a repartition by the first key that Spark plans.
    """
    worth = F.create_map(*[x for k, v in POINTS.items() for x in (F.lit(k), F.lit(v))])
    users = groups(events).groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_set("kind")), "|").alias("kinds"),
        F.count(F.lit(1)).alias("depth"),
        F.sum("n").alias("events"),
        F.max(worth[F.col("kind")]).alias("best"),
    )
    rows = matching.enrich(users, customers.select("c_custkey", "c_mktsegment", "c_acctbal"), "user_id", "c_custkey").drop("c_custkey")
    bonus = rules.points({"several": (F.col("depth") >= 3, 12), "two": (F.col("depth") == 2, 6), "solvent": (F.col("c_acctbal") > 5000, 8), "busy": (F.col("events") >= 100, 10)}, most=25)
    score = S.clamp(F.col("best") + bonus, 0.0, 100.0)
    return rows.withColumn("score", score).withColumn("band", rules.band(F.col("score"), BANDS, "low"))


def header(rows: DataFrame) -> DataFrame:
    return aggregates.header(rows, ["band", "depth", "enriched"])
