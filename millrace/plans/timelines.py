"""Registered queries on keys over time: episodes, lifecycles, sliding windows and run logs, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import episodes, ordered
from .queries import query, table

#: Event types that open a kind of signal, with the seconds that it lives, and those that close one.
OPENS = {"click": ("interest", 43_200), "view": ("look", 21_600), "signup": ("account", 172_800)}
CLOSES = {"purchase": "interest", "error": "look"}


def signals(events: DataFrame) -> DataFrame:
    """user_id, kind, ts, event_id, opens and ttl (seconds, by kind)."""
    kinds = {t: (k, True) for t, (k, _) in OPENS.items()} | {t: (k, False) for t, k in CLOSES.items()}
    lives = dict(OPENS.values())
    table_of = F.create_map(*[x for t, (k, opens) in kinds.items() for x in (F.lit(t), F.struct(F.lit(k).alias("kind"), F.lit(opens).alias("opens"), F.lit(lives[k]).alias("ttl")))])
    return events.select("user_id", "ts", "event_id", table_of[F.col("event_type")].alias("x")).where("x is not null").select("user_id", "ts", "event_id", "x.*")


_SIGNALS = """s AS (SELECT user_id, ts, event_id, CASE event_type WHEN 'click' THEN 'interest' WHEN 'purchase' THEN 'interest' WHEN 'view' THEN 'look' WHEN 'error' THEN 'look' ELSE 'account' END AS kind,
  event_type IN ('click', 'view', 'signup') AS opens FROM events WHERE event_type IN ('click', 'purchase', 'view', 'error', 'signup')),
t AS (SELECT *, to_seconds(CASE kind WHEN 'interest' THEN 43200 WHEN 'look' THEN 21600 ELSE 172800 END) AS ttl FROM s)"""


@query(f"""WITH {_SIGNALS},
p AS (SELECT *, lag(opens) OVER w AND ts <= lag(ts) OVER w + ttl AS live FROM t WINDOW w AS (PARTITION BY user_id, kind ORDER BY ts, event_id)),
n AS (SELECT *, sum(CASE WHEN opens AND NOT coalesce(live, false) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, kind ORDER BY ts, event_id) AS episode FROM p WHERE opens OR live),
g AS (SELECT user_id, kind, min(ts) AS opened, max(ts) FILTER (opens) AS refreshed, count(*) FILTER (opens) AS opens, max(ts) FILTER (NOT opens) AS closed, any_value(ttl) AS ttl FROM n GROUP BY user_id, kind, episode)
SELECT user_id, kind, opened, refreshed, opens, CASE WHEN closed IS NOT NULL THEN closed WHEN refreshed + ttl < TIMESTAMP '2024-01-31' THEN refreshed + ttl END AS ended,
CASE WHEN closed IS NOT NULL THEN 'closed' WHEN refreshed + ttl < TIMESTAMP '2024-01-31' THEN 'expired' ELSE 'open' END AS status FROM g""")
def ttl_episodes(spark, d):
    return episodes.episodes(signals(table(spark, d, "events")), ["user_id", "kind"], "ts", "event_id", F.col("opens"), F.col("ttl"), F.lit("2024-01-31").cast("timestamp_ntz"))


@query("""WITH e AS (SELECT user_id, ts, event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 END AS stage, event_type = 'purchase' AS closes FROM events WHERE event_type <> 'error'),
w AS (SELECT *, max(stage) OVER b AS highest, max(stage) OVER a AS further, min(stage) OVER a AS lowest, min(CASE WHEN closes THEN struct_pack(t := ts, i := event_id) END) OVER a AS nxt FROM e
  WINDOW b AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT user_id, ts, event_id AS tie, stage, CASE WHEN closes THEN 'closing' WHEN nxt IS NOT NULL THEN 'closed' WHEN further > stage THEN 'superseded' WHEN stage < 3 AND ts + CASE stage WHEN 1 THEN INTERVAL 1 DAY ELSE INTERVAL 3 DAY END < TIMESTAMP '2024-01-31' THEN 'expired' ELSE 'active' END AS status,
CASE WHEN NOT closes THEN nxt.i END AS closed_by, CASE WHEN closes AND highest IS NULL THEN 'premature' WHEN highest > stage AND lowest < stage THEN 'both' WHEN highest > stage THEN 'early' WHEN lowest < stage THEN 'late' END AS conflict FROM w""")
def lifecycle_states(spark, d):
    """Views, clicks and signups are three stages, which purchases close."""
    e = table(spark, d, "events").where("event_type <> 'error'")
    kind = F.col("event_type")
    stage = F.when(kind == "view", 1).when(kind == "click", 2).when(kind == "signup", 3)
    ttl = F.when(kind == "view", 86_400).when(kind == "click", 3 * 86_400)
    return episodes.lifecycles(e, "user_id", "ts", "event_id", stage, kind == "purchase", ttl, F.lit("2024-01-31").cast("timestamp_ntz"))


@query("""SELECT DISTINCT event_type, ts, count(DISTINCT user_id) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS n FROM events""")
def window_distinct(spark, d):
    """How many users had an event of the type in the day up to each event: few keys with many rows each."""
    return ordered.distinct_within(table(spark, d, "events"), ["event_type"], "user_id", "ts", 86_400, 6)


@query("""WITH w AS (SELECT o_custkey, count(DISTINCT o_orderkey) OVER a AS orders, count(DISTINCT o_orderpriority) OVER a AS kinds FROM orders WHERE o_orderstatus <> 'P' WINDOW a AS (PARTITION BY o_custkey ORDER BY o_orderdate RANGE BETWEEN INTERVAL 730 DAY PRECEDING AND CURRENT ROW))
SELECT o_custkey, max(orders) AS orders, max(kinds) AS kinds FROM w GROUP BY 1 HAVING max(orders) >= 4 AND max(kinds) >= 3""")
def repeated_within(spark, d):
    """Customers with four orders, and orders of three priorities, within some 730 days."""
    o = table(spark, d, "orders").where("o_orderstatus <> 'P'")
    most = lambda value, name: ordered.distinct_within(o, ["o_custkey"], value, "o_orderdate", 730 * 86_400, 24 * 365).groupBy("o_custkey").agg(F.max("n").alias(name))
    return most("o_orderkey", "orders").where("orders >= 4").join(most("o_orderpriority", "kinds").where("kinds >= 3"), "o_custkey")


@query("""WITH r AS (SELECT event_type AS source, CAST(epoch(date_trunc('hour', ts)) // 3600 AS BIGINT) AS run, max(ts) AS ts, sum(event_id) % 3 <> 0 AS ok, count(*) FILTER (value > 60) AS n, avg(value) AS confidence, max(event_id) // 40 - CASE WHEN sum(event_id) % 7 = 0 THEN 9 ELSE 0 END AS pos FROM events GROUP BY ALL),
g AS (SELECT *, max(CASE WHEN ok THEN struct_pack(run := run, n := n, c := confidence, p := pos) END) OVER b AS good, lag(ts) OVER w AS before, row_number() OVER w AS i, coalesce(sum(ok::INT) OVER b, 0) AS goods FROM r
  WINDOW w AS (PARTITION BY source ORDER BY run), b AS (PARTITION BY source ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, ok AND NOT coalesce(pos = good.p, false) AS fresh FROM g),
l AS (SELECT *, coalesce(max(CASE WHEN ok THEN i END) OVER b, 0) AS last_ok, max(CASE WHEN fresh THEN goods END) OVER b AS since FROM f WINDOW b AS (PARTITION BY source ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT source, run, [CASE WHEN NOT ok AND i - last_ok >= 3 THEN 'failing' END, CASE WHEN ok AND n = 0 AND good.n > 0 THEN 'empty' END, CASE WHEN ok AND n > 0 AND n < 0.5 * good.n THEN 'fewer' END, CASE WHEN ok AND good.c - confidence > 10 THEN 'doubtful' END,
  CASE WHEN ok AND NOT fresh AND goods - since + 1 >= 3 THEN 'stuck' END, CASE WHEN ok AND pos < good.p THEN 'back' END, CASE WHEN ts - before > INTERVAL 3 HOUR THEN 'stale' END] AS a FROM l)
SELECT * FROM (SELECT source, run, unnest(a) AS alert FROM m) WHERE alert IS NOT NULL""")
def source_alerts(spark, d):
    """Each event type is a source that runs every hour in which it has events."""
    e = table(spark, d, "events")
    runs = e.groupBy(F.col("event_type").alias("source"), ordered.hour_number("ts").cast("long").alias("run")).agg(
        F.max("ts").alias("ts"),
        (F.sum("event_id") % 3 != 0).alias("ok"),
        F.count_if(F.col("value") > 60).alias("n"),
        F.avg("value").alias("confidence"),
        (F.floor(F.max("event_id") / 40) - F.when(F.sum("event_id") % 7 == 0, 9).otherwise(0)).alias("pos"),
    )
    return episodes.alerts(runs, "source", "run", "ts", F.col("ok"), F.col("n"), F.col("confidence"), F.col("pos"), stale_seconds=10_800, bucket=24)
