"""The registered queries of the library and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates, matching, quality, rules, snapshots, views
from ..sources import files
from . import scored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
WITH g AS (SELECT user_id, CASE event_type WHEN 'click' THEN 'INTERACTION' WHEN 'view' THEN 'INTERACTION' WHEN 'purchase' THEN 'TRANSACTION'
  WHEN 'error' THEN 'FAULT' WHEN 'signup' THEN 'ACCOUNT' ELSE 'OTHER' END AS kind, count(*) AS n FROM events GROUP BY ALL),
w AS (SELECT user_id, string_agg(kind, '|' ORDER BY kind) AS kinds, count(*) AS depth, sum(n)::BIGINT AS events,
  max(CASE kind WHEN 'INTERACTION' THEN 10.0 WHEN 'TRANSACTION' THEN 40.0 WHEN 'FAULT' THEN 5.0 WHEN 'ACCOUNT' THEN 25.0 ELSE 1.0 END)::DOUBLE AS best FROM g GROUP BY user_id),
s AS (SELECT w.*, c_mktsegment, c_acctbal, c_custkey IS NOT NULL AS enriched,
  greatest(0.0, least(100.0, best + least(25.0, CASE WHEN depth >= 3 THEN 12 ELSE 0 END + CASE WHEN depth = 2 THEN 6 ELSE 0 END + CASE WHEN c_acctbal > 5000 THEN 8 ELSE 0 END + CASE WHEN events >= 100 THEN 10 ELSE 0 END)))::DOUBLE AS score
  FROM w LEFT JOIN customer ON user_id = c_custkey)
SELECT user_id, kinds, depth, events, best, c_mktsegment, c_acctbal, enriched, score, CASE WHEN score >= 70 THEN 'high' WHEN score >= 40 THEN 'middle' ELSE 'low' END AS band FROM s""")
def scored_users(spark, d):
    return scored.scored(table(spark, d, "events"), table(spark, d, "customer"))


@query("SELECT c_custkey, c_name, round(c_acctbal, 2) AS c_acctbal FROM customer WHERE c_acctbal >= 5000 AND c_mktsegment IN ('BUILDING', 'MACHINERY')")
def scan_project_filter(spark, d):
    return table(spark, d, "customer").where((F.col("c_acctbal") >= 5000) & F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'INTERACTION' WHEN 'view' THEN 'INTERACTION' WHEN 'purchase' THEN 'TRANSACTION' WHEN 'error' THEN 'FAULT' WHEN 'signup' THEN 'ACCOUNT' ELSE 'OTHER' END AS kind FROM events""")
def type_normalize(spark, d):
    return scored.typed(table(spark, d, "events")).select("event_id", "kind")


@query("""SELECT value, confidence, layer, count(*) AS n FROM (SELECT CASE p_type WHEN 'ECONOMY' THEN 'low' WHEN 'PROMO' THEN 'offer' WHEN 'SMALL' THEN 'size' WHEN 'LARGE' THEN 'size' END AS value,
CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 100 WHEN p_type IN ('SMALL', 'LARGE') THEN 90 END AS confidence, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'exact' WHEN p_type IN ('SMALL', 'LARGE') THEN 'synonym' END AS layer FROM part) GROUP BY ALL""")
def layered_lookup(spark, d):
    hit = rules.lookup(F.col("p_type"), ({"ECONOMY": "low", "PROMO": "offer"}, 100, "exact"), ({"SMALL": "size", "LARGE": "size", "PROMO": "never"}, 90, "synonym"))
    return table(spark, d, "part").select(hit.alias("h")).select("h.*").groupBy("value", "confidence", "layer").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) >= 50")
def json_props(spark, d):
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return table(spark, d, "events").select("event_id", k.alias("k")).where("k >= 50")


@query("""WITH e AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id END AS key, CASE WHEN event_id % 5 = 0 THEN ' ' ELSE props END AS instrument FROM events),
k AS (SELECT *, key IS NULL AS key_missing, coalesce(CAST(key AS VARCHAR), props) AS g FROM e)
SELECT key_missing, g AS group_key, event_type, count(DISTINCT CASE WHEN trim(instrument) <> '' THEN instrument END) + count(*) FILTER (trim(instrument) = '') AS n, min(ts) AS earliest, max(ts) AS latest,
string_agg(DISTINCT CAST(value > 50 AS VARCHAR), '|' ORDER BY CAST(value > 50 AS VARCHAR)) AS highs FROM k GROUP BY ALL""")
def agg_key_group(spark, d):
    e = table(spark, d, "events")
    e = e.withColumns({"key": F.when(F.col("event_id") % 11 != 0, F.col("user_id")), "instrument": F.when(F.col("event_id") % 5 == 0, " ").otherwise(F.col("props")), "highs": (F.col("value") > 50).cast("string")})
    keyed = aggregates.with_group_key(e, "key", ["props"])
    return aggregates.merge_groups(keyed, ["key_missing", "group_key", "event_type"], "instrument", ["highs"], "ts").withColumn("highs", F.array_join("highs", "|"))


@query("""WITH g AS (SELECT l_orderkey, l_returnflag, count(*) AS n, sum(l_quantity)::BIGINT AS q FROM lineitem GROUP BY ALL)
SELECT o_custkey, l_orderkey AS o_orderkey, string_agg(l_returnflag || ':' || n || ':' || q, ',' ORDER BY l_returnflag) AS groups FROM g JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL""")
def two_level_nest(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("q"))
    nested = aggregates.nest(g, "l_orderkey", ["l_returnflag"])
    rows = nested.join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), nested["l_orderkey"] == F.col("o_orderkey"))
    return rows.select("o_custkey", "o_orderkey", F.array_join(F.transform("groups", lambda s: F.concat_ws(":", s["l_returnflag"], s["n"].cast("string"), s["q"].cast("string"))), ",").alias("groups"))


@query("SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey")
def representative_row(spark, d):
    return aggregates.representative(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], "o_orderkey")


@query("""SELECT o_custkey, CASE min(CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 1 ELSE -1 END) WHEN 4 THEN '1-URGENT' WHEN 3 THEN '2-HIGH' WHEN 2 THEN '3-MEDIUM' WHEN 1 THEN '4-NOT SPECIFIED' ELSE 'unknown' END AS o_orderpriority FROM orders GROUP BY o_custkey""")
def weakest_label(spark, d):
    return aggregates.weakest(table(spark, d, "orders"), "o_custkey", "o_orderpriority", {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1}, "unknown")


@query("SELECT l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY 1")
def histogram_scalar(spark, d):
    return aggregates.histogram(table(spark, d, "lineitem"), "l_returnflag")


@query("SELECT w AS value, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY 1")
def histogram_array(spark, d):
    return aggregates.histogram(table(spark, d, "part").select(F.split("p_name", " ").alias("words")), "words")


@query("""SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2""")
def header_counts(spark, d):
    return aggregates.header(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


def _two_snapshots(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"))
    old = o.where("o_orderkey % 10 <> 0")
    new = o.where("o_orderkey % 7 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 4 == 0, F.round(F.col("o_totalprice") + 1, 2)).otherwise(F.col("o_totalprice")))
    return old, new


_SNAPSHOTS = """WITH o AS (SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice FROM orders), a AS (SELECT * FROM o WHERE o_orderkey % 10 <> 0),
b AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 4 = 0 THEN round(o_totalprice + 1, 2) ELSE o_totalprice END AS o_totalprice FROM o WHERE o_orderkey % 7 <> 0),
d AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(b.o_orderstatus, a.o_orderstatus) AS o_orderstatus, coalesce(b.o_totalprice, a.o_totalprice) AS o_totalprice,
CASE WHEN a.o_orderkey IS NULL THEN 'NEW' WHEN b.o_orderkey IS NULL THEN 'GONE' WHEN a.o_totalprice = b.o_totalprice AND a.o_orderstatus = b.o_orderstatus THEN 'SAME' ELSE 'UPDATED' END AS change_status
FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey) """


@query(_SNAPSHOTS + "SELECT * FROM d")
def snapshot_diff(spark, d):
    return snapshots.diff(*_two_snapshots(spark, d), ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query(_SNAPSHOTS + "SELECT * FROM d WHERE change_status IN ('NEW', 'UPDATED')")
def change_feed(spark, d):
    return snapshots.changed(snapshot_diff(spark, d), "NEW", "UPDATED")


@query(_SNAPSHOTS + "SELECT * FROM b UNION ALL SELECT * FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)")
def merge_delta(spark, d):
    old, new = _two_snapshots(spark, d)
    return snapshots.merge(old, new, ["o_orderkey"])


@query("""WITH a AS (SELECT o_custkey, max(o_orderkey) FILTER (o_orderkey % 2 = 0) AS k FROM orders GROUP BY 1), st AS (SELECT o_custkey, k AS cur FROM a WHERE k IS NOT NULL),
b AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS inner_ FROM orders WHERE o_orderkey % 2 = 1),
l AS (SELECT * FROM b WHERE rn = 1)
SELECT coalesce(st.o_custkey, l.o_custkey) AS o_custkey, CASE WHEN st.o_custkey IS NULL THEN DATE '2024-02-01' ELSE DATE '2024-01-01' END AS first_seen, CASE WHEN l.o_custkey IS NULL THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS last_seen,
coalesce(l.o_orderkey, st.cur) AS current, CASE WHEN l.o_custkey IS NOT NULL THEN coalesce(l.inner_, st.cur) END AS previous, CASE WHEN l.o_custkey IS NOT NULL THEN l.o_orderkey - coalesce(l.inner_, st.cur) END AS delta FROM st FULL OUTER JOIN l ON st.o_custkey = l.o_custkey""")
def history_upsert(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderkey").alias("value"))
    day = F.lit("2024-01-01").cast("date")
    state = o.where("o_orderkey % 2 = 0").groupBy("o_custkey").agg(F.max("value").alias("current")).select("o_custkey", day.alias("first_seen"), day.alias("last_seen"), "current", F.lit(None).cast("bigint").alias("previous"), F.lit(None).cast("bigint").alias("delta"))
    return snapshots.upsert(state, o.where("o_orderkey % 2 = 1"), "o_custkey", "value", F.lit("2024-02-01").cast("date"), "o_orderkey")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def best_per_key(spark, d):
    return snapshots.best_per_key(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_totalprice", "o_orderkey")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def last_wins(spark, d):
    return snapshots.last_wins(table(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("""SELECT k, name, nation FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY src, name) AS rn FROM (SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation, 0 AS src FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, 1 FROM supplier)) WHERE rn = 1""")
def first_wins_union(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return snapshots.first_wins_union([c, s], ["k"], "name")


@query("SELECT 'c' AS side, c_custkey AS k, c_nationkey AS nation FROM customer UNION ALL SELECT 's', s_suppkey, s_nationkey FROM supplier")
def bag_union(spark, d):
    c = table(spark, d, "customer").select(F.lit("c").alias("side"), F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation"))
    return files.union_all([c, table(spark, d, "supplier").select(F.lit("s").alias("side"), F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("nation"))])


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def semi_join(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 400000")
    return table(spark, d, "customer").join(big, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def anti_join(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 400000")
    return table(spark, d, "customer").join(big, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("""SELECT o_orderkey, c_name, n_name, c_custkey IS NOT NULL AS enriched FROM (SELECT *, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END AS ck FROM orders) LEFT JOIN customer ON ck = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def left_enrich(spark, d):
    o = table(spark, d, "orders").withColumn("ck", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey")))
    rows = matching.enrich(o, table(spark, d, "customer"), "ck", "c_custkey")
    return rows.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("o_orderkey", "c_name", "n_name", "enriched")


@query("""WITH l AS (SELECT p_partkey, p_name, p_brand, p_size FROM part), r AS (SELECT p_partkey AS k, p_name, p_brand, p_size FROM part),
h AS (SELECT p_partkey, 0 AS pl, 'name_brand' AS tier, 95 AS confidence, 60 AS shared, k FROM l JOIN r USING (p_name, p_brand) WHERE p_partkey <> k UNION ALL SELECT p_partkey, 1, 'brand_size', 85, 60, k FROM l JOIN r USING (p_brand, p_size) WHERE p_partkey <> k
UNION ALL SELECT p_partkey, 2, 'name_size', 40, 40, k FROM l JOIN r USING (p_name, p_size) WHERE p_partkey <> k),
g AS (SELECT p_partkey, pl, tier, confidence, shared, count(DISTINCT k) AS candidates, min(k) AS match_id FROM h GROUP BY ALL), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY pl) AS rn FROM g) WHERE rn = 1)
SELECT l.p_partkey, tier, CASE WHEN candidates > 1 THEN shared ELSE coalesce(confidence, 0) END AS confidence, coalesce(candidates, 0) AS candidates, match_id, coalesce(candidates > 1, false) AS ambiguous FROM l LEFT JOIN b ON l.p_partkey = b.p_partkey""")
def tiered_match(spark, d):
    """Every part against every other one. Sharing a name and brand, or a brand and size, with several is doubtful; the last tier is that anyway."""
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    tiers = [("name_brand", 95, ["p_name", "p_brand"]), ("brand_size", 85, ["p_brand", "p_size"]), ("name_size", 40, ["p_name", "p_size"])]
    return matching.tiered_match(p, p.withColumnRenamed("p_partkey", "k"), "p_partkey", "k", tiers, ambiguous={"name_brand": 60, "brand_size": 60}, itself=True)


_ASKED = "a(ask, a, b) AS (VALUES (1, 're', 'wid'), (2, 'o', 'bo'), (3, 'ld', 'late'), (4, 'xx', 'y'), (5, 'ring', 'red'), (6, 'o', 'x'), (7, '', 'q'))"


def _asked(spark):
    return spark.createDataFrame([(1, "re", "wid"), (2, "o", "bo"), (3, "ld", "late"), (4, "xx", "y"), (5, "ring", "red"), (6, "o", "x"), (7, "", "q")], "ask int, a string, b string")


@query(f"WITH {_ASKED} SELECT ask, p_partkey FROM part JOIN a ON p_name LIKE '%' || a || '%' || b || '%'")
def ordered_like_match(spark, d):
    return matching.ordered_contains(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", _asked(spark), "ask", ["a", "b"]).select("ask", "p_partkey")


_RESOLVED = """c AS (SELECT c_custkey AS k, 0 AS o, c_nationkey AS nation, floor(c_acctbal / 400)::BIGINT AS fine, floor(c_acctbal / 2500)::BIGINT AS rough FROM customer
  UNION ALL SELECT c_custkey, 1, (c_nationkey + 1) % 25, floor(c_acctbal / 400)::BIGINT, floor(c_acctbal / 2500)::BIGINT FROM customer WHERE c_mktsegment <> 'BUILDING'),
t AS (SELECT s_suppkey AS t, s_nationkey AS nation, floor(s_acctbal / 400)::BIGINT AS fine, floor(s_acctbal / 2500)::BIGINT AS rough FROM supplier),
s AS (SELECT k, o, 1 AS place, t FROM c JOIN t USING (nation, fine) UNION ALL SELECT k, o, 2, t FROM c JOIN t USING (nation, rough) UNION ALL SELECT k, o, 3, t FROM c JOIN t USING (nation)),
g AS (SELECT k, o, place, count(DISTINCT t) AS matches, min(t) AS t FROM s GROUP BY ALL HAVING count(DISTINCT t) <= 5), b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY matches > 1, o, place) AS rn FROM g)"""


@query(f"""WITH {_RESOLVED} SELECT k, CASE WHEN matches = 1 THEN 'definitive' ELSE 'ambiguous' END AS status, o AS "order", place, matches, CASE WHEN matches = 1 THEN t END AS match FROM b WHERE rn = 1""")
def strategy_resolve(spark, d):
    """A supplier for every customer: of the nation and a like balance, else a roughly like one, else of the nation; then the same with the next nation, but for one segment."""
    steps = lambda c: [F.floor(F.col(c) / 400).alias("fine"), F.floor(F.col(c) / 2500).alias("rough")]
    c = table(spark, d, "customer")
    one = c.select(F.col("c_custkey").alias("k"), F.lit(0).alias("o"), F.col("c_nationkey").alias("nation"), *steps("c_acctbal"))
    two = c.where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("k"), F.lit(1).alias("o"), ((F.col("c_nationkey") + 1) % 25).alias("nation"), *steps("c_acctbal"))
    t = table(spark, d, "supplier").select(F.col("s_suppkey").alias("t"), F.col("s_nationkey").alias("nation"), *steps("s_acctbal"))
    return matching.resolve_by(one.union(two), t, "k", "t", [["nation", "fine"], ["nation", "rough"], ["nation"]], order="o")


@query("""WITH p AS (SELECT p_name || '|' || p_size AS n, p_partkey FROM part), u AS (SELECT n, min(p_partkey) AS p_partkey FROM p GROUP BY n HAVING count(*) = 1) SELECT n, u.p_partkey FROM (SELECT DISTINCT n FROM p) LEFT JOIN u USING (n)""")
def unique_lookup(spark, d):
    p = table(spark, d, "part").select(F.concat_ws("|", "p_name", "p_size").alias("n"), "p_partkey")
    return matching.unique_lookup(p.select("n").distinct(), p, "n", "p_partkey")


@query("""WITH w AS (SELECT p_partkey AS k, p_brand, p_size, string_split(p_name, ' ') AS wanted FROM part), c AS (SELECT p_partkey, p_brand, p_size, list_distinct(string_split(p_name || ' ' || lower(p_type), ' ')) AS offered FROM part),
s AS (SELECT k, p_partkey, len(list_intersect(wanted, offered)) AS overlap, len(offered) - len(list_intersect(wanted, offered)) AS extra, len(list_intersect(wanted, offered)) = len(list_distinct(wanted)) AS covered FROM w JOIN c USING (p_brand, p_size) WHERE k <> p_partkey),
r AS (SELECT *, rank() OVER (PARTITION BY k ORDER BY overlap DESC, extra) AS rk FROM s), t AS (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM r WHERE rk = 1)
SELECT k, p_partkey, overlap::INTEGER AS overlap, extra::INTEGER AS extra, covered FROM t WHERE n = 1 AND covered""")
def name_overlap(spark, d):
    """Every part against all others of its brand and size."""
    p = table(spark, d, "part")
    w = p.select(F.col("p_partkey").alias("k"), "p_brand", "p_size", F.split("p_name", " ").alias("words"))
    c = p.select("p_partkey", "p_brand", "p_size", F.split(F.concat_ws(" ", "p_name", F.lower("p_type")), " ").alias("words"))
    return matching.best_cover(w, c, "k", "p_partkey", "words", ["p_brand", "p_size"], itself=True)


@query("SELECT DISTINCT l_partkey AS missing FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <> 5)")
def ref_integrity(spark, d):
    return matching.missing_references(table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part").where("p_size <> 5"), "p_partkey")


@query("""SELECT label, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(text, '(?i)token\\s*=|password') THEN 'secret' WHEN regexp_matches(text, '[A-Z]{3,}!!') THEN 'shouting' WHEN regexp_matches(text, ' \\| ') THEN 'table' ELSE 'prose' END AS label FROM documents) GROUP BY 1""")
def classifier_case(spark, d):
    label = rules.first_match(F.col("text"), [(r"(?i)token\s*=|password", "secret"), ("[A-Z]{3,}!!", "shouting"), (r" \| ", "table")], "prose")
    return table(spark, d, "documents").select(label.alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT page_id, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title, nullif(regexp_extract(html, '(?i)<html[^>]*lang="([a-z]+)"', 1), '') AS lang, len(regexp_extract_all(html, '(?i)<a\\s[^>]*href="([^"]*)"', 1))::BIGINT AS links FROM pages""")
def html_extract(spark, d):
    return table(spark, d, "pages").select("page_id", F.nullif(F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1), F.lit("")).alias("title"), F.nullif(F.regexp_extract("html", '(?i)<html[^>]*lang="([a-z]+)"', 1), F.lit("")).alias("lang"), F.size(F.regexp_extract_all("html", F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'), F.lit(1))).cast("bigint").alias("links"))


@query(r"""WITH l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i, len(ls) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
s AS (SELECT *, sum(CASE WHEN i > 1 AND i < n AND regexp_full_match(line, '[A-Z][^.]{0,60}\.') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS place FROM l),
b AS (SELECT doc_id, place, regexp_replace(string_agg(line, chr(10) ORDER BY i), '^[\s]+|[\s]+$', '', 'g') AS block FROM s GROUP BY ALL)
SELECT doc_id, place::BIGINT AS place, block, CASE WHEN regexp_full_match(string_split(block, chr(10))[1], '[A-Z][^.]{0,60}\.') AND contains(block, chr(10)) THEN regexp_extract(block, '^([^.]*)\.', 1) END AS heading FROM b WHERE len(block) >= 200""")
def text_split_explode(spark, d):
    """Documents cut before lines of one short sentence, which are their headings."""
    head = r"[A-Z][^.\n]{0,60}\.\n"
    found = files.blocks_of(table(spark, d, "documents").select("doc_id", "text"), "text", rf"\n{head}", 200)
    heading = F.when(F.col("block").rlike(f"^{head}"), F.regexp_extract("block", r"^([A-Z][^.\n]{0,60})\.\n", 1))
    return found.select("doc_id", F.col("place").cast("bigint").alias("place"), "block", heading.alias("heading"))


@query("""SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_acctbal < 0 THEN 'debt' END, CASE WHEN n = 0 THEN 'idle' END, CASE WHEN n >= 15 THEN 'loyal' END, CASE WHEN c_acctbal > 9000 THEN 'rich' END], lambda x: x IS NOT NULL), '|') AS flags
FROM (SELECT c_custkey, c_acctbal, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)""")
def flags_array(spark, d):
    n = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = table(spark, d, "customer").join(n, F.col("o_custkey") == F.col("c_custkey"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    flags = rules.flags({"rich": F.col("c_acctbal") > 9000, "debt": F.col("c_acctbal") < 0, "idle": F.col("n") == 0, "loyal": F.col("n") >= 15})
    return c.select("c_custkey", F.array_join(flags, "|").alias("flags"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE array_to_string(list_filter([CASE WHEN o_totalprice > 300000 THEN 'review' END, CASE WHEN o_orderpriority = '1-URGENT' THEN 'express' END, CASE WHEN o_totalprice < 50000 THEN 'small' END], lambda x: x IS NOT NULL), '|') END AS paths,
least(100.0, CASE WHEN o_totalprice > 300000 THEN 60 ELSE 0 END + CASE WHEN o_orderpriority = '1-URGENT' THEN 30 ELSE 0 END + CASE WHEN o_orderstatus = 'P' THEN 15 ELSE 0 END)::DOUBLE AS points FROM orders""")
def path_classifier(spark, d):
    o, price, urgent = table(spark, d, "orders"), F.col("o_totalprice"), F.col("o_orderpriority") == "1-URGENT"
    paths = rules.ordered_paths([("closed", F.col("o_orderstatus") == "F", True), ("review", price > 300000, False), ("express", urgent, False), ("small", price < 50000, False)])
    points = rules.points({"price": (price > 300000, 60), "urgent": (urgent, 30), "open": (F.col("o_orderstatus") == "P", 15)}, most=100)
    return o.select("o_orderkey", F.array_join(paths, "|").alias("paths"), points.alias("points"))


@query("""WITH m AS (SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS m, o_orderdate::DATE AS od FROM orders) SELECT o_orderkey, (m + ((9 - isodow(m)) % 7)::INTEGER)::DATE AS tuesday, CASE WHEN isodow(od) = 6 THEN od + 2 WHEN isodow(od) = 7 THEN od + 1 ELSE od END AS business FROM m""")
def first_weekday_rule(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", S.first_weekday(day, "Tue").alias("tuesday"), S.business_day(day).alias("business"))


@query("""SELECT c_custkey, 'c_' || substr(sha1(c_custkey::VARCHAR || '|' || coalesce(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END, '') || '|' || c_mktsegment), 1, 16) AS id FROM customer""")
def stable_ids(spark, d):
    name = F.when(F.col("c_custkey") % 3 != 0, F.col("c_name"))
    return table(spark, d, "customer").select("c_custkey", S.stable_id(F.col("c_custkey"), name, F.col("c_mktsegment"), prefix="c_").alias("id"))


@query("""SELECT p_partkey, trim(regexp_replace(upper(p_name || ', ' || p_type), '[^A-Z0-9]+', '_', 'g'), '_') AS slug, list_aggregate(list_distinct(list_filter(string_split(upper(p_name), ' '), lambda x: len(x) >= 4)), 'string_agg', '|') IS NULL AS no_long, TRY_CAST(replace(replace('$' || p_retailprice, '$', ''), ',', '') AS DOUBLE) AS price FROM part""")
def scalar_cleanup(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", S.slug(F.concat("p_name", F.lit(", "), "p_type")).alias("slug"), (F.size(S.tokens(F.col("p_name"), 4)) == 0).alias("no_long"), S.to_number(F.concat(F.lit("$"), F.col("p_retailprice").cast("string"))).alias("price"))


@query("SELECT event_id, event_type, user_id FROM events WHERE event_type IN ('click', 'view') AND user_id IN (1, 2, 3)")
def facet_filter(spark, d):
    return views.facets(table(spark, d, "events").select("event_id", "event_type", "user_id"), {"event_type": ["click", "view"], "user_id": [1, 2, 3], "event_id": []})


@query("SELECT event_id, v FROM (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS v FROM events) ORDER BY v DESC NULLS LAST, event_id LIMIT 500")
def nulls_last_top(spark, d):
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("v"))
    return views.ordered(e, "v", True, "event_id").limit(500)


@query("""SELECT 'negative price' AS "check", count(*) FILTER (l_extendedprice < 0) AS offenders, CASE WHEN count(*) FILTER (l_extendedprice < 0) = 0 THEN 'PASS' ELSE 'INVALID' END AS outcome FROM lineitem UNION ALL
SELECT 'high discount', count(*) FILTER (l_discount > 0.09), CASE WHEN count(*) FILTER (l_discount > 0.09) = 0 THEN 'PASS' ELSE 'AMBIGUOUS' END FROM lineitem UNION ALL SELECT 'currency', 0, 'SKIPPED'""")
def quality_gate(spark, d):
    return quality.gate(table(spark, d, "lineitem"), {"negative price": F.col("l_extendedprice") < 0}, {"high discount": F.col("l_discount") > 0.09}, ["currency"])


@query("SELECT 'status' AS rule, count(*) AS broken FROM orders WHERE o_orderstatus NOT IN ('O', 'F') HAVING count(*) > 0")
def contract_violations(spark, d):
    return quality.violations(table(spark, d, "orders"), {"status": F.col("o_orderstatus").isin("O", "F"), "price": F.col("o_totalprice") >= 0})


@query("""WITH t AS (SELECT user_id, CASE event_type WHEN 'click' THEN 'INTERACTION' WHEN 'view' THEN 'INTERACTION' WHEN 'purchase' THEN 'TRANSACTION' WHEN 'error' THEN 'FAULT' WHEN 'signup' THEN 'ACCOUNT' ELSE 'OTHER' END AS kind, event_id FROM events),
a AS (SELECT user_id, kind, count(*) AS n FROM t GROUP BY ALL), b AS (SELECT user_id, kind, count(*) AS n FROM t WHERE NOT (user_id % 10 = 0 AND kind = 'FAULT') GROUP BY ALL UNION ALL SELECT user_id, kind, 2 * count(*) FROM t WHERE user_id % 50 = 7 GROUP BY ALL)
SELECT *, 'left' AS side FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT *, 'right' FROM (FROM b EXCEPT ALL FROM a)""")
def idempotent_rerun(spark, d):
    """A run against one under another partitioning, which lacks some groups and has others twice; all the rest agrees."""
    counts = lambda e: scored.typed(e).groupBy("user_id", "kind").agg(F.count(F.lit(1)).alias("n"))
    e = table(spark, d, "events")
    again = counts(e.repartition(5, "event_id").where("not (user_id % 10 = 0 and event_type = 'error')"))
    twice = counts(e.where("user_id % 50 = 7")).withColumn("n", F.col("n") * 2)
    return quality.difference(counts(e), again.unionByName(twice))


@query("""SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL HAVING count(*) >= 20""")
def having_groups(spark, d):
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")).where("n >= 20")


@query("""SELECT c_custkey, concat_ws(', ', nullif(trim(c_name), ''), CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_mktsegment END, n_name) AS shown, date_diff('day', DATE '2024-01-01' + c_custkey::INTEGER % 90, DATE '2024-03-01') AS days_known FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def display_rows(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    shown = views.joined(F.col("c_name"), F.when(F.col("c_custkey") % 2 != 0, F.col("c_mktsegment")), F.col("n_name"))
    return views.aged(c.withColumn("seen", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 90).cast("int"))), "seen", F.lit("2024-03-01").cast("date")).select("c_custkey", shown.alias("shown"), F.col("days_known").cast("bigint").alias("days_known"))


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL""")
def window_counts(spark, d):
    """The batch form of the stream in ``streaming.jobs.windowed_counts``."""
    return table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")


from . import entities, more, pages, records, timelines  # noqa: E402, F401  (they add their queries)
