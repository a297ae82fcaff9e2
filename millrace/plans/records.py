"""Registered queries on records, evidence and review, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import ledger, records, rules, snapshots, views
from .queries import query, table

TYPES = {" Click": "INTERACTION", "view": "INTERACTION", "purchase": "TRANSACTION"}


@query("""WITH e AS (SELECT e.*, c.* FROM events e LEFT JOIN customer c ON CASE WHEN event_id % 10 <> 3 THEN user_id END = c_custkey AND c_custkey % 4 <> 0 WHERE event_type IN ('click', 'view', 'purchase'))
SELECT 'raw_' || substr(sha1(event_id || '|shop'), 1, 16) AS raw_event_id, CASE event_type WHEN 'purchase' THEN 'TRANSACTION' ELSE 'INTERACTION' END AS canonical_type, event_type AS raw_type, c_custkey IS NOT NULL AS found, c_name AS owner, value AS amount FROM e
UNION ALL SELECT '', 'unmapped', event_type, false, '', count(*)::DOUBLE FROM events WHERE event_type NOT IN ('click', 'view', 'purchase') GROUP BY event_type""")
def raw_events(spark, d):
    """Events as raw events, and how many were of no mapped type."""
    e = table(spark, d, "events").withColumn("key", F.when(F.col("event_id") % 10 != 3, F.col("user_id")))
    c = table(spark, d, "customer").where("c_custkey % 4 <> 0")
    found = records.raw_events(e, TYPES, "event_type", c, "key", "c_custkey", {"refs": {"owner": F.col("d.c_name")}, "amounts": {"value": F.col("s.value")}}, [F.col("s.event_id"), F.lit("shop")])
    rest = records.unmapped(e, TYPES, "event_type")
    rows = found.select("raw_event_id", "canonical_type", "raw_type", "found", F.col("refs.owner").alias("owner"), F.col("amounts.value").alias("amount"))
    return rows.union(rest.select(F.lit(""), F.lit("unmapped"), "raw_type", F.lit(False), F.lit(""), F.col("n").cast("double")))


@query("""WITH n AS (SELECT c_nationkey, c_mktsegment, count(*) AS n, min(c_custkey) AS k FROM customer GROUP BY ALL), s AS (SELECT s_suppkey, s_name, s_acctbal, n, CASE WHEN n = 1 THEN k END AS k FROM supplier LEFT JOIN n ON s_nationkey = c_nationkey AND CASE s_suppkey % 3 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'MACHINERY' ELSE 'none' END = c_mktsegment)
SELECT 'base_' || s_suppkey AS base_id, CASE WHEN k IS NOT NULL THEN 'RESOLVED' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'UNRESOLVED' END AS status, k AS key, CASE WHEN k IS NOT NULL THEN NULL WHEN n > 1 THEN 'several_matches' ELSE 'no_match' END AS review_reason, s_name AS name, coalesce(CASE WHEN s_acctbal > 0 THEN s_acctbal END, -1) AS balance FROM s""")
def base_records(spark, d):
    """Suppliers resolved to the only customer of their nation in a segment."""
    n = table(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("k"))
    segment = F.when(F.col("s_suppkey") % 3 == 0, "BUILDING").when(F.col("s_suppkey") % 3 == 1, "MACHINERY").otherwise("none")
    s = table(spark, d, "supplier").withColumn("segment", segment)
    s = s.join(n, (F.col("s_nationkey") == F.col("c_nationkey")) & (F.col("segment") == F.col("c_mktsegment")), "left").withColumn("id", F.col("s_suppkey").cast("string"))
    carried = {"name": F.col("s_name"), "balance": F.when(F.col("s_acctbal") > 0, F.col("s_acctbal"))}
    found = records.base_records(s, "id", F.when(F.col("n") == 1, F.col("k")), F.col("n"), carried, {"balance": F.lit(-1.0)})
    return found.select("base_id", "status", "key", "review_reason", "carried.name", "carried.balance")


@query("""WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS name, generate_subscripts(string_split(p_name, ' '), 1) - 1 AS place FROM part)
SELECT p_partkey, place, name, CASE WHEN name ILIKE '%ring%' THEN 'round' WHEN regexp_matches(name, '(?i)^b') THEN 'blunt' ELSE 'individual' END AS class, CASE WHEN name ILIKE '%ring%' OR NOT regexp_matches(name, '(?i)^b') THEN 'holder' ELSE 'part' END AS role FROM w""")
def party_classes(spark, d):
    p = table(spark, d, "part").select("p_partkey", records.tagged_by_class(F.split("p_name", " "), [("ring", "round"), ("^B", "blunt")], {"individual": "holder", "round": "holder"}, "part").alias("parties"))
    return p.select("p_partkey", F.posexplode("parties").alias("place", "x")).select("p_partkey", F.col("place").cast("bigint").alias("place"), "x.*")


@query("""WITH n AS (SELECT 'N' || o_orderkey AS number, o_custkey % 97 || ' ' || o_orderpriority AS address, CASE WHEN o_orderstatus = 'F' THEN 'closing' ELSE 'opening' END AS type, 'place_' || substr(sha1(o_custkey % 97 || '|' || o_orderpriority), 1, 16) AS place_id FROM orders WHERE o_orderkey % 6 <> 0 AND o_custkey % 11 <> 0)
SELECT place_id, type, min(address) AS address, count(*) AS notices, sum(count(*)) OVER (PARTITION BY place_id)::BIGINT AS of_place FROM n GROUP BY place_id, type""")
def notice_places(spark, d):
    """Orders as notices of places; some lack an address or a number, and a status without a type has that of the first."""
    o = table(spark, d, "orders").select(
        F.when(F.col("o_custkey") % 11 != 0, F.concat(F.col("o_custkey") % 97, F.lit(" "), F.col("o_orderpriority"))).alias("address"), F.when(F.col("o_orderkey") % 6 != 0, F.concat(F.lit(" N"), F.col("o_orderkey"))).otherwise("  ").alias("number"), "o_orderstatus", (F.col("o_custkey") % 97).alias("a"), "o_orderpriority"
    )
    found = records.notices(o, "address", "number", "o_orderstatus", {"f": "closing", "A": "opening"}, [F.col("a"), F.col("o_orderpriority")])
    whole = records.places(found).select("place_id", F.col("notices").alias("of_place"))
    return found.groupBy("place_id", "type").agg(F.min("address").alias("address"), F.count(F.lit(1)).alias("notices")).join(whole, "place_id")


@query("""SELECT 'P' || p_partkey AS key, p_name AS name, CASE WHEN p_size % 4 <> 0 THEN p_size * 1000 END AS worth, CASE WHEN p_size % 3 = 0 THEN p_size % 2 = 0 WHEN p_type <> 'PROMO' THEN contains(upper(p_type), 'M') END AS exempt FROM part WHERE p_partkey % 8 <> 0""")
def translated_parts(spark, d):
    p = table(spark, d, "part").select(
        F.when(F.col("p_partkey") % 8 != 0, F.concat(F.lit(" P"), F.col("p_partkey"))).otherwise(" ").alias("id"),
        F.concat(F.lit("\t"), "p_name", F.lit(" ")).alias("label"),
        F.when(F.col("p_size") % 4 != 0, F.concat(F.lit("$"), F.col("p_size"), F.lit(",000.00"))).otherwise("n/a").alias("money"),
        F.when(F.col("p_size") % 3 == 0, F.col("p_size") % 2 == 0).alias("flag"),
        F.when(F.col("p_type") != "PROMO", F.lower("p_type")).otherwise(" ").alias("codes"),
    )
    return records.translated(p, "id", {"name": "label"}, {"worth": "money"}, {"exempt": ("flag", "codes", "m")})


@query("""SELECT o_custkey, count(*) AS entries, count(*) FILTER (o_orderstatus = 'F') AS n_F, count(*) FILTER (o_orderstatus = 'O') AS n_O, coalesce(string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')), '') AS primary_sources,
max(o_orderdate) FILTER (o_orderstatus = 'F') AS last_verified FROM orders GROUP BY 1""")
def evidence_summary(spark, d):
    """Orders as evidence of customers: statuses, priorities as sources, dates."""
    found = ledger.summary(table(spark, d, "orders"), "o_custkey", "o_orderstatus", ["F", "O"], "o_orderpriority", ["2-HIGH", "1-URGENT"], "o_orderdate")
    return found.withColumn("primary_sources", F.array_join("primary_sources", "|"))


@query("""WITH r AS (SELECT l_orderkey, l_returnflag, l_tax, l_extendedprice FROM lineitem), e AS (SELECT l_orderkey, min(l_returnflag) AS a, max(l_returnflag) AS b, min(l_tax) AS c, max(l_tax) AS d, min(l_extendedprice) AS e, max(l_extendedprice) AS f FROM r GROUP BY 1)
SELECT l_orderkey, 'l_returnflag' AS field, a AS low, b AS high FROM e WHERE a <> b UNION ALL SELECT l_orderkey, 'l_tax', NULL, NULL FROM e WHERE d - c > 0.065 UNION ALL SELECT l_orderkey, 'l_extendedprice', NULL, NULL FROM e WHERE f - e > 0.9 * abs(f)""")
def field_conflicts(spark, d):
    """Lines as reports on their orders: flags that differ, taxes over 0.065 apart, prices of which one is under a tenth of another."""
    found = ledger.conflicts(table(spark, d, "lineitem"), "l_orderkey", {"l_returnflag": ("differ", None), "l_tax": ("by", 0.065), "l_extendedprice": ("share", 0.9)})
    text = F.col("field") == "l_returnflag"
    return found.select("l_orderkey", "field", F.when(text, F.col("low")).alias("low"), F.when(text, F.col("high")).alias("high"))


@query("""WITH q AS (SELECT o_orderkey, 'dear' || CASE WHEN o_orderkey % 2 = 0 THEN '|old' ELSE '' END AS reasons, CASE o_orderkey % 3 WHEN 0 THEN 'open' WHEN 1 THEN 'decided' ELSE 'cleared' END AS state, CASE WHEN o_orderkey % 3 = 1 THEN 'keep' END AS decision, 1 AS since FROM orders WHERE o_orderkey % 5 <> 0),
n AS (SELECT o_orderkey, concat_ws('|', CASE WHEN o_totalprice > 250000 THEN 'dear' END, CASE WHEN o_orderstatus = 'P' THEN 'old' END) AS r FROM orders WHERE o_totalprice > 250000 OR o_orderstatus = 'P'),
b AS (SELECT coalesce(q.o_orderkey, n.o_orderkey) AS o_orderkey, q.o_orderkey IS NOT NULL AS there, reasons, state, decision, since, r FROM q FULL OUTER JOIN n ON q.o_orderkey = n.o_orderkey),
s AS (SELECT *, CASE WHEN NOT there THEN 'open' WHEN r IS NULL THEN CASE state WHEN 'open' THEN 'cleared' ELSE state END WHEN state = 'decided' AND list_has_all(string_split(reasons, '|'), string_split(r, '|')) THEN 'decided' ELSE 'open' END AS now FROM b)
SELECT o_orderkey, CASE WHEN r IS NULL OR now = 'decided' THEN reasons ELSE r END AS reasons, now AS state, decision, CASE WHEN there AND now = state THEN since ELSE 2 END AS since FROM s""")
def review_queue(spark, d):
    """A queue of an earlier run, and what the orders give cause to review now."""
    o, key = table(spark, d, "orders"), F.col("o_orderkey") % 3
    queue = o.where("o_orderkey % 5 <> 0").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit("dear"), F.lit("old"))).otherwise(F.array(F.lit("dear"))).alias("reasons"), F.when(key == 0, "open").when(key == 1, "decided").otherwise("cleared").alias("state"), F.when(key == 1, "keep").alias("decision"), F.lit(1).alias("since")
    )
    now = o.select("o_orderkey", F.array_compact(F.array(F.when(F.col("o_orderstatus") == "P", "old"), F.when(F.col("o_totalprice") > 250000, "dear"))).alias("reasons"))
    return ledger.refreshed_queue(queue, now, "o_orderkey", F.lit(2)).withColumn("reasons", F.array_join("reasons", "|"))


@query("""SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error', 'view')""")
def switched_sources(spark, d):
    """One source is off and one is hidden from exports."""
    config = table(spark, d, "events").groupBy(F.col("event_type").alias("source")).agg(F.lit(1)).select("source", F.when(F.col("source") == "error", False).alias("enabled"), (F.col("source") == "view").alias("hidden"))
    return ledger.switched(table(spark, d, "events").select("event_id", "event_type"), "event_type", config, export=True)


@query("""WITH p AS (SELECT c_custkey, least(60, greatest(0, c_acctbal / 100))::DOUBLE AS base, CASE WHEN c_acctbal > 5000 THEN 20.0 ELSE 0 END + CASE WHEN c_mktsegment = 'BUILDING' THEN 35.5 ELSE 0 END - CASE WHEN c_nationkey % 5 = 0 THEN 50.0 ELSE 0 END AS more, c_nationkey % 5 = 0 AS c, c_acctbal > 5000 AS a, c_mktsegment = 'BUILDING' AS b FROM customer),
s AS (SELECT *, round(greatest(0.0, least(100.0, base + more)), 6)::DOUBLE AS score FROM p)
SELECT c_custkey, score, concat_ws('|', 'base', CASE WHEN a THEN 'rich' END, CASE WHEN b THEN 'builder' END, CASE WHEN c THEN 'far' END, CASE WHEN base + more NOT BETWEEN 0 AND 100 THEN 'limit' END) AS reasons, true AS whole,
CASE WHEN score >= 80 THEN 'halt' WHEN score >= 40 THEN 'look' ELSE 'pass' END AS band, substr(sha1(c_custkey || '|' || CASE WHEN score >= 80 THEN 'halt' WHEN score >= 40 THEN 'look' ELSE 'pass' END), 1, 16) AS id FROM s""")
def scored_reasons(spark, d):
    """A score whose reasons add up to it, a band in which it halts, and an id that both make."""
    c = table(spark, d, "customer")
    base = F.least(F.lit(60.0), F.greatest(F.lit(0.0), F.col("c_acctbal") / 100))
    held = ledger.with_reasons({"rich": (F.col("c_acctbal") > 5000, 20), "builder": (F.col("c_mktsegment") == "BUILDING", 35.5), "far": (F.col("c_nationkey") % 5 == 0, -50)}, base)
    rows = c.select("c_custkey", held.alias("h")).select("c_custkey", F.round("h.score", 6).alias("score"), F.array_join(F.transform("h.reasons", lambda r: r["reason"]), "|").alias("reasons"), ledger.adds_up(F.col("h.score"), F.col("h.reasons")).alias("whole"))
    rows = rows.withColumn("band", rules.band(F.col("score"), [(80, "halt"), (40, "look")], "pass"))
    return rows.withColumn("id", S.stable_id(F.col("c_custkey"), F.col("band")))


_LABEL = """CASE p_partkey % 9 WHEN 0 THEN 'Eco' WHEN 1 THEN 'eco' WHEN 2 THEN ' my ' || lower(p_type) WHEN 3 THEN lower(p_type) WHEN 4 THEN substr(p_type, 1, 3) WHEN 5 THEN substr(p_type, 1, 2) || ' -' || substr(p_type, 3, 1) || '.' WHEN 6 THEN '*' || p_type || '!' WHEN 7 THEN '  ' ELSE p_name END"""


@query(f"""WITH r AS (SELECT p_partkey, trim({_LABEL}) AS t FROM part), s AS (SELECT *, upper(t) AS u, trim(regexp_replace(upper(t), '[^A-Z0-9]+', '_', 'g'), '_') AS f FROM r),
k(k, a) AS (VALUES ('ECONOMY', 'ECO'), ('PROMO', 'PRO'), ('STANDARD', 'STA'), ('SMALL', 'SMA'), ('MEDIUM', 'ME_D'))
SELECT p_partkey, CASE WHEN t = '' THEN 'empty' WHEN t = 'Eco' THEN 'exact' WHEN u IN ('MY SMALL', 'MY LARGE') THEN 'synonym' WHEN u = k.k THEN 'key' WHEN u = b.a THEN 'abbreviation' WHEN c.k IS NOT NULL THEN 'slug' ELSE 'unknown' END AS reason,
CASE WHEN t = '' THEN NULL WHEN t = 'Eco' THEN 'cheap' WHEN u = 'MY SMALL' THEN 'SMALL' WHEN u = 'MY LARGE' THEN 'big' WHEN u = k.k THEN k.k WHEN u = b.a THEN b.k ELSE c.k END AS value,
CASE WHEN t = '' THEN 0 WHEN t = 'Eco' THEN 100 WHEN u = 'MY SMALL' THEN 90 WHEN u = 'MY LARGE' THEN 60 WHEN u = k.k OR u = b.a THEN 100 WHEN c.k IS NOT NULL THEN 95 ELSE 0 END AS confidence
FROM s LEFT JOIN k ON u = k.k LEFT JOIN k b ON u = b.a LEFT JOIN k c ON f = c.k OR f = c.a""")
def normalized_labels(spark, d):
    """Part types as people write them, through all layers."""
    hit = rules.normalized(F.col("raw"), {"Eco": "cheap"}, {"my small": ("SMALL", 90), "My large": ("big", 60)}, {"ECONOMY": ["eco"], "PROMO": ["Pro"], "STANDARD": ["STA"], "SMALL": ["sma"], "MEDIUM": ["me-d"]})
    return table(spark, d, "part").select("p_partkey", F.expr(_LABEL).alias("raw")).select("p_partkey", hit.alias("h")).select("p_partkey", "h.reason", "h.value", "h.confidence")


@query("""WITH f AS (SELECT c_custkey, c_acctbal, c_nationkey <> 3 AS away, c_mktsegment = 'BUILDING' AS firm, c_acctbal > 8000 AS rich FROM customer),
a AS (SELECT *, away OR firm AND rich AS absent FROM f)
SELECT c_custkey, concat_ws('|', CASE WHEN absent THEN 'absent' END, CASE WHEN away THEN 'away' END, CASE WHEN absent AND NOT rich AND c_acctbal < 0 THEN 'empty' END, CASE WHEN firm THEN 'firm' END, CASE WHEN rich THEN 'rich' END) AS flags FROM a""")
def derived_flags(spark, d):
    """Flags that bring others with them or build on them."""
    rules_of = [
        ("away", F.col("c_nationkey") != 3, ["absent"]),
        ("firm", F.col("c_mktsegment") == "BUILDING", []),
        ("rich", F.col("c_acctbal") > 8000, []),
        ("absent", lambda held: held["firm"] & held["rich"], []),
        ("empty", lambda held: held["absent"] & ~held["rich"] & (F.col("c_acctbal") < 0), []),
    ]
    return table(spark, d, "customer").select("c_custkey", F.array_join(rules.derived(rules_of), "|").alias("flags"))


@query("""WITH h AS (SELECT o_custkey, min(o_orderdate)::DATE AS first_seen, max(o_orderdate)::DATE AS last_seen, max(o_orderkey) - min(o_orderkey) AS delta, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS kinds, count(DISTINCT o_orderpriority) AS n,
arg_min(o_orderstatus, o_orderkey) AS lead, count(*) FILTER (o_orderstatus = 'F') AS depth FROM orders GROUP BY 1), t AS (SELECT DATE '2000-06-01' AS day)
SELECT c_custkey, coalesce(first_seen = day, true) AS is_new, coalesce(first_seen <> day AND last_seen = day AND delta <> 0, false) AS is_updated, coalesce(date_diff('day', first_seen, day), 0) AS days_known, coalesce(delta, 0) AS change, coalesce(nullif(depth, 0), n, 0) AS depth, lead, coalesce(kinds, '') AS kinds
FROM customer LEFT JOIN h ON o_custkey = c_custkey, t WHERE NOT coalesce(lead = 'P', false)""")
def export_rows(spark, d):
    """Customers with what their history says, as a role that does not see pending ones gets them."""
    o, day = table(spark, d, "orders"), F.lit("2000-06-01").cast("date")
    history = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(F.to_date("o_orderdate")).alias("first_seen"), F.max(F.to_date("o_orderdate")).alias("last_seen"), (F.max("o_orderkey") - F.min("o_orderkey")).alias("delta"))
    lists = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_set("o_orderpriority")).alias("kinds"), F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("filled"))
    rows = views.decorated(table(spark, d, "customer").select("c_custkey").join(lists, "c_custkey", "left"), history, "c_custkey", day)
    rows = views.with_firsts(rows, {"lead": ("orders", "o_orderstatus")}).withColumn("depth", views.depth_or(F.col("filled"), F.col("kinds")))
    seen = views.seen_by(rows, "client", {"client": F.col("lead") == "P"})
    return views.flat(seen.select("c_custkey", "is_new", "is_updated", "days_known", "change", "depth", "lead", F.coalesce("kinds", F.array().cast("array<string>")).alias("kinds")))


@query("""WITH r AS (SELECT o_custkey, date_trunc('year', o_orderdate)::DATE AS run, CASE WHEN max(o_totalprice) > 400000 THEN 'review' ELSE 'clear' END AS status, CASE WHEN max(o_totalprice) > 400000 THEN 'dear' ELSE '' END AS reasons FROM orders WHERE year(o_orderdate) IN (1996, 1997) GROUP BY ALL),
a AS (SELECT * FROM r WHERE run = DATE '1996-01-01'), b AS (SELECT * FROM r WHERE run = DATE '1997-01-01')
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, concat_ws(';', a.run || ':' || a.status || ':' || a.reasons, CASE WHEN b.status IS NOT NULL AND (a.status IS NULL OR a.status <> b.status) THEN b.run || ':' || b.status || ':' || b.reasons END) AS history FROM a FULL OUTER JOIN b ON a.o_custkey = b.o_custkey""")
def review_history(spark, d):
    """Two yearly runs of a review; the second adds an entry only where it says something else."""
    o = table(spark, d, "orders")

    def run(year: int):
        dear = F.max("o_totalprice") > 400000
        of = o.where(F.year("o_orderdate") == year).groupBy("o_custkey").agg(F.when(dear, "review").otherwise("clear").alias("status"), F.when(dear, F.array(F.lit("dear"))).otherwise(F.array().cast("array<string>")).alias("reasons"))
        return of.withColumn("run", F.lit(f"{year}-01-01").cast("date"))

    none = F.lit(None).cast("array<struct<run:date,status:string,reasons:array<string>>>")
    first = run(1996).select("o_custkey", rules.with_history(none, F.col("status"), F.col("reasons"), F.col("run")).alias("history"))
    both = first.join(run(1997), "o_custkey", "full_outer")
    history = F.when(F.col("run").isNull(), F.col("history")).otherwise(rules.with_history(F.col("history"), F.col("status"), F.col("reasons"), F.col("run")))
    text = F.array_join(F.transform(history, lambda h: F.concat_ws(":", h["run"].cast("string"), h["status"], F.array_join(h["reasons"], ","))), ";")
    return both.select("o_custkey", text.alias("history"))


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn FROM orders) WHERE rn = 1 ORDER BY o_totalprice DESC, o_orderkey""")
def best_first(spark, d):
    return views.best_first(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_totalprice", "o_orderkey")


@query("""SELECT o_orderkey, o_orderdate::DATE AS first_seen FROM orders WHERE o_orderdate >= DATE '1998-06-01'""")
def seen_since(spark, d):
    state = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("first_seen"))
    return snapshots.since(state, F.lit("1998-06-01").cast("date"))
