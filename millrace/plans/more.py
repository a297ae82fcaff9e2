"""Further registered queries: integrity, dated snapshots, gates, adapters, views, name rules and date rules, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.dates import DateRules
from ..operators import aggregates, matching, quality, rules, snapshots, views
from ..sources import files
from ..sources.adapter import Adapter
from .queries import _RESOLVED, _SNAPSHOTS, _two_snapshots, query, strategy_resolve, table


@query("""SELECT DISTINCT l_orderkey, l_partkey AS missing FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <> 5)""")
def array_ref_integrity(spark, d):
    lists = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("parts"))
    return matching.missing_elements(lists, "l_orderkey", "parts", table(spark, d, "part").where("p_size <> 5"), "p_partkey")


@query("""WITH c AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal > 9000), s AS (SELECT DISTINCT s_nationkey AS k FROM supplier)
SELECT CASE WHEN c.k IS NULL THEN 'right' WHEN s.k IS NULL THEN 'left' ELSE 'both' END AS side, count(*) AS n FROM c FULL OUTER JOIN s ON c.k = s.k GROUP BY 1""")
def key_overlap(spark, d):
    c = table(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k"))
    return matching.key_overlap(c, table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")), F.col("k"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def unseen_keys(spark, d):
    return matching.unseen(table(spark, d, "customer").select("c_custkey", "c_name"), table(spark, d, "orders").where("o_orderstatus = 'F'"), "c_custkey", "o_custkey")


@query(f"""WITH {_RESOLVED} SELECT c_custkey AS k, c_mktsegment, CASE WHEN matches IS NULL THEN 'rejected' WHEN matches = 1 AND c_mktsegment <> 'MACHINERY' THEN 'confirmed' ELSE 'possible' END AS decision, CASE WHEN matches = 1 THEN t END AS match
FROM customer LEFT JOIN (SELECT * FROM b WHERE rn = 1) ON k = c_custkey""")
def match_policy(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    return matching.policy(c, strategy_resolve(spark, d), "k", F.col("c_mktsegment") != "MACHINERY")


@query("SELECT o_orderkey, o_custkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE coalesce(c_acctbal, 0) >= 0")
def detail_join(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    return matching.with_detail(o, c, "o_custkey", F.col("c_acctbal") < 0).select("o_orderkey", "o_custkey", "c_mktsegment")


@query("""SELECT user_id, string_agg(DISTINCT w, '|' ORDER BY w) AS words FROM (SELECT user_id, unnest(CASE WHEN event_type = 'error' THEN [] ELSE [event_type, CASE WHEN value > 50 THEN 'high' ELSE 'low' END] END) AS w FROM events) GROUP BY 1
UNION ALL SELECT user_id, '' FROM events GROUP BY 1 HAVING count(*) FILTER (event_type <> 'error') = 0""")
def array_union(spark, d):
    words = F.when(F.col("event_type") == "error", F.array().cast("array<string>")).otherwise(F.array("event_type", F.when(F.col("value") > 50, "high").otherwise("low")))
    out = aggregates.union_arrays(table(spark, d, "events").select("user_id", words.alias("words")), ["user_id"], "words")
    return out.withColumn("words", F.array_join("words", "|"))


@query("""SELECT name, string_agg(k::VARCHAR, ',' ORDER BY k) AS keys FROM (SELECT DISTINCT upper(trim(p_name)) AS name, p_partkey AS k FROM part WHERE NOT list_contains(string_split(upper(trim(p_name)), ' '), 'RED')) GROUP BY 1 HAVING count(*) >= 2""")
def holders(spark, d):
    found = aggregates.holders(table(spark, d, "part"), F.concat(F.lit(" "), F.col("p_name")), "p_partkey", 2, ["red"])
    return found.select("name", F.array_join(F.col("keys").cast("array<string>"), ",").alias("keys"))


@query("""SELECT 'urgent' AS metric, avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0 END)::DOUBLE AS value FROM orders UNION ALL SELECT 'open', avg(CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0 END)::DOUBLE FROM orders
UNION ALL SELECT 'price', round(avg(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END), 6)::DOUBLE FROM orders""")
def run_metrics(spark, d):
    o = table(spark, d, "orders")
    return aggregates.metrics(o, {"urgent": F.col("o_orderpriority") == "1-URGENT", "open": F.col("o_orderstatus") == "O"}, {"price": F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey"))}).withColumn("value", F.when(F.col("metric") == "price", F.round("value", 6)).otherwise(F.col("value")))


@query(_SNAPSHOTS.replace("a AS (", "a0 AS (", 1).replace("FROM a FULL", "FROM a0 a FULL") + """SELECT d.*, CASE WHEN a.o_orderkey IS NULL THEN DATE '2024-02-01' ELSE DATE '2024-01-01' END AS first_seen, CASE WHEN change_status = 'GONE' THEN DATE '2024-01-15' ELSE DATE '2024-02-01' END AS last_seen FROM d LEFT JOIN a0 a ON d.o_orderkey = a.o_orderkey""")
def snapshot_dates(spark, d):
    old, new = _two_snapshots(spark, d)
    day = lambda x: F.lit(x).cast("date")
    old = old.withColumns({"first_seen": day("2024-01-01"), "last_seen": day("2024-01-15")})
    return snapshots.dated_diff(old, new, ["o_orderkey"], ["o_orderstatus", "o_totalprice"], day("2024-02-01"), ("NEW", "SAME", "UPDATED", "GONE"))


@query(_SNAPSHOTS + """SELECT CASE WHEN change_status IN ('NEW', 'GONE') THEN change_status WHEN o_orderkey % 4 = 0 THEN 'UPDATED' ELSE 'SAME' END AS value, count(*) AS n FROM d GROUP BY 1""")
def field_diff_counts(spark, d):
    """Compares one field only."""
    diffed = snapshots.diff(*_two_snapshots(spark, d), ["o_orderkey"], ["o_totalprice"])
    return aggregates.histogram(diffed, "change_status")


@query("""SELECT o_orderkey, DATE '2024-03-01' AS first_seen, DATE '2024-03-01' AS last_seen, o_custkey AS current, NULL::BIGINT AS previous, NULL::BIGINT AS delta FROM orders""")
def history_rebuild(spark, d):
    o = quality.unique(table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("bigint").alias("o_custkey")), ["o_orderkey"])
    return snapshots.rebuilt(o, "o_orderkey", "o_custkey", F.lit("2024-03-01").cast("date"))


@query("""WITH c AS (SELECT event_type, count(*) AS n FROM events WHERE event_id % 2 = 1 GROUP BY 1), p AS (SELECT event_type, count(*) AS n FROM events WHERE event_id % 2 = 0 AND event_type <> 'error' GROUP BY 1)
SELECT coalesce(p.event_type, c.event_type) AS event_type, p.n AS previous, c.n AS current, round((c.n - p.n) / p.n::DOUBLE, 9) AS change FROM p FULL OUTER JOIN c ON p.event_type = c.event_type""")
def run_change(spark, d):
    e = table(spark, d, "events")
    counts = lambda x: aggregates.histogram(x, "event_type").withColumnRenamed("value", "event_type")
    changed = snapshots.run_change(counts(e.where("event_id % 2 = 0 AND event_type <> 'error'")), counts(e.where("event_id % 2 = 1")), "event_type", "n")
    return changed.withColumn("change", F.round("change", 9))


@query("""WITH l AS (SELECT user_id, max(ts) FILTER (event_type = 'signup') AS opened, max(ts) FILTER (event_type = 'purchase') AS closed FROM events GROUP BY 1 HAVING count(*) FILTER (event_type = 'signup') > 0), m AS (SELECT max(ts)::DATE AS day FROM events)
SELECT user_id, opened, closed, CASE WHEN closed > opened THEN 'closed' WHEN closed = opened THEN 'conflict' WHEN DATE '2024-02-15' - opened::DATE > 30 THEN 'expired' ELSE 'open' END AS state FROM l""")
def lifecycle(spark, d):
    return snapshots.lifecycle(table(spark, d, "events"), "user_id", "ts", F.col("event_type") == "signup", F.col("event_type") == "purchase", F.lit("2024-02-15").cast("date"), 30)


@query("""SELECT 'dear' AS "check", o_orderkey FROM orders WHERE o_totalprice > 400000 UNION ALL SELECT 'stuck', o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'""")
def gate_offenders(spark, d):
    return quality.offenders(table(spark, d, "orders"), "o_orderkey", {"dear": F.col("o_totalprice") > 400000, "stuck": (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")})


@query("""WITH v AS (SELECT 'plain' AS run, l_linestatus AS part, CASE WHEN count(*) FILTER (l_extendedprice < 1000) > 0 THEN 'blocked' WHEN count(*) FILTER (l_discount > 0.09) > 0 THEN 'review' ELSE 'ok' END AS verdict,
concat_ws('|', CASE WHEN count(*) FILTER (l_discount > 0.09) > 0 THEN 'high discount' END, CASE WHEN count(*) FILTER (l_extendedprice < 1000) > 0 THEN 'low price' END) AS failed FROM lineitem GROUP BY 2
UNION ALL SELECT 'strict', l_linestatus, CASE WHEN count(*) FILTER (l_discount > 0.09) > 0 THEN 'blocked' ELSE 'ok' END, concat_ws('|', CASE WHEN count(*) FILTER (l_discount > 0.09) > 0 THEN 'high discount' END) FROM lineitem GROUP BY 2
UNION ALL SELECT 'mild', l_linestatus, CASE WHEN count(*) FILTER (l_tax > 0.07) > 0 THEN 'review' ELSE 'ok' END, concat_ws('|', CASE WHEN count(*) FILTER (l_tax > 0.07) > 0 THEN 'high tax' END) FROM lineitem GROUP BY 2)
SELECT run, part, verdict, CASE WHEN run = 'strict' THEN 'released' ELSE verdict END AS action, failed FROM v""")
def gate_action(spark, d):
    """Three gates over either half of the lines; only the strict one is overridden."""
    lines, dear, cheap = table(spark, d, "lineitem"), F.col("l_discount") > 0.09, F.col("l_extendedprice") < 1000
    gates = {"plain": ({"low price": cheap}, {"high discount": dear}, None), "strict": ({"high discount": dear}, {}, "released"), "mild": ({}, {"high tax": F.col("l_tax") > 0.07}, None)}
    out = [
        quality.action(quality.gate(lines.where(F.col("l_linestatus") == part), bad, doubtful, ["currency"]), override).withColumns({"run": F.lit(run), "part": F.lit(part), "failed": F.array_join("failed", "|")})
        for run, (bad, doubtful, override) in gates.items()
        for part in ("F", "O")
    ]
    return files.union_all(out)


@query(_SNAPSHOTS + """, a0 AS (SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n FROM a GROUP BY 2 UNION ALL SELECT 'cents', CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), count(*) FROM a GROUP BY 2),
b0 AS (SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n FROM b GROUP BY 2 UNION ALL SELECT 'cents', CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), count(*) FROM b GROUP BY 2)
SELECT coalesce(x."column", y."column") AS "column", coalesce(x.value, y.value) AS value, coalesce(x.n, 0) AS stated, coalesce(y.n, 0) AS counted FROM a0 x FULL OUTER JOIN b0 y ON x."column" = y."column" AND x.value = y.value WHERE coalesce(x.n, 0) <> coalesce(y.n, 0)""")
def header_check(spark, d):
    """The header of an earlier snapshot, held against the rows of a later one."""
    columns = ["o_orderstatus", "cents"]
    old, new = (x.withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint") % 100) for x in _two_snapshots(spark, d))
    return quality.header_mismatch(new, aggregates.header(old, columns), columns)


@query("""SELECT event_id AS raw_id, 'shop' AS source, CASE upper(event_type) WHEN 'CLICK' THEN 'INTERACTION' WHEN 'VIEW' THEN 'INTERACTION' WHEN 'PURCHASE' THEN 'TRANSACTION' ELSE 'OTHER' END AS kind,
CASE WHEN user_id % 2 = 0 THEN 'buyer:u' || user_id ELSE 'buyer:u' || user_id || '|buyer:u0' END AS parties FROM events WHERE event_type <> 'error'""")
def adapted_source(spark, d):
    e = table(spark, d, "events").withColumn("who", F.concat(F.lit(" u"), F.col("user_id"), F.when(F.col("user_id") % 2 == 0, F.lit("; nobody ;")).otherwise(F.lit(";u0"))))
    adapter = Adapter({"raw_id": "event_id", "kind": "event_type"}, {"source": "shop"}, {"kind": {"CLICK": "INTERACTION", "VIEW": "INTERACTION", "PURCHASE": "TRANSACTION"}}, {"who": "buyer"}, ("Nobody",), {"event_type": ("err",)}, ("raw_id",))
    return adapter.apply(e).withColumn("parties", F.array_join(F.transform("parties", lambda p: F.concat(p["role"], F.lit(":"), p["name"])), "|"))


@query("""SELECT c_custkey, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'warn' END AS flag FROM customer WHERE c_nationkey IN (1, 2, 3)""")
def allowed_values(spark, d):
    c = table(spark, d, "customer").withColumn("n", F.col("c_nationkey").cast("string"))
    kept = c.where(rules.allowed(F.col("n"), ["1", "2", "3"], "drop")["keep"])
    return kept.select("c_custkey", rules.allowed(F.col("c_mktsegment"), ["building", "machinery"], "warn")["flag"].alias("flag"))


@query("""WITH u AS (SELECT user_id, list(DISTINCT event_type) AS kinds FROM events GROUP BY 1), v AS (SELECT 'both' AS view, user_id FROM u WHERE list_contains(kinds, 'click') AND list_contains(kinds, 'purchase') UNION ALL SELECT 'faulty', user_id FROM u WHERE list_contains(kinds, 'error')
UNION ALL SELECT 'ready', user_id FROM u WHERE list_contains(kinds, 'purchase') AND NOT list_contains(kinds, 'error')) SELECT view, user_id FROM v""")
def canned_views(spark, d):
    u = table(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("kinds"))
    has = lambda k: F.array_contains("kinds", k)
    return views.canned(u, {"both": has("click") & has("purchase"), "faulty": has("error"), "ready": has("purchase") & ~has("error")}).select("view", "user_id")


@query("""SELECT s_suppkey, '{"s_name":"' || s_name || '","s_nationkey":' || CASE WHEN s_nationkey = 0 THEN 'null' ELSE s_nationkey::VARCHAR END || ',"s_suppkey":' || s_suppkey || '}' AS line FROM supplier""")
def stable_json(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", F.nullif("s_nationkey", F.lit(0)).alias("s_nationkey"))
    return s.select("s_suppkey", views.as_json(s).alias("line"))


@query("SELECT event_id, event_type FROM events WHERE value > 90 ORDER BY event_id LIMIT 25")
def first_matches(spark, d):
    return files.first_rows(table(spark, d, "events").where("value > 90").select("event_id", "event_type"), 25, [F.col("event_id")])


@query("""SELECT p_partkey, p_name ILIKE '%re%' OR p_name ILIKE '%bolt%' AS excluded, trim(CASE WHEN p_size % 2 = 0 THEN p_type ELSE ' ' END) <> '' OR p_size % 3 = 0 AS present FROM part""")
def name_exclusion(spark, d):
    p = table(spark, d, "part")
    kind, size = F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(" "), F.when(F.col("p_size") % 3 == 0, "x")
    return p.select("p_partkey", rules.has_fragment(F.col("p_name"), ["RE", "bolt"]).alias("excluded"), rules.any_present(kind, size).alias("present"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN concat_ws('|', 'partial', CASE WHEN o_totalprice > 300000 THEN 'dear' END) WHEN 'F' THEN concat_ws('|', CASE WHEN o_totalprice > 300000 THEN 'dear' END, 'partial') ELSE CASE WHEN o_totalprice > 300000 THEN 'dear' ELSE '' END END AS reasons,
CASE WHEN o_totalprice > 300000 OR o_orderstatus IN ('P', 'F') THEN 'review' ELSE 'clear' END AS status FROM orders""")
def review_reasons(spark, d):
    seeds = F.when(F.col("o_orderstatus") == "P", F.array(F.lit("partial")))
    r = rules.review(seeds, {"dear": F.col("o_totalprice") > 300000, "partial": F.col("o_orderstatus").isin("P", "F")})
    return table(spark, d, "orders").select("o_orderkey", F.array_join(r["reasons"], "|").alias("reasons"), r["status"].alias("status"))


@query("""WITH p AS (SELECT p_partkey, replace(p_type, 'O', '0') AS t FROM part), s AS (SELECT p_partkey, l, 1 - levenshtein(t, l) / greatest(len(t), len(l))::DOUBLE AS likeness, i FROM p, (VALUES ('ECONOMY', 0), ('PROMO', 1), ('STANDARD', 2), ('SMALL', 3)) v(l, i)),
r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY likeness DESC, i) AS rn FROM s) SELECT p_partkey, CASE WHEN likeness >= 0.6 THEN l END AS label FROM r WHERE rn = 1""")
def fuzzy_types(spark, d):
    p = table(spark, d, "part").withColumn("t", F.translate("p_type", "O", "0"))
    return p.select("p_partkey", rules.fuzzy_label(F.col("t"), ["ECONOMY", "PROMO", "STANDARD", "SMALL"], 0.6).alias("label"))


@query("""WITH b AS (SELECT p_type AS key, p_brand AS alias FROM part GROUP BY ALL HAVING count(*) >= 2), v AS (SELECT p_type AS key, min(p_size) AS value FROM part GROUP BY 1), e AS (SELECT p_brand AS alias, max(p_size) AS value FROM part WHERE p_size < 25 GROUP BY 1 HAVING count(*) % 2 = 0),
o AS (SELECT p_brand AS alias, count(*)::INTEGER AS value FROM part WHERE p_type = 'PROMO' GROUP BY 1 HAVING count(*) % 5 = 0),
a AS (SELECT alias, value, 'broad' AS origin, 2 AS rank FROM b JOIN v USING (key) UNION ALL SELECT alias, value, 'explicit', 1 FROM e UNION ALL SELECT alias, value, 'override', 0 FROM o),
r AS (SELECT alias, value, origin, row_number() OVER (PARTITION BY alias ORDER BY rank, value) AS rn FROM a)
SELECT p_partkey, r.value, r.origin FROM part LEFT JOIN r ON alias = p_brand AND rn = 1""")
def rule_fan_out(spark, d):
    """Rules of part types fan out to the brands that have them; some brands have rules of their own, and a run overrides a few."""
    p = table(spark, d, "part")
    broad = p.groupBy(F.col("p_type").alias("key"), F.col("p_brand").alias("alias")).agg(F.count(F.lit(1)).alias("n")).where("n >= 2").drop("n")
    values = p.groupBy(F.col("p_type").alias("key")).agg(F.min("p_size").alias("value"))
    explicit = p.where("p_size < 25").groupBy(F.col("p_brand").alias("alias")).agg(F.max("p_size").alias("value"), F.count(F.lit(1)).alias("n")).where("n % 2 = 0").drop("n")
    override = p.where("p_type = 'PROMO'").groupBy(F.col("p_brand").alias("alias")).agg(F.count(F.lit(1)).cast("int").alias("value")).where("value % 5 = 0")
    return p.select("p_partkey", F.col("p_brand").alias("alias")).join(rules.fan_out_rows(broad, values, explicit, override), "alias", "left").select("p_partkey", "value", "origin")


@query("""WITH r AS (SELECT p_partkey, upper(CASE p_partkey % 5 WHEN 0 THEN '12b ' || p_name WHEN 1 THEN '12-14B RED blue RED ' || p_name || ' nut BOLT NUT' WHEN 2 THEN '7 red bolt' WHEN 3 THEN p_size || 'ABC ' || p_name || ' ' || p_type ELSE '123-' || p_size || 'b  BLUE x ' || p_name END) AS t FROM part),
w AS (SELECT p_partkey, t, list_filter(string_split(t, ' '), lambda x: x <> '') AS w FROM r), n AS (SELECT p_partkey, t, CASE WHEN regexp_matches(w[1], '^[0-9]') THEN w[2:] ELSE w END AS w FROM w),
l AS (SELECT p_partkey, t, w[coalesce(list_position(list_transform(w, lambda x: x NOT IN ('RED', 'BLUE')), true), len(w) + 1):] AS w FROM n),
z AS (SELECT *, list_reverse(w) AS v FROM l)
SELECT p_partkey, array_to_string(list_reverse(v[coalesce(list_position(list_transform(v, lambda x: x NOT IN ('BOLT', 'NUT')), true), len(v) + 1):]), ' ') AS body, coalesce(w[1], '') AS root,
  replace(regexp_extract(t, '^([0-9]+[A-Z]?( *- *[0-9]+[A-Z]?)?)', 1), ' ', '') AS number FROM z""")
def body_words(spark, d):
    name, size, key = F.col("p_name"), F.col("p_size").cast("string"), F.col("p_partkey") % 5
    raw = F.when(key == 0, F.concat(F.lit("12b "), name)).when(key == 1, F.concat(F.lit("12-14B RED blue RED "), name, F.lit(" nut BOLT NUT"))).when(key == 2, "7 red bolt")
    raw = raw.when(key == 3, F.concat(size, F.lit("ABC "), name, F.lit(" "), "p_type")).otherwise(F.concat(F.lit("123-"), size, F.lit("b  BLUE x "), name))
    return table(spark, d, "part").select("p_partkey", F.array_join(S.body_words(raw, ["RED", "BLUE"], ["BOLT", "NUT"]), " ").alias("body"), S.root_word(raw, ["RED", "BLUE"]).alias("root"), S.leading_number(raw).alias("number"))


@query("""SELECT p_partkey, p_name || ' ' || p_type AS name, p_type IN ('ECONOMY', 'PROMO') AS listed FROM part""")
def cleaned_names(spark, d):
    raw = F.concat(F.lit(' "'), F.col("p_name"), F.lit(" \t "), F.col("p_type"), F.lit(',.;"'))
    codes = F.when(F.col("p_type") == "PROMO", "small; promo,x").when(F.col("p_type") == "ECONOMY", "PROMO").otherwise("promotion,none")
    return table(spark, d, "part").select("p_partkey", S.cleaned_name(raw).alias("name"), S.listed(codes, "promo").alias("listed"))


@query("""WITH r AS (SELECT event_id, 'number' AS kind, regexp_extract(props, '([0-9]+)', 1) AS value FROM events WHERE regexp_matches(props, '[0-9]+') UNION ALL SELECT event_id, 'even', regexp_extract(props, '([0-9]*[02468])\\D', 1) FROM events WHERE regexp_matches(props, '([0-9]*[02468])\\D'))
SELECT event_id, kind, value, substr(sha1(event_id || '|' || kind || '|' || value), 1, 16) AS id FROM r""")
def pattern_rows(spark, d):
    e = table(spark, d, "events").select("event_id", F.explode(S.found(F.col("props"), {"number": "([0-9]+)", "even": r"([0-9]*[02468])\D"})).alias("x")).select("event_id", "x.*")
    return e.withColumn("id", S.stable_id(F.col("event_id"), F.col("kind"), F.col("value")))


@query("""WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS d, date_trunc('month', o_orderdate)::DATE AS m FROM orders), r AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN (m + ((8 - isodow(m)) % 7)::INTEGER)::DATE WHEN 1 THEN last_day(d) ELSE m END AS c FROM o),
x AS (SELECT o_orderkey, c, unnest(range(0, 12)) AS i FROM r), f AS (SELECT o_orderkey, c, min(CASE WHEN isodow(c + i::INTEGER) < 6 AND strftime(c + i::INTEGER, '%m-%d') NOT IN ('01-01', '12-25') THEN i END) AS nx, min(CASE WHEN isodow(c - i::INTEGER) < 6 AND strftime(c - i::INTEGER, '%m-%d') NOT IN ('01-01', '12-25') THEN i END) AS pv FROM x GROUP BY ALL)
SELECT o_orderkey, (c + nx::INTEGER)::DATE AS next, (c - pv::INTEGER)::DATE AS previous, CASE WHEN nx <= pv THEN (c + nx::INTEGER)::DATE ELSE (c - pv::INTEGER)::DATE END AS nearest FROM f""")
def date_rules(spark, d):
    known, day, closed = DateRules(), F.to_date("o_orderdate"), ["01-01", "12-25"]
    name = F.when(F.col("o_orderkey") % 3 == 0, "first_mon").when(F.col("o_orderkey") % 3 == 1, "last_of_month").otherwise("not a rule")
    return table(spark, d, "orders").select("o_orderkey", *[known.by(name, day, mode, closed).alias(mode) for mode in ("next", "previous", "nearest")])


@query("""SELECT o_custkey, max(o_orderdate) AS primary_date FROM orders WHERE strftime(o_orderdate, '%Y-%m') < '1997-06' GROUP BY 1""")
def primary_date(spark, d):
    """The latest date of each group, of the rows whose fixed-width month comes before another."""
    o = table(spark, d, "orders").where(F.date_format("o_orderdate", "yyyy-MM") < "1997-06")
    return aggregates.merge_groups(o.withColumn("key", F.col("o_orderkey").cast("string")), ["o_custkey"], "key", [], "o_orderdate").select("o_custkey", F.col("latest").alias("primary_date"))


@query("""WITH o AS (SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS m FROM orders), f AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN m WHEN 1 THEN (m + ((8 - isodow(m)) % 7)::INTEGER)::DATE ELSE (m + CASE isodow(m) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END::INTEGER)::DATE END AS c FROM o),
h AS (SELECT *, strftime(c, '%m-%d') IN ('01-01', '07-04', '09-02', '12-25', '03-01', '05-01') AS hit, isodow(c) AS w FROM f)
SELECT o_orderkey, CASE WHEN hit THEN (c + (CASE WHEN w < 3 THEN 3 - w ELSE 10 - w END)::INTEGER)::DATE ELSE c END AS wednesday, CASE WHEN hit THEN (c + CASE w WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END::INTEGER)::DATE ELSE c END AS after, CASE WHEN hit THEN (c - CASE w WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END::INTEGER)::DATE ELSE c END AS before FROM h""")
def listed_days(spark, d):
    """Dates that move off listed days only: to the next Wednesday, the working day after, or the one before."""
    known, closed = DateRules(), ["01-01", "07-04", "09-02", "12-25", "03-01", "05-01"]
    name = F.when(F.col("o_orderkey") % 4 == 0, "first_of_month").when(F.col("o_orderkey") % 4 == 1, "first_mon").otherwise("first_business_day")
    modes = {"wednesday": "listed:Wed", "after": "listed:next", "before": "listed:previous"}
    return table(spark, d, "orders").select("o_orderkey", *[known.by(name, F.to_date("o_orderdate"), m, closed).alias(c) for c, m in modes.items()])


@query("""WITH w AS (SELECT p_partkey, p_brand, p_size, list_distinct(string_split(p_name || ' ' || lower(p_type), ' ')) AS w FROM part), h AS (SELECT a.p_partkey, min(b.p_partkey) AS match_id, count(*) AS candidates FROM w a JOIN w b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey <> b.p_partkey AND len(list_intersect(a.w, b.w)) >= 1 GROUP BY 1)
SELECT p.p_partkey, CASE WHEN candidates > 0 THEN 'brand_size' END AS tier, coalesce(candidates, 0) AS candidates, match_id FROM part p LEFT JOIN h ON p.p_partkey = h.p_partkey""")
def verified_match(spark, d):
    """Parts of one brand and size that share a word; the pairs are those of different words in a brand and size."""
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_size", F.array_sort(F.array_distinct(F.split(F.concat_ws(" ", "p_name", F.lower("p_type")), " "))).alias("w"))
    found = matching.tiered_match(p, p.withColumnRenamed("p_partkey", "k"), "p_partkey", "k", [("brand_size", 85, ["p_brand", "p_size"])], F.arrays_overlap("l.w", "r.w"), itself=True, looks_at=["w"])
    return found.select("p_partkey", "tier", "candidates", "match_id")


@query("""SELECT p_partkey, CASE WHEN regexp_extract(code, '^ *([A-Z]+)', 1) IN ('EC', 'PR') THEN 'usable' WHEN regexp_extract(code, '^ *([A-Z]+)', 1) = 'ST' THEN 'review' WHEN regexp_extract(code, '^ *([A-Z]+)', 1) IN ('', 'SM') THEN 'noise' ELSE 'unsupported' END AS class,
p_brand <> 'Brand#1' AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND NOT starts_with(p_size::VARCHAR, '1') AND NOT starts_with(p_size::VARCHAR, '49') AS elsewhere,
CASE WHEN p_name LIKE '%ring%' THEN 'mixed' WHEN p_name LIKE '%bolt%' THEN 'outer' WHEN p_name LIKE '%red%' THEN 'inner' END AS mode,
CASE p_type WHEN 'PROMO' THEN 'offer' WHEN 'SMALL' THEN CASE WHEN p_name LIKE '%ring%' THEN 'small mixed' WHEN p_name NOT LIKE '%bolt%' AND p_name LIKE '%red%' THEN 'small inner' END END AS pattern
FROM (SELECT *, CASE WHEN p_partkey % 7 = 0 THEN p_size || p_type ELSE ' ' || upper(substr(p_type, 1, 2)) || '-' || p_size END AS code FROM part)""")
def coded_parts(spark, d):
    """Classes by the prefix of a code, regions elsewhere, a mode out of a text, and what depends on the mode."""
    p = table(spark, d, "part")
    code = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.col("p_size").cast("string"), "p_type")).otherwise(F.concat(F.lit(" "), F.lower(F.substring("p_type", 1, 2)), F.lit("-"), F.col("p_size").cast("string")))
    mode = rules.regime(F.col("p_name"), [("ring", "mixed"), ("bolt", "outer"), ("red", "inner")])
    pattern = rules.by_regime(F.col("p_type"), {"PROMO": "offer", "SMALL": "by_regime", "LARGE": "by_regime"}, mode, {"SMALL": {"mixed": "small mixed", "inner": "small inner"}})
    away = rules.elsewhere(F.lower("p_brand"), F.col("p_size").cast("string"), "brand#1", ["Brand#1", "Brand#2", "Brand#3"], ["1", "49"])
    return p.select("p_partkey", rules.prefix_class(code, ["EC", "pr"], ["ST"], ["SM"]).alias("class"), away.alias("elsewhere"), mode.alias("mode"), pattern.alias("pattern"))
