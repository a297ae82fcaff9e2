"""Registered queries on entities, loose names and types, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import entities, loose
from .queries import query, table


@query("""WITH RECURSIVE r AS (SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS a, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS VARCHAR) END AS b, o_orderpriority || '/' || CAST(CAST(floor(o_totalprice / 500) AS BIGINT) AS VARCHAR) AS c FROM orders),
k AS (SELECT id, 'ab' AS k, a AS x, b AS y FROM r UNION ALL SELECT id, 'ac', a, c FROM r UNION ALL SELECT id, 'bc', b, c FROM r),
e AS MATERIALIZED (SELECT DISTINCT p.id AS u, q.id AS v FROM k p JOIN k q ON p.k = q.k AND p.x = q.x AND p.y = q.y AND p.id <> q.id),
w AS (SELECT id AS u, id AS root FROM r UNION SELECT e.v, w.root FROM w JOIN e ON w.u = e.u WHERE w.root < e.v),
m AS MATERIALIZED (SELECT r.*, n.entity FROM r JOIN (SELECT u, min(root) AS entity FROM w GROUP BY u) n ON n.u = r.id),
s AS (SELECT id, entity, 'customer' AS kind, a AS value FROM m UNION ALL SELECT id, entity, 'day', b FROM m UNION ALL SELECT id, entity, 'price', c FROM m),
g AS (SELECT kind, value FROM s GROUP BY ALL HAVING count(DISTINCT entity) > 1 AND value IS NOT NULL),
f AS (SELECT id, string_agg(DISTINCT s.kind, '|' ORDER BY s.kind) AS shared FROM s JOIN g ON s.kind = g.kind AND s.value = g.value GROUP BY id)
SELECT m.id AS o_orderkey, m.entity, count(*) OVER (PARTITION BY m.entity) AS size, coalesce(f.shared, '') AS shared FROM m LEFT JOIN f ON m.id = f.id""")
def entity_merge(spark, d):
    """Orders that share two of customer, day and (priority, price step) are one; every ninth has no day."""
    o = table(spark, d, "orders")
    kinds = {"customer": [F.col("o_custkey")], "day": [F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate"))], "price": [F.col("o_orderpriority"), F.floor(F.col("o_totalprice") / 500)]}
    return entities.merged(o, "o_orderkey", kinds).withColumn("shared", F.array_join("shared", "|"))


@query("""WITH n AS (SELECT p_partkey AS id, upper(p_brand || ' ' || p_type || ' ' || p_name || ' ' || p_size) AS b FROM part),
a AS (SELECT p_partkey, upper(CASE p_partkey % 4 WHEN 0 THEN p_type || ' ' || p_name || ' ' || p_size WHEN 1 THEN split_part(p_name, ' ', 2) || ', ' || p_brand || ' ' || p_type WHEN 2 THEN 'x ' || lower(p_brand) || ' ' || p_type || ' ' || p_name || ' ' || p_size ELSE ' ' END) AS a FROM part),
w AS (SELECT *, list_filter(regexp_split_to_array(a, '[\\s,]+'), lambda w: length(w) > 2) AS aw FROM a), v AS (SELECT *, list_filter(regexp_split_to_array(b, '[\\s,]+'), lambda w: length(w) > 2) AS bw FROM n),
m AS (SELECT w.p_partkey, v.id FROM w JOIN v ON trim(a) <> '' AND (contains(b, a) OR contains(a, b) OR (len(aw) > 0 AND list_has_all(bw, aw))))
SELECT a.p_partkey, count(m.id) AS matches, CASE WHEN count(m.id) = 1 THEN min(m.id) END AS match FROM a LEFT JOIN m ON a.p_partkey = m.p_partkey GROUP BY a.p_partkey""")
def loose_names(spark, d):
    """Parts by some of their words, by a part of their name, or by more than their name; every fourth is asked for by nothing."""
    p, key, space = table(spark, d, "part"), F.col("p_partkey") % 4, F.lit(" ")
    size = F.col("p_size").cast("string")
    whole = F.concat_ws(" ", "p_brand", "p_type", "p_name", size)
    asked = F.when(key == 0, F.concat_ws(" ", "p_type", "p_name", size)).when(key == 1, F.concat(F.split_part("p_name", space, F.lit(2)), F.lit(", "), "p_brand", space, "p_type"))
    asked = asked.when(key == 2, F.concat_ws(" ", F.lit("x"), F.lower("p_brand"), "p_type", "p_name", size)).otherwise(" ")
    return loose.loose_match(p.select("p_partkey", asked.alias("asked")), "p_partkey", "asked", p.select(F.col("p_partkey").alias("id"), whole.alias("name")), "id", "name")


_RAW = """CASE p_partkey % 6 WHEN 0 THEN p_type || '  ' || p_name WHEN 1 THEN replace(replace(upper(p_type || ' ' || p_name), 'O', '0'), 'S', '5') WHEN 2 THEN substr(p_type || ' ' || p_name, 1, 3) || substr(p_type || ' ' || p_name, 5)
WHEN 3 THEN p_type || ' ' || p_name || 'X' WHEN 4 THEN 'VOID ' || p_type || ' ' || p_name ELSE ' ' END"""


@query(f"""WITH r AS (SELECT p_partkey, trim(regexp_replace(upper({_RAW}), '\\s+', ' ', 'g')) AS text FROM part),
g AS (SELECT upper(label) AS known, min(label) AS label, bool_or(negative) AS negative FROM (SELECT p_type || ' ' || p_name AS label, p_type = 'PROMO' AS negative FROM part UNION ALL SELECT 'VOID ' || p_type || ' ' || p_name, p_size > 40 FROM part WHERE p_size % 2 = 0) GROUP BY 1),
x AS (SELECT DISTINCT text, array_to_string(list_transform(string_split(text, ' '), lambda w: CASE WHEN regexp_full_match(w, '[A-Z]+([0158][A-Z]+)+') THEN translate(w, '0158', 'OISB') ELSE w END), ' ') AS fixed FROM r WHERE text <> ''),
t AS (SELECT text, text AS try, 0 AS turn, 0 AS swaps FROM x UNION ALL SELECT text, fixed, 1, len(list_filter(range(length(text)), lambda i: text[i + 1] <> fixed[i + 1])) FROM x WHERE text <> fixed),
h AS (SELECT t.*, g.*, levenshtein(try, known) AS d, 1 - levenshtein(try, known) / greatest(length(try), length(known))::DOUBLE AS likeness FROM t, g),
b AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY turn, d > 0, likeness DESC, known) AS rn FROM h WHERE likeness >= 0.9 - 1e-9),
o AS (SELECT text, label, CASE WHEN d = 0 THEN 100.0 ELSE greatest(70.0, round(90 * likeness, 6)) END - 5 * swaps AS confidence, swaps, NOT negative AND text LIKE '%VOID%' AS wrong FROM b WHERE rn = 1)
SELECT p_partkey, CASE WHEN NOT wrong THEN label END AS label, CASE WHEN coalesce(wrong, true) THEN 0.0 ELSE confidence END::DOUBLE AS confidence, CASE WHEN o.text IS NULL THEN 'unknown' WHEN wrong THEN 'polarity_conflict' WHEN swaps >= 3 THEN 'speculative' END AS reason FROM r LEFT JOIN o ON r.text = o.text""")
def fuzzy_registry(spark, d):
    """Parts' types and names with slips of the pen and of the eye, against a registry of them; what is void may only be taken for what is void."""
    p = table(spark, d, "part")
    name, void = F.concat("p_type", F.lit(" "), "p_name"), F.concat(F.lit("VOID "), "p_type", F.lit(" "), "p_name")
    known = p.select(name.alias("label"), (F.col("p_type") == "PROMO").alias("negative")).union(p.where("p_size % 2 = 0").select(void, F.col("p_size") > 40))
    rows = p.select("p_partkey", F.expr(_RAW).alias("raw"))
    return loose.typed(rows, "raw", known, "label", "negative", ["void"]).select("p_partkey", "label", "confidence", "reason")
