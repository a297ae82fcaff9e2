"""Registered queries on pages, samples and state, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling
from ..sources import markup
from .queries import query, table

REGIONS = {"menu": r"<nav\b[^>]*>", "advert": r'<div class="ad"[^>]*>', "body": r"<article\b[^>]*>", "foot": r"<footer\b[^>]*>"}

_PLAIN = r"trim(regexp_replace(replace(replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g'))".replace('\\"', '"')


@query(r"""WITH c AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<script\b.*?</script\s*>', '', 'gsi'), '<style\b.*?</style\s*>', '', 'gsi') AS html FROM pages),
p AS (SELECT page_id, unnest(parts) AS part, unnest(range(len(parts))) AS i FROM (SELECT page_id, string_split(regexp_replace(html, '(<nav\b[^>]*>|<div class="ad"[^>]*>|<article\b[^>]*>|<footer\b[^>]*>)', chr(1) || '\1', 'g'), chr(1)) AS parts FROM c)),
t AS (SELECT page_id, i, part, unnest(tags) AS piece, unnest(range(len(tags))) AS j FROM (SELECT *, string_split(regexp_replace(part, '(<[A-Za-z][^>]*>)', chr(2) || '\1', 'g'), chr(2)) AS tags FROM p)),
x AS (SELECT page_id, i, j, CASE WHEN starts_with(part, '<nav') THEN 'menu' WHEN starts_with(part, '<div class="ad"') THEN 'advert' WHEN starts_with(part, '<article') THEN 'body' WHEN starts_with(part, '<footer') THEN 'foot' ELSE '' END AS region,
  regexp_extract(piece, '^<[A-Za-z][^>]*>') AS tag, unnest(texts) AS text, unnest(range(len(texts))) AS k FROM (SELECT *, regexp_split_to_array(piece, '<[^>]*>') AS texts FROM t)),
y AS (SELECT page_id, region, tag, i, j, k, """ + _PLAIN.format("text") + """ AS text FROM x)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i, j, k) - 1 AS place, region, tag, text FROM y WHERE text <> ''""")
def page_nodes(spark, d):
    found = table(spark, d, "pages").select("page_id", F.posexplode(markup.nodes(F.col("html"), REGIONS)).alias("place", "x"))
    return found.select("page_id", F.col("place").cast("long").alias("place"), "x.*")


@query(r"""WITH r AS (SELECT page_id, unnest(string_split(regexp_replace(html, '<nav\b[^>]*>', chr(1), 'gi'), chr(1))[2:]) AS r FROM pages),
s AS (SELECT page_id, list_transform(regexp_split_to_array(regexp_split_to_array(r, '(?i)</nav\s*>')[1], '(?i)<li\b[^>]*>')[2:], lambda x: regexp_replace(regexp_split_to_array(x, '(?i)</li\s*>')[1], '<[^>]*>', ' ', 'g')) AS cells FROM r)
SELECT page_id, len(cells) AS cells, """ + _PLAIN.format("cells[1]") + """ AS first, """ + _PLAIN.format("cells[-1]") + """ AS last FROM s WHERE len(cells) > 0""")
def page_rows(spark, d):
    """Each menu is a row and its items are cells."""
    found = table(spark, d, "pages").select("page_id", F.explode(markup.rows(F.col("html"), "nav", "li")).alias("r"))
    return found.select("page_id", F.size("r").cast("long").alias("cells"), F.get("r", F.lit(0)).alias("first"), F.element_at("r", -1).alias("last"))


@query("""WITH n AS (SELECT l_returnflag || l_linestatus || '/' || l_quantity::INT AS stratum, l_orderkey || '/' || l_linenumber AS id FROM lineitem),
h AS (SELECT stratum, id, md5('7:' || id) AS h, count(*) OVER (PARTITION BY stratum) AS n FROM n),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h, id) AS place FROM h)
SELECT stratum, id, n AS rows, least(20, greatest(5, ceil(0.02 * n)::BIGINT), n) AS taken FROM r WHERE place <= least(20, greatest(5, ceil(0.02 * n)::BIGINT))""")
def seeded_sample(spark, d):
    """Two in a hundred lines of each flag, status and quantity, five at least and twenty at most."""
    lines = table(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus", F.lit("/"), F.col("l_quantity").cast("int")).alias("stratum"), F.concat_ws("/", "l_orderkey", "l_linenumber").alias("id"))
    return sampling.stratified(lines, ["stratum"], ["id"], share=0.02, floor=5, cap=20, seed=7).select("stratum", "id", "rows", "taken")
