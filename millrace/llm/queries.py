"""The queries of this subpackage, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, exact_dedup, langid, licences, mixing, pieces, sharding, simhash, simple8b, spelling, url_filter, vector_codes, warc
from .common import cut, read_table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(read_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"), 40)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return mixing.score(docs, mixing.held_out(F.col("doc_id")))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), remember=1_000_000)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page's number is a field of the metadata record that the assembly nests beside the response or revisit."""
    records = cut(warc.read(spark, warc.write(read_table(spark, sf_dir, "pages")), payloads=False), "records")
    captures = warc.assemble(records)
    number = F.col("metadata.fields")["page"].cast("long")
    return captures.select(number.alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("original.metadata.fields")["page"].cast("long").alias("refers_to"))


URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=4, distance=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.read(spark, simple8b.write(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"))
    told = langid.predict(docs, langid.fit(docs.where(~held)))
    return told.select("doc_id", held.alias("held_out"), "language.lang_pred", "language.score")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digest(licences.scan(read_table(spark, sf_dir, "documents")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(read_table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_sharding, op3_lm_scoring, op4_sentencepiece, op5_warc, op6_url_filter, op7_simhash, op8_token_ids, op9_language_id, op10_decontamination, op11_license_scan, op12_vector_codes, op13_spelling_variants)}


def _license_scan_sql() -> str:
    """Phrases, labels and score. Expressions are beyond SQL; no document of the test tables has a tag, and one that had would stop this SQL."""
    phrases = [(k, p, lab) for k, of in (("base", licences.BASE), ("notice", licences.NOTICES)) for p, lab in of.items()]
    values = ", ".join(f"('{k}', '{p}', '{lab}', {p.count(' ') + 1})" for k, p, lab in phrases)
    tags = " OR ".join(f"contains(line, ' {t} ')" for t in licences.TAGS)
    return rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT row_number() OVER () AS r, doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS line FROM w),
p(kind, phrase, label, n) AS (VALUES {values}),
h AS (SELECT r, kind, label, n, list_filter(range(len(w) - n + 1), lambda i: w[i + 1:i + n] = string_split(phrase, ' ')) AS places FROM t JOIN p ON contains(line, ' ' || phrase || ' ')),
e AS (SELECT r, sum(n) AS e FROM (SELECT r, label, max(n) AS n FROM h GROUP BY ALL) GROUP BY r),
g AS (SELECT r, sum(len(places)) FILTER (kind = 'base') AS n_base, min(places[1]) FILTER (kind = 'base') AS a, max(places[-1]) FILTER (kind = 'base') AS b,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (kind = 'base') AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM h GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, a AS first_word, b AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, 1 - pow(2.0, -least(coalesce(e, 0), {licences.SURE})) AS score, CAST(CASE WHEN {tags} THEN error('a tag') ELSE 0 END AS BIGINT) AS n_expressions,
  CAST(NULL AS BOOLEAN) AS permitted
FROM t LEFT JOIN g ON t.r = g.r LEFT JOIN e ON t.r = e.r"""


def _vector_codes_sql(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    """Each round measures every entry: ``d`` has all distances, ``a`` the nearest entries, ``b`` the codebooks."""
    steps = [
        f"""k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
  list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))""",
        f"p AS MATERIALIZED (SELECT rid, p, i, v[p * (len(v) // {parts}) + i + 1] AS x FROM k, range({parts}) AS t(p), range(len(v) // {parts}) AS u(i))",
        f"b0 AS MATERIALIZED (SELECT p, rid - 1 AS e, i, x FROM p WHERE rid <= {entries})",
    ]
    for r in range(rounds + 1):
        steps.append(f"d{r} AS MATERIALIZED (SELECT p.rid, p.p, b.e, sum((p.x - b.x) * (p.x - b.x)) AS d FROM p JOIN b{r} b ON p.p = b.p AND p.i = b.i GROUP BY ALL)")
        steps.append(f"a{r} AS MATERIALIZED (SELECT rid, p, min(d) AS d, arg_min(e, d * {entries} + e) AS e FROM d{r} GROUP BY ALL)")
        if r < rounds:
            steps.append(
                f"""b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, b.i, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.x) AS x FROM b{r} b LEFT JOIN
  (SELECT p.p, a.e, p.i, sum(p.x) AS s, count(*) AS n FROM p JOIN a{r} a ON p.rid = a.rid AND p.p = a.p GROUP BY ALL) m ON m.p = b.p AND m.e = b.e AND m.i = b.i)"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f""",
c AS (SELECT rid, string_agg(lower(printf('%02x', CAST(e AS INTEGER))), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY rid)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) FROM b{rounds}) AS codebooks_sha256 FROM k JOIN c ON k.rid = c.rid"""
    )


ORACLES = {
    "op1_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g ON n.norm = g.norm""",
    "op5_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda b:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT) >> b) % 32 AS INTEGER) + 1, 1)), '')), '') AS digest, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to FROM d""",
    # An accepted stretch keeps a run of four tokens (13 with two substitutions), three (10 to 12), two (5 to 9 with one), or all: such runs propose, all places are compared.
    "op10_decontamination": r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\x00-\x7F])+') AS t FROM documents),
b AS MATERIALIZED (SELECT row_number() OVER () AS q, item_id, t, len(t) AS n, least(13, len(t)) AS w, CASE WHEN len(t) >= 13 THEN 4 WHEN len(t) >= 10 THEN 3 WHEN len(t) >= 5 THEN 2 ELSE len(t) END AS k
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\x00-\x7F])+') AS t FROM benchmark) WHERE len(t) > 0),
g AS MATERIALIZED (SELECT q, k, p, array_to_string(t[p + 1:p + k], ' ') AS g FROM b, range(0, n - k + 1) AS s(p)),
x AS MATERIALIZED (SELECT r, unnest(t) AS tok, generate_subscripts(t, 1) - 1 AS p FROM d),
y AS MATERIALIZED (SELECT q, unnest(t) AS tok, generate_subscripts(t, 1) - 1 AS p FROM b),
z AS (SELECT r, p, tok, lead(tok, 1) OVER o AS t2, lead(tok, 2) OVER o AS t3, lead(tok, 3) OVER o AS t4 FROM x WINDOW o AS (PARTITION BY r ORDER BY p)),
h AS (SELECT r, p, 1 AS k, tok AS g FROM z UNION ALL SELECT r, p, 2, tok || ' ' || t2 FROM z UNION ALL SELECT r, p, 3, tok || ' ' || t2 || ' ' || t3 FROM z UNION ALL SELECT r, p, 4, tok || ' ' || t2 || ' ' || t3 || ' ' || t4 FROM z),
c AS MATERIALIZED (SELECT DISTINCT h.r, g.q, h.p - g.p AS shift FROM h JOIN g ON h.k = g.k AND h.g = g.g),
a AS (SELECT c.r, c.q, c.shift, y.p, (x.tok = y.tok)::INT AS same FROM c JOIN y ON c.q = y.q JOIN x ON x.r = c.r AND x.p = y.p + c.shift),
m AS (SELECT a.*, sum(same) OVER o AS s1, count(*) OVER o AS c1, w FROM a JOIN b ON a.q = b.q WINDOW o AS (PARTITION BY a.r, a.q, a.shift ORDER BY a.p ROWS BETWEEN CURRENT ROW AND w - 1 FOLLOWING)),
f AS (SELECT r, q, shift, p, s1 AS matched, w FROM m WHERE c1 = w AND s1 >= ceil(0.8 * w - 1e-9))
SELECT doc_id, item_id, arg_min(matched, o)::INT AS matched, any_value(f2.w)::INT AS width, arg_min(p + shift, o)::BIGINT AS doc_start, arg_min(p, o)::INT AS item_start
FROM (SELECT *, (-matched / w, p + shift, p) AS o FROM f) f2 JOIN d USING (r) JOIN b USING (q) GROUP BY doc_id, item_id""",
    "op11_license_scan": _license_scan_sql(),
    "op12_vector_codes": _vector_codes_sql(),
    "op13_spelling_variants": r"""
WITH RECURSIVE t AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS crc FROM range(256) AS r(i)),
r AS (SELECT doc_id, run, count(*) AS n FROM
  (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run),
x AS (SELECT run, n, hex(encode(doc_id || ':' || run)) AS h FROM r),
c AS (SELECT run, n, xor(4294967295, list_reduce(list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
  lambda a, b: xor(a // 256, crc[xor(a, b) % 256 + 1]), 4294967295)) AS h FROM x, t),
d AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM c),
w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM d WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
e AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n FROM e a JOIN e b ON a.i = b.i AND a.less = b.less AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT e.word, w.word, w.n FROM e JOIN w ON e.less = w.word UNION SELECT w.word, e.word, e.n FROM e JOIN w ON e.less = w.word),
g AS (SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS best, max(n) AS best_n FROM p GROUP BY word),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form, CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n FROM w LEFT JOIN g ON w.word = g.word),
z AS (SELECT word, word AS root FROM f UNION ALL SELECT z.word, f.form FROM z JOIN f ON z.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, f.n, f.n_near, f.form_n, z.root FROM f JOIN z ON f.word = z.word JOIN f l ON z.root = l.word WHERE l.form IS NULL""",
}
