"""Operator 6, URL filters: explicit rules, and for all other urls a path-template tree.

Rules name a host and the beginning of a path; one fits its host and all subdomains, and the longest that fits decides.

The tree. Within a host, a path becomes its shape (digit runs are ``#``), and each host's shapes are generalised level by level. At
a node, a segment can stay literal if it has ``least`` urls, however many its siblings have; the others become ``*``. Literal
branches that are statistically like the rest of their siblings are merged into the wildcard as well: two-proportion z-tests on
the share of labelled urls, on the share of bad ones among them, and on the share that ends at the next level must all stay under
``z``. A branch is compared with the sum of its siblings, never with each of them. A template's purity is its share of bad labels
with ``smooth`` neutral ones added; templates of ``reject`` or more are blocked, and a template without labels is allowed.

Labels come from a column (1 bad, 0 good, null none). Without one, the rules' own verdicts are the labels.

Only DataFrame expressions are used. Urls are combined by (host, shape) before anything else, so a host that holds a third of all
rows is a few rows; what remains is joined by ``sized_join``, which no hot host slows down.

Defined results: a null url, or one without ``://``, has an empty host and path; empty segments are segments; segments beyond
``depth`` are one (None: every segment has its level, and a round of jobs); equally long rules rank by their text; rows that repeat are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, sized_join

LEAST, Z, SMOOTH, REJECT, DEPTH = 5, 1.96, 2.0, 0.8, 32


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct<rule, verdict> of the longest of the (verdict, rule) pairs that fits; null if none does."""
    out = F
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        at, slash, begin = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + begin)
        out = out.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
    return out.otherwise(F.lit(None)) if out is not F else F.lit(None).cast("struct<rule:string,verdict:string>")


def _differ(hit: str, of: str) -> Column:
    """Whether a branch and the rest of its node differ in the share ``hit`` / ``of``; without a base on either side they don't."""
    h, n = F.col(hit), F.col(of)
    rest_h, rest_n = F.col(f"all_{hit}") - h, F.col(f"all_{of}") - n
    pooled = F.col(f"all_{hit}") / F.nullif(F.col(f"all_{of}"), F.lit(0))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.nullif(n, F.lit(0)) + 1 / F.nullif(rest_n, F.lit(0))))
    return F.coalesce(F.abs(h / F.nullif(n, F.lit(0)) - rest_h / F.nullif(rest_n, F.lit(0))) > F.lit(Z) * error, F.lit(False))


def templates(urls: DataFrame, depth: int | None = DEPTH, least: int = LEAST) -> DataFrame:
    """Of host, path, bad (1, 0 or null): host, shape, template, purity, one row for each (host, shape)."""
    sums = [F.count(F.lit(1)).cast("double").alias("n"), F.count("bad").cast("double").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad")]
    tree = urls.withColumn("shape", shape(F.col("path"))).groupBy("host", "shape").agg(*sums)
    segments = F.split(F.regexp_replace("shape", "^/", ""), "/", depth or -1)
    tree = cut(tree.withColumn("segments", segments).withColumn("template", F.lit("")), "tree")
    levels = tree.agg(F.max(F.size("segments"))).first()[0] or 0
    stats = ("n", "labelled", "bad", "ends")
    for level in range(levels):
        here = tree.withColumn("segment", F.get("segments", level)).withColumn("ends", F.when(F.size("segments") <= level + 2, F.col("n")).otherwise(0.0))
        kids = here.where("segment is not null").groupBy("host", "template", "segment").agg(*[F.sum(s).alias(s) for s in stats])
        kids = cut(kids, "kids")
        node = kids.groupBy("host", "template").agg(*[F.sum(s).alias(f"all_{s}") for s in stats], F.count(F.lit(1)).alias("branches"))
        kids = sized_join(kids, node, ["host", "template"])
        carries = F.col("n") >= least
        own = (F.col("branches") == 1) | _differ("labelled", "n") | _differ("bad", "labelled") | _differ("ends", "n")
        literal = kids.where(carries & own).select("host", "template", "segment", F.lit(True).alias("literal"))
        here = sized_join(here, literal, ["host", "template", "segment"], "left")
        part = F.when(F.col("literal"), F.col("segment")).otherwise("*")
        tree = cut(here.withColumn("template", F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), part))).select(*tree.columns), "tree")
    whole = tree.groupBy("host", "template").agg(((F.sum("bad") + SMOOTH / 2) / (F.sum("labelled") + SMOOTH)).alias("purity"))
    return sized_join(tree.select("host", "shape", "template"), whole, ["host", "template"])


def shape(path: Column) -> Column:
    return F.regexp_replace(path, "[0-9]+", "#")


def judge(urls: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", label_col: str | None = None, depth: int | None = DEPTH) -> DataFrame:
    """One row for each row of ``urls``: id, host, path, rule, verdict (allow or block), template, purity."""
    host, path = host_and_path(F.col(url_col))
    label = F.col(label_col).cast("int") if label_col else F.lit(None).cast("int")
    rows = urls.select(F.col(id_col), host.alias("host"), path.alias("path"), label.alias("label"))
    rows = rows.withColumn("fits", ruled(F.col("host"), F.col("path"), rules))
    bad = F.col("label") if label_col else (F.col("fits.verdict") == "block").cast("int")
    tree = cut(templates(rows.select("host", "path", bad.alias("bad")), depth), "templates")
    judged = sized_join(rows.withColumn("shape", shape(F.col("path"))), tree, ["host", "shape"], "left")
    method = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return judged.select(id_col, "host", "path", "fits.rule", F.coalesce("fits.verdict", method).alias("verdict"), "template", "purity")
