"""Operator 13, spelling variant grouping: a trie self-join with active-node sets over the vocabulary.

The active nodes of a trie node u are the nodes v whose prefix is at edit distance 0 or 1 of u's prefix. Those of a child u.c follow from those of u:

* distance 1 goes on along the same letter only: v.c,
* distance 0 (u itself) yields u.c at 0, and at 1 the siblings u.d (replaced), u (deleted) and the children u.c.d (inserted).

Words are near if both end at nodes that are active to each other at distance 1. The trie is partitioned by prefix:

1. Prefixes of over LIMIT words are expanded level by level as DataFrames, each level's active pairs from those of the last, until
   every word lies under a *frontier* prefix of LIMIT words at most (a word that is itself an expanded prefix is one of its own).
2. Under a frontier prefix (distance 0) one task descends the partition's trie and emits its terminal pairs.
3. An active node at distance 1 of a frontier prefix has no edit left: descending both subtries along equal letters is an
   equi-join of what the words have after the prefix and after the node, which Spark deals out by frontier prefix and rest.

A pair is emitted by the greater of its words only, once. Frontier prefixes hold LIMIT words at most and a node has no more siblings than the
alphabet has letters, so no group grows with the data; counts are added up within tasks before they are shuffled.

Defined results: null and empty texts have no runs; a null id is the empty text in the hash of a run; repeated rows count each; ties of
the form go to the smallest word in code-point order; an empty table has no words. Words of any length are taken whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, sized_join

#: One of so many runs of a document is taken with a letter less, least length and count of a word, and times that a form is as frequent.
DAMAGE, LETTERS, TIMES, MORE = 199, 6, 5, 5
#: Words of a partition's trie.
LIMIT = 4096
#: Words of a task that repeats each for the frontier prefixes that it visits.
SPREAD = 10_000
#: Different words, and their letters, that a counting task holds before it hands them on; letters of a text from which its runs are not listed at once.
HELD, HELD_LETTERS, LONG = 200_000, 1 << 24, 1 << 20
_RUN = re.compile(r"[a-zÀ-ÿ]+")


def damaged(run: str, seed: int) -> str:
    """The run, or the run without one letter, as the hash of document and run decides; ``seed`` is the CRC-32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), seed)
    if h % DAMAGE:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, times: int = TIMES) -> DataFrame:
    """word, n: what runs of letters come to in all texts, of at least ``letters`` code points and ``times`` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, size = Counter(), 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = (text.as_py() or "").encode().lower().decode()  # lower-cases A-Z only
                runs = Counter(_RUN.findall(text) if len(text) < LONG else (m[0] for m in _RUN.finditer(text)))
                seed = zlib.crc32(f"{'' if i is None else i}:".encode())
                for run, n in runs.items():
                    if len(run) >= letters and len(word := damaged(run, seed)) >= letters:
                        if word not in total:
                            size += len(word)
                        total[word] += n
                if len(total) >= HELD or size >= HELD_LETTERS:
                    yield out()
                    total.clear()
                    size = 0
        yield out()

    found = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def trie_pairs(words: list[str]) -> Iterator[tuple[int, int]]:
    """Places (greater, smaller) of the words at distance one, each pair once: a descent of their trie, with the active nodes of each node on the way."""
    root: dict = {}
    for i, w in enumerate(words):
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = i
    stack = [(root, [v for c, v in root.items() if c])]
    while stack:
        node, active = stack.pop()
        if (i := node.get("")) is not None:
            yield from ((i, v[""]) for v in active if "" in v and words[v[""]] < words[i])
        for c, child in node.items():
            if c:
                near = {id(v[c]): v[c] for v in active if c in v}
                near |= {id(v): v for d, v in node.items() if d and d != c}
                near |= {id(v): v for d, v in child.items() if d}
                near[id(node)] = node
                near.pop(id(child), None)
                stack.append((child, list(near.values())))


def frontier(words: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, DataFrame, int]:
    """Frontier prefixes (p, alone: the word p only), their active nodes at distance 1 (p, v), and the length of the longest prefix."""

    def level(k: int) -> DataFrame:
        long = words.where(F.char_length("word") >= k)
        return cut(long.groupBy(F.substring("word", 1, k).alias("node")).agg(F.count(F.lit(1)).alias("size")), "level")

    spark, levels, depth = words.sparkSession, [level(0), level(1)], 0
    heavy = levels[0].where(F.col("size") > limit)
    fronts = levels[0].where(F.col("size") <= limit).select(F.col("node").alias("p"), F.lit(False).alias("alone"))
    pairs = spark.createDataFrame([], "p string, v string")
    active = cut(levels[1].select(F.lit("").alias("u"), F.col("node").alias("v")), "active")  # a constant would make the join below one without a key
    while heavy.head(1):
        levels.append(level(depth + 2))
        short = F.substring("node", 1, depth)
        kids = cut(levels[depth + 1].withColumn("u", short).join(heavy.select(F.col("node").alias("u")), "u", "left_semi"), "kids")
        letter = F.substring("node", depth + 1, 1)
        there = levels[depth].union(levels[depth + 1]).union(levels[depth + 2]).select(F.col("node").alias("v"))
        along = kids.join(active, "u").select("node", F.concat("v", letter).alias("v")).join(there, "v", "left_semi").select("node", "v")
        replaced = kids.join(kids.select("u", F.col("node").alias("v")), "u").select("node", "v")
        inserted = levels[depth + 2].select(F.substring("node", 1, depth + 1).alias("p"), F.col("node").alias("v")).join(kids.select(F.col("node").alias("p")), "p", "left_semi")
        all_of = along.union(replaced).union(kids.select("node", "u")).union(inserted).where("node != v").distinct()
        depth += 1
        active = cut(all_of.join(kids.select("node", "size"), "node").select(F.col("node").alias("u"), "v", "size"), "active")
        light, heavy = kids.where(F.col("size") <= limit), kids.where(F.col("size") > limit)
        ends = heavy.join(words, heavy["node"] == words["word"]).select("node")
        fronts = fronts.union(light.select("node", F.lit(False))).union(ends.select("node", F.lit(True)))
        pairs = pairs.union(active.where(F.col("size") <= limit).select("u", "v")).union(active.join(ends.select(F.col("node").alias("u")), "u", "left_semi").select("u", "v"))
        active = active.where(F.col("size") > limit).drop("size")
    return fronts, pairs, depth


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Pairs of ``words`` (word, n) at distance one: a, a_n, b, b_n with a > b, each once."""
    fronts, pairs, depth = frontier(words, limit)
    fronts, pairs = cut(fronts, "fronts"), cut(pairs.where("v < p"), "pairs")  # words under a greater node are greater
    lengths = lambda least, most: F.explode(F.sequence(F.lit(least), F.least(F.char_length("word"), F.lit(most))))
    own = sized_join(words.select("word", "n", lengths(0, depth).alias("k")).withColumn("p", F.substring("word", F.lit(1), F.col("k"))), fronts, ["p"])
    own = cut(own.where("not alone or p = word").select("p", "alone", "word", "n", F.expr("substring(word, k + 1)").alias("rest")), "own")

    def descend(group: pa.Table) -> pa.Table:
        words, n = group["word"].to_pylist(), group["n"].to_pylist()
        skip = len(group["p"][0].as_py())
        found = list(trie_pairs([w[skip:] for w in words]))
        columns = [[words[i] for i, _ in found], [n[i] for i, _ in found], [words[j] for _, j in found], [n[j] for _, j in found]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.int64()] * 2, strict=True)], ["a", "a_n", "b", "b_n"])

    inside = own.where("not alone").select("p", "word", "n").groupBy("p").applyInArrow(descend, "a string, a_n long, b string, b_n long")
    # A few small rows become many: they are dealt out first.
    spread = words.repartition(1 + words.count() // SPREAD, "word")
    visits = sized_join(spread.select("word", "n", lengths(0, depth + 1).alias("k")).withColumn("v", F.substring("word", F.lit(1), F.col("k"))), pairs, ["v"])
    visits = visits.where("not startswith(word, p)").select("p", F.expr("substring(word, k + 1)").alias("rest"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    across = own.join(visits, ["p", "rest"]).where("b < word").select(F.col("word").alias("a"), F.col("n").alias("a_n"), "b", "b_n")
    return inside.union(across)


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """Per word of ``docs``: word, n, n_near (its near words), form (the most frequent of them, if MORE times as frequent), form_n, root."""
    words = cut(counted(docs, id_col, text_col), "vocabulary")
    pairs = cut(near_words(words, limit), "near")
    both = pairs.select("a", "a_n", "b", "b_n").union(pairs.select("b", "b_n", "a", "a_n"))
    best = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("w"))).alias("best"))
    formed = F.col("best.n") <= -MORE * F.col("n")
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("best.w")).alias("form"), F.when(formed, -F.col("best.n")).alias("form_n")
    )
    found = cut(found, "forms")
    # A form is MORE times as frequent as its word, so chains are short; each round doubles how far they are followed.
    roots, moved = found.where("form is not null").select("word", F.col("form").alias("root")), True
    while moved:
        next_of = roots.select(F.col("word").alias("root"), F.col("root").alias("far"))
        roots = cut(roots.join(next_of, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots")
        moved, roots = bool(roots.where("moved").head(1)), roots.select("word", "root")
    return found.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
