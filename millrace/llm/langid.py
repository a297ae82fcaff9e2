"""Operator 9, language ID: word-first backoff.

A known word scores by its per-language log frequency. A word that was never seen falls back to the longest character n-grams of
it that are known (5, then 4, 3, 2, 1 letters, with marks at the word's ends), each scored by its per-language log frequency.
A text's score for a language is the sum over its words; the language with the highest sum is predicted, and the reported score
is its share after a softmax of the sums over the square root of the number of words.

The classifier is fit on a bounded sample of the labelled rows: the ``FIT_ROWS`` different rows of each language whose hashes of id and text
together are smallest (repeated rows count once, so neither they nor missing or equal ids change how many are taken). It keeps every word and n-gram of those rows, so the model that is collected and broadcast is bounded by their texts;
prediction reads every text whole.

Defined results: a text that is null, empty or without a letter is ``und`` with score 0, and so is every text if there is no
labelled row to learn from; ties go to the language that sorts first; rows are predicted one by one, so repeated rows agree.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut

FIT_ROWS, LONGEST = 2_000, 5
#: Unseen words whose scores a task remembers.
REMEMBER = 50_000
UNDECIDED = "und"
_WORD = re.compile(r"[^\W\d_]+")


class Model:
    """Languages, and for each word and n-gram a row of log frequencies by language."""

    def __init__(self, langs: list[str], words: dict[str, int], word_rows: np.ndarray, grams: dict[str, int], gram_rows: np.ndarray):
        self.langs, self.words, self.word_rows, self.grams, self.gram_rows = langs, words, word_rows, grams, gram_rows

    def unseen(self, word: str) -> np.ndarray:
        marked, get = f"<{word}>", self.grams.get
        for n in range(min(LONGEST, len(marked)), 0, -1):
            found = [g for i in range(len(marked) - n + 1) if (g := get(marked[i : i + n])) is not None]
            if found:
                return self.gram_rows[found].mean(0)
        return np.zeros(len(self.langs), np.float32)

    def predict(self, text: str | None, memory: dict[str, np.ndarray]) -> tuple[str, float]:
        words = _WORD.findall(text.lower()) if text else []
        if not self.langs or not any(c.isalpha() for c in chain.from_iterable(words)):
            return UNDECIDED, 0.0
        total = np.zeros(len(self.langs))
        rows = list(map(self.words.get, words))
        known = [r for r in rows if r is not None]
        if known:
            total += self.word_rows[known].sum(0, dtype=np.float64)
        if len(known) < len(rows):
            for word, times in Counter(w for w, r in zip(words, rows, strict=True) if r is None).items():
                if (row := memory.get(word)) is None:
                    if len(memory) >= REMEMBER:
                        memory.clear()
                    row = memory[word] = self.unseen(word)
                total += times * row
        share = np.exp((total - total.max()) / np.sqrt(len(words)))
        best = int(np.argmax(total))
        return self.langs[best], float(share[best] / share.sum())


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> Model:
    """Learn from the rows whose text and language are not null: ``fit_rows`` of each language at most, and all of them if it has no more."""
    rows = labelled.select(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("h"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.select("lang", "h").distinct().groupBy("lang").count().collect()}  # a row for each language
    langs = sorted(sizes)
    if not langs:
        return Model([], {}, np.zeros((0, 0), np.float32), {}, np.zeros((0, 0), np.float32))
    scale = 1 << 30
    spot = F.pmod("h", F.lit(scale))

    def below(bounds: dict[str, int]) -> Column:
        return spot <= F.element_at(F.create_map(*[x for k, v in bounds.items() for x in (F.lit(k), F.lit(v))]), F.col("lang"))

    # Twice as many hashes as rows are taken, so that no more than those are ranked and none of the smallest is missed; the texts come after that.
    some = rows.where(below({k: min(scale, scale * (2 * fit_rows + 100) // n + 1) for k, n in sizes.items()})).select("lang", "h").distinct()
    nth = F.row_number().over(W.partitionBy("lang").orderBy(spot, "h"))
    last = some.withColumn("nth", nth).where(F.col("nth") <= fit_rows).groupBy("lang").agg(F.max(spot).alias("spot")).collect()  # a row for each language
    sample = rows.where(below({r["lang"]: r["spot"] for r in last})).dropDuplicates(["lang", "h"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[str, Counter] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(_WORD.findall(text.lower()))
            for lang, words in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["lang", "word", "n"])

    words = cut(sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    marked = F.concat(F.lit("<"), F.col("word"), F.lit(">"))
    units = words.select("lang", "n", F.lit(0).alias("size"), F.col("word").alias("unit"))
    for size in range(1, LONGEST + 1):
        starts = F.when(F.length(marked) >= size, F.sequence(F.lit(1), F.length(marked) - (size - 1))).otherwise(F.array().cast("array<int>"))
        grams = words.select("lang", "n", marked.alias("m"), F.explode(starts).alias("i")).select("lang", "n", F.lit(size).alias("size"), F.substring(F.col("m"), F.col("i"), F.lit(size)).alias("unit"))
        units = units.union(grams)
    counts = units.groupBy("lang", "size", "unit").agg(F.sum("n").alias("n"))
    top = counts.select("size", "unit", "lang", "n").toArrow()  # what FIT_ROWS texts of each language hold
    size, unit, lang = (top[c].combine_chunks() for c in ("size", "unit", "lang"))
    place = pc.index_in(lang, pa.array(langs)).to_numpy()

    def table(mine: np.ndarray) -> tuple[dict[str, int], np.ndarray]:
        coded = unit.filter(pa.array(mine)).dictionary_encode()
        at, sizes, n = coded.indices.to_numpy(), size.to_numpy()[mine], top["n"].to_numpy()[mine]
        out = np.zeros((len(coded.dictionary), len(langs)), np.float32)
        for k in np.unique(sizes):
            here, local = np.unique(at[sizes == k], return_inverse=True)
            counts = np.zeros((len(here), len(langs)))
            counts[local, place[mine][sizes == k]] = n[sizes == k]
            out[here] = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * len(here)))
        return {u: i for i, u in enumerate(coded.dictionary.to_pylist())}, out

    return Model(langs, *table(size.to_numpy() == 0), *table(size.to_numpy() > 0))


def predictor(spark, model: Model):
    """A function from a text column to a column struct<lang_pred string, score double>."""
    shared = spark.sparkContext.broadcast(vars(model))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, memory = Model(**shared.value), {}
        for texts in batches:
            yield pd.DataFrame([model.predict(t, memory) for t in texts], columns=["lang_pred", "score"])

    return predict


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with one more column, ``language``: struct<lang_pred, score>."""
    return docs.withColumn("language", predictor(docs.sparkSession, model)(F.col(f"`{text_col}`")))


def held_out(id_col: Column, folds: int = 5, fold: int = 0) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == fold


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose language can be told: neither ``und`` nor scored under ``least``. Columns stay as they are."""
    told = predictor(docs.sparkSession, fit(docs, id_col, text_col, lang_col))(F.col(f"`{text_col}`"))
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), told.alias("told"))
    return wide.where((F.col("told.lang_pred") != UNDECIDED) & (F.col("told.score") >= least)).select("row.*")
