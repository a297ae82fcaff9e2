"""A corpus pipeline from five operators: language ID, exact dedup, SimHash near-dedup, benchmark decontamination, SentencePiece.

Each stage takes the session, the rows that its predecessor kept and the folder of the tables, and returns a DataFrame that is
written and read again as the next one's input. All but the last keep the columns of documents. Each stage is decided on its own
input alone: the classifier of the first learns from its labelled rows, and the fourth reads the table ``benchmark``.

Defined results: an empty table gives no rows; columns besides doc_id, text and lang are carried along untouched, whatever their
names; rows that repeat are copies of each other, so one of them stays.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontam, exact_dedup, langid, pieces, simhash
from millrace.llm.common import cut, read_table

#: Words of a shingle, and the similarity of shingles from which texts are near copies.
SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Bytes of rows that go to a Python worker at once. Spark's own 64 MB are there several times over: in the JVM, which doubles its buffers as it
#: writes them, and in the worker, as bytes, as strings and in lower case; neither gives all of that back to the machine.
BATCH_BYTES = 4 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage with the session's Arrow batches held to BATCH_BYTES. The setting stays, since Spark reads it as the stage's rows are written."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go, and those whose language is told with a score under 0.3. A null or empty text has no letter."""
    return langid.keep_identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id stays; a null id comes after all others."""
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, one row with the smallest doc_id stays; a null id comes after all others. Wordless texts are one group."""
    return simhash.keep_one(docs, words=SHINGLE_WORDS, similarity=SIMILARITY)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold a benchmark item go; each row is judged by its own text, whatever its id."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and scores of the best three segmentations, and whether decoding gives the text."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("language_id", language_id), ("exact_copies", exact_copies), ("near_copies", near_copies), ("benchmark_leaks", benchmark_leaks), ("sentencepiece", encode)]
STAGES = [(name, in_small_batches(stage)) for name, stage in STAGES]

#: The language classifier, the fingerprints and the N-best search are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through all stages, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
