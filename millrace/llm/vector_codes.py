"""Operator 12, vector code compression: product codes whose entries are found through segment-mean lower bounds.

Components become integers, vectors are cut into ``parts`` equal consecutive parts, and each part is coded by the nearest of its
codebook's entries. Entries are filtered from coarse to fine before any distance is worked out: a part is cut into one block, then two,
four and so on, and for each block of n components the squared distance is at least ``n * (difference of means)^2 + (difference of
residual norms)^2``, a residual norm being that of the components less their mean. The entry with the smallest coarsest bound is
measured first; whoever's bound is above that distance goes, at each level. Bounds are lessened by SLACK of the squared norms, far more
than rounding can add, and equal bounds stay, so no nearest entry is lost. Only survivors get exact integer distances; ties go to the lower index.

Codebooks are fit by rounds of assignment and componentwise floor means. In each round every task adds up its own vectors and
hands on ``parts * entries`` rows of sums, so what meets on the driver, the codebooks, has 16 numbers for each dimension, whatever the table.

Defined results: vectors that are null or hold a null or non-finite component are dropped, as are empty ones and those whose length is
not that of the first kept one (by id, null ids last, then by components); lengths that ``parts`` does not divide are filled up with zeros.
Integers beyond MOST in magnitude become MOST, which keeps squares and sums of squares in 64 bits. Fewer vectors than entries give
fewer entries. Repeated rows and ids are coded one by one, and an empty table has no codes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, sized_join

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
MOST, SLACK = 1 << 26, 1e-9


class Bounds:
    """The entries of one part's codebook, int64 of shape (entries, width), with their block means and residual norms by level."""

    def __init__(self, entries: np.ndarray):
        self.entries, width = entries, entries.shape[1]
        counts = [1 << k for k in range(max(width, 1).bit_length()) if 2 << k <= width] or [1]
        self.cuts = [np.arange(n) * width // n for n in counts]
        self.levels = [self.profile(entries, c) for c in self.cuts]
        self.squares = (entries * entries).sum(1)
        self.measured = 0

    @staticmethod
    def profile(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Components, mean and residual norm of each block; n * sum of squares - sum^2 is exact in int64."""
        n = np.diff(np.append(starts, x.shape[1]))
        s, q = np.add.reduceat(x, starts, 1), np.add.reduceat(x * x, starts, 1)
        return n, s / n, np.sqrt((n * q - s * s) / n)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, and its squared distance, for each row of ``x`` (int64)."""
        squares = (x * x).sum(1)
        n, mean, norm = self.profile(x, self.cuts[0])
        _, means, norms = self.levels[0]
        low = n[0] * (mean - means.T) ** 2 + (norm - norms.T) ** 2 - SLACK * (squares[:, None] + self.squares)
        best = ((x - self.entries[low.argmin(1)]) ** 2).sum(1)
        rows, entries = np.nonzero(low <= best[:, None])
        for starts, (n, means, norms) in zip(self.cuts[1:], self.levels[1:], strict=True):
            _, mean, norm = self.profile(x, starts)
            low = (n * (mean[rows] - means[entries]) ** 2 + (norm[rows] - norms[entries]) ** 2).sum(1) - SLACK * (squares[rows] + self.squares[entries])
            stay = low <= best[rows]
            rows, entries = rows[stay], entries[stay]
        exact = ((x[rows] - self.entries[entries]) ** 2).sum(1)
        self.measured += len(exact)
        first = np.flatnonzero(np.diff(rows, prepend=-1))  # every row has a survivor: the one that was measured first
        least = np.minimum.reduceat(exact, first) if len(first) else exact
        at = np.flatnonzero(exact == least[rows])
        at = at[np.flatnonzero(np.diff(rows[at], prepend=-1))]
        return entries[at], exact[at]


def _integers(vec: Column, parts: int) -> Column:
    whole = F.transform(vec, lambda x: F.floor(F.least(F.greatest(x.cast("double") * SCALE, F.lit(-float(MOST))), F.lit(float(MOST)))).cast("long"))
    return F.concat(whole, F.array_repeat(F.lit(0).cast("long"), F.pmod(-F.size(vec), F.lit(parts))))


def kept(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS) -> DataFrame:
    """id, label and v, the integers of each vector that can be coded; written to the shared folder, since every round reads them."""
    vec = F.col(f"`{vec_col}`")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size(vec) > 0)
    rows = df.where(finite).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.size(vec).alias("size"), _integers(vec, parts).alias("v"))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").select("size").first()
    return cut(rows.where(F.col("size") == (first[0] if first else 0)).drop("size"), "vectors")


def _blocks(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Each batch with its vectors, cut into parts."""
    for b in batches:
        if b.num_rows:
            flat = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(books), -1)
            yield b, [np.ascontiguousarray(flat[:, p]) for p in range(len(books))]


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks, one array (entries, width) for each part, of what ``kept`` returned; an empty table has none."""
    seeds = [r[0] for r in vectors.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(entries).collect()]
    if not seeds:
        return []
    start = np.array(seeds, np.int64).reshape(len(seeds), parts, -1)
    books = [np.ascontiguousarray(start[:, p]) for p in range(parts)]
    for _ in range(rounds):

        def add(batches: Iterator[pa.RecordBatch], books: list[np.ndarray] = books) -> Iterator[pa.RecordBatch]:
            bounds, sums, counts = [Bounds(b) for b in books], [np.zeros_like(b) for b in books], [np.zeros(len(b), np.int64) for b in books]
            for _, xs in _blocks(batches, books):
                for p, x in enumerate(xs):
                    nearest, _ = bounds[p].nearest(x)
                    np.add.at(sums[p], nearest, x)
                    counts[p] += np.bincount(nearest, minlength=len(counts[p]))
            rows = [(p, e, i, s, int(counts[p][e])) for p, of in enumerate(sums) for e in np.flatnonzero(counts[p]).tolist() for i, s in enumerate(of[e].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 5)], ["part", "entry", "place", "s", "n"])

        added = vectors.select("v").mapInArrow(add, "part long, entry long, place long, s long, n long")
        means = added.groupBy("part", "entry", "place").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()  # one row for each number of the codebooks
        books = [b.copy() for b in books]
        for r in means:
            books[r.part][r.entry, r.place] = r.s // r.n
    return books


def encode(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """id, label, code (binary, a byte for each part) and error (squared distance to the coded vector) of what ``kept`` returned."""
    schema = vectors.select("id", "label")
    out = pa.schema([("code", pa.binary()), ("error", pa.int64())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = [Bounds(b) for b in books]
        for b, xs in _blocks(batches, books):
            found = [of.nearest(x) for of, x in zip(bounds, xs, strict=True)]
            codes = np.stack([f[0] for f in found], 1).astype(np.uint8)
            arrays = [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(sum(f[1] for f in found))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), *arrays], ["id", "label", *out.names])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.schema)
    return vectors.mapInArrow(code, f"{kinds}, code binary, error long")


def decode(codes: DataFrame, books: list[np.ndarray], code_col: str = "code") -> DataFrame:
    """``codes`` with one more column, ``decoded``: the vector that each code stands for, in the units of the input."""
    table = F.lit([[[v / SCALE for v in e] for e in b.tolist()] for b in books])
    byte = lambda p: F.conv(F.hex(F.substring(F.col(f"`{code_col}`"), p + 1, 1)), 16, 10).cast("int")
    return codes.withColumn("decoded", F.concat(*[table[p][byte(p)] for p in range(len(books))]))


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all integers of the codebooks, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def compressed(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per kept vector: id, code (hex), error, label_error (errors summed over equal labels, nulls together), codebooks_sha256.

    Errors are summed by label with map-side combining and joined back to the rows by ``sized_join``, so a hot label stays spread out.
    """
    vectors = kept(df, id_col, vec_col, label_col)
    books = fit(vectors)
    codes = cut(encode(vectors, books), "codes").withColumns({"key": F.coalesce(F.col("label").cast("string"), F.lit("")), "none": F.col("label").isNull()})
    sums = codes.groupBy("key", "none").agg(F.sum("error").alias("label_error"))
    found = sized_join(codes, sums, ["key", "none"])
    return found.select(F.col("id").alias(id_col), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
