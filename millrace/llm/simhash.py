"""Operator 7, SimHash near-dedup by multi-index hashing.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its word shingles. Two fingerprints link when they differ
in ``distance`` bits at most. To find the links, a fingerprint is cut into ``segments`` parts (as many as suit the number of fingerprints). Two that link agree up to
``distance // segments`` bits in one part at least (pigeonhole), so each fingerprint enumerates the Hamming ball of that radius in
each of its parts, fetches the fingerprints that have such a part from a table keyed by (part, value), and the complete distance
is verified inside that join. A pair is taken from the first part in which it agrees, so it comes once.

Only *distinct* fingerprints are compared: copies, and texts with the same fingerprint, are combined by a group-by first, so a
group of any number of copies counts as one. Links are turned into components by star contraction over fingerprints.

Defined results: null or wordless text has fingerprint zero, linked like any other; a text with fewer words than a shingle is one
shingle; rows that repeat an id keep a row each; null ids are never the name of a component unless it has no other; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, cut, shuffled, sized_join, weighed_join, wrapped
from .decontam import Tokens, binary_column, mixed, slices

SEED = 42
#: Probes that a task makes out of fingerprints.
PROBES = 1 << 20
#: Of near_texts: bands of minimum hashes and hashes in a band, differing bits of shingle fingerprints that propose a pair, members
#: compared at once.
BANDS, BAND_ROWS, CLOSE_BITS, BLOCK = 32, 6, 4, 2048


def fingerprint(text: bytes, words: int) -> int:
    """Of UTF-8 text: lower-case A-Z, words between ASCII white space, shingles of ``words`` words with repeats, majority bits."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    first, last = (ends - np.fromiter(map(len, parts), np.int64, len(parts))).tolist(), ends[words - 1 :].tolist()
    if not last:
        first, last = [0], [len(joined)]
    digest, seed = xxhash.xxh64_intdigest, SEED
    ones, n = np.zeros(64, np.int64), len(last)
    for at in range(0, n, 65536):  # bounded memory for texts of any length
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(first[at : at + 65536], last[at : at + 65536], strict=False)], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """id, fp (the 64 bits as a signed long) of each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t or b"", words) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, f"id {kind}, fp long")


def _cuts(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    edges = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _part(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def segments_for(n: int, distance: int) -> int:
    """The number of segments that lets ``n`` fingerprints do the fewest probes and comparisons: few segments are wide, so their
    balls are large and their buckets small. Never more than ``distance``, so that every part enumerates a ball."""

    def work(segments: int) -> float:
        probes = sum(comb(w, r) for _, w in _cuts(segments) for r in range(distance // segments + 1))
        return n * probes * (1 + n / 2 ** (64 // segments))

    return min(range(min(2, max(1, distance)), max(1, min(distance, 8)) + 1), key=work)


def links(fps: DataFrame, distance: int, segments: int | None = None) -> DataFrame:
    """Pairs a < b of the distinct fingerprints in column fp that differ in ``distance`` bits at most, each pair once."""
    n = fps.count()
    segments = segments or segments_for(n, distance)
    radius, places = distance // segments, _cuts(segments)
    table, probes = [], []
    for s, (low, width) in enumerate(places):
        masks = [sum(1 << i for i in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]
        table.append(F.struct(F.lit(s).alias("s"), _part(F.col("fp"), low, width).alias("v")))
        here = _part(F.col("fp"), low, width)
        probes += [F.struct(F.lit(s).alias("s"), here.bitwiseXOR(F.lit(m).cast("long")).alias("v")) for m in masks]
    # A few small rows become many: they are dealt out first, by the probes that they make.
    fps = fps.repartition(1 + n * len(probes) // PROBES, "fp")
    have = fps.select(F.col("fp").alias("b"), F.explode(F.array(*table)).alias("k")).select("b", "k.s", "k.v")
    ask = fps.select(F.col("fp").alias("a"), F.explode(F.array(*probes)).alias("k")).select("a", "k.s", "k.v")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    earlier = F.lit(False)
    for s, (low, width) in enumerate(places[:-1]):
        earlier = earlier | ((F.col("ask.s") > s) & (F.bit_count(_part(differ, low, width)) <= radius))
    met = (F.col("ask.s") == F.col("have.s")) & (F.col("ask.v") == F.col("have.v")) & (F.col("a") < F.col("b")) & (F.bit_count(differ) <= distance) & ~earlier
    return shuffled(ask.alias("ask")).join(shuffled(have.alias("have")), met).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, distance: int = 4) -> DataFrame:
    """One row for each row of ``docs``: id, fp, component_id (the smallest id that can be reached over links, itself included)."""
    rows = cut(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = cut(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")), "distinct")
    roots = components(links(distinct.select("fp"), distance)).select(F.col("node").alias("fp"), "root")
    linked = cut(distinct.join(roots, "fp", "left").select("fp", "least", "rows", F.coalesce("root", "fp").alias("root")), "roots")
    names = cut(linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("prints")), "names")
    named = cut(weighed_join(linked, names, ["root"], "prints").select("fp", "component_id", "rows"), "named")
    return weighed_join(rows, named, ["fp"], "rows").select(F.col("id").alias(id_col), "fp", "component_id")


class Sketcher:
    """Of texts: the different shingles as sorted 64-bit hashes, their 64-bit fingerprint, and BANDS hashes of BAND_ROWS minima each."""

    def __init__(self, words: int) -> None:
        self.words, self.tokens = words, Tokens()
        odd = np.uint64(0x9E3779B97F4A7C15)
        self.factors = mixed(np.arange(1, words + 1, dtype=np.uint64) * odd) | np.uint64(1)
        self.orders = mixed(np.arange(1001, 1001 + BANDS * BAND_ROWS, dtype=np.uint64) * odd) | np.uint64(1)
        self.places = mixed(np.arange(5001, 5001 + BANDS, dtype=np.uint64) * odd)

    def shingles(self, data: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
        """For each of the texts data[edges[i]:edges[i + 1]]; a text with fewer words than a shingle is one, a wordless text has none."""
        found, first = self.tokens(data, edges)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            n = max(1, b - a - self.words + 1) if b > a else 0
            shingle = np.zeros(n, np.uint64)
            for j in range(min(self.words, b - a)):
                shingle += found[a + j : a + j + n] * self.factors[j]
            out.append(np.unique(mixed(shingle)))
        return out

    @staticmethod
    def fingerprint(shingles: np.ndarray) -> int:
        """Per bit: whether over half of the shingles have it."""
        ones = np.zeros(64, np.int64)
        for at in range(0, len(shingles), 16384):
            ones += np.unpackbits(shingles[at : at + 16384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        return int(np.packbits(2 * ones > len(shingles), bitorder="little").view(np.int64)[0])

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.orders), ~np.uint64(0))
        for at in range(0, len(shingles), 1024):
            np.minimum(least, (shingles[at : at + 1024, None] * self.orders).min(0), out=least)
        return mixed((mixed(least).reshape(BANDS, BAND_ROWS) * self.orders[:BAND_ROWS]).sum(1, dtype=np.uint64) + self.places)


def _text_key(text_col: str) -> Column:
    """Tells the rows of one id, or of none, apart."""
    return F.xxhash64(F.col(f"`{text_col}`"))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """id, key, node (a hash of the different shingles), fp, bands and shingles of each row; texts are lower-cased, tokens are runs of
    letters and digits."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(words)
        for b in batches:
            data, edges = binary_column(b, 2)
            for x, y in slices(edges):
                sets = sketch.shingles(data[edges[x] : edges[y]], edges[x : y + 1] - edges[x])
                raw = [s.tobytes() for s in sets]
                bands = [sketch.bands(s) for s in sets if len(s)]
                ends = np.cumsum([0, *(BANDS * (len(s) > 0) for s in sets)])
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(x, y - x),
                    b.column(1).slice(x, y - x),
                    pa.array(np.array([xxhash.xxh64_intdigest(r, SEED) for r in raw], np.uint64).view(np.int64)),
                    pa.array([sketch.fingerprint(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(bands).view(np.int64) if bands else np.zeros(0, np.int64))),
                    pa.array(raw, pa.binary()),
                ], ["id", "key", "node", "fp", "bands", "shingles"])
        pa.default_memory_pool().release_unused()  # the worker lives on, and what its allocator keeps is no one else's

    text = F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("binary").alias("text")
    return docs.select(F.col(f"`{id_col}`").alias("id"), _text_key(text_col).alias("key"), text).mapInArrow(run, f"id {kind}, key long, node long, fp long, bands array<long>, shingles binary")


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: float) -> DataFrame:
    """id, key and root (the same number for all rows of a component) of each row.

    Texts link when the exact Jaccard similarity of their sets of shingles is ``similarity`` at least; equal sets are one node, however
    many rows have them. Two kinds of buckets propose what is compared, and propose only:

    - shingle fingerprints that links of CLOSE_BITS bits connect (``links``);
    - BANDS bands of BAND_ROWS minimum hashes of the shingles. A pair of similarity J meets in one of them with a probability of
      1 - (1 - J**6)**32: 0.99994 at 0.8, 0.9999996 at 0.85.

    Buckets with the same members count once. All members of a bucket are compared with each other, but only the links that join two
    groups are handed on. Buckets over BLOCK members are cut into blocks, and each pair of blocks is compared on its own.
    """
    rows = cut(sketches(docs, id_col, text_col, words), "sketches")
    texts = cut(rows.where(F.size("bands") > 0).select("node", "fp", "bands").distinct(), "texts")
    close = components(links(texts.select("fp").distinct(), CLOSE_BITS)).select(F.col("node").alias("fp"), "root")
    texts = sized_join(texts, cut(close, "close"), ["fp"], "left").withColumn("root", F.coalesce("root", "fp"))

    have = texts.select("node", F.explode(F.concat("bands", F.array(F.xxhash64("root")))).alias("bucket"))
    sizes = have.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("p"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("q")).where("n > 1")
    sizes = sizes.groupBy("n", "p", "q").agg(F.min("bucket").alias("bucket")).select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    have = cut(sized_join(have, cut(sizes, "buckets"), ["bucket"]), "members")
    sets = sized_join(rows.select("node", "shingles"), cut(have.select("node").distinct(), "nodes"), ["node"], "left_semi").groupBy("node").agg(F.any_value("shingles").alias("shingles"))
    mine = F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int")
    dealt = have.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "node")
    dealt = shuffled(dealt).join(shuffled(sets), "node").select("bucket", "low", "high", "node", "shingles")
    group = ["bucket", "low", "high"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]] = []

        def joined(keep_last: bool) -> pa.RecordBatch:
            nonlocal held
            key, node = (np.concatenate([h[i] for h in held]) for i in range(2))
            sets = [s for h in held for s in h[2]]
            edge = np.nonzero((key[1:] != key[:-1]).any(1))[0] + 1
            starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(key)]])
            if keep_last:
                last = int(starts[-1])
                held, starts, ends = [(key[last:], node[last:], sets[last:])], starts[:-1], ends[:-1]
            else:
                held = []
            pairs = [exact_forest(node[a:b], sets[a:b], similarity) for a, b in zip(starts.tolist(), ends.tolist(), strict=True) if b - a > 1]
            pairs = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["x", "y"])

        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy() for c in b.columns[:4]]
            data, edges = binary_column(b, 4)
            data, edges = data.view(np.uint64), (edges // 8).tolist()
            held.append((np.stack(cols[:3], 1).astype(np.int64), cols[3], [data[p:q] for p, q in zip(edges[:-1], edges[1:], strict=True)]))
            yield joined(True)
        if held:
            yield joined(False)

    found = dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(join, "x long, y long")
    roots = cut(components(cut(found.distinct(), "links"), "x", "y"), "roots")
    return cut(sized_join(rows.select("id", "key", "node"), roots, ["node"], "left").select("id", "key", F.coalesce("root", "node").alias("root")), "grouped")


def near_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row for each row of ``docs``: id, component_id (the smallest id that can be reached over links, see ``_grouped``)."""
    rows = _grouped(docs, id_col, text_col, words, similarity)
    least = cut(rows.groupBy("root").agg(F.min("id").alias("component_id")), "least")
    return sized_join(rows, least, ["root"]).select(F.col("id").alias(id_col), "component_id")


def _joined(node: np.ndarray, near: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """Links (x, y) that join members into the groups that all their links make; ``near`` tells which of some members one links with."""
    n = len(node)
    group, out = np.arange(n), []
    for i in range(n - 1):
        rest = np.nonzero(group[i + 1 :] != group[i])[0] + i + 1
        if len(rest):
            linked = near(i, rest)
            for j in linked[np.unique(group[linked], return_index=True)[1]]:
                out.append((node[i], node[j]))
                group[group == group[j]] = group[i]
    return np.array(out, np.int64).reshape(-1, 2)


def forest(node: np.ndarray, sketch: np.ndarray, bits: int) -> np.ndarray:
    """Links (x, y) within ``bits`` that join the members of a bucket into the groups that all their links make."""
    return _joined(node, lambda i, rest: rest[np.bitwise_count(sketch[rest] ^ sketch[i]).sum(1, dtype=np.int64) <= bits])


def exact_forest(node: np.ndarray, sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """As ``forest``, of sets (none empty) whose Jaccard similarity is ``similarity`` at least."""
    size = np.array([len(s) for s in sets])
    known, flat = np.unique(np.concatenate(sets), return_inverse=True)
    local = np.split(flat, np.cumsum(size)[:-1])
    mark = np.zeros(len(known), bool)

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        rest = rest[np.minimum(size[rest], size[i]) >= similarity * np.maximum(size[rest], size[i]) - 1e-9]
        if not len(rest):
            return rest
        mark[local[i]] = True
        starts = np.cumsum(size[rest]) - size[rest]
        common = np.add.reduceat(mark[np.concatenate([local[j] for j in rest])], starts, dtype=np.int64)
        mark[local[i]] = False
        return rest[common >= similarity * (size[i] + size[rest] - common) - 1e-9]

    return _joined(node, near)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component, one row with the smallest id stays, with all its columns. A null
    id comes after all others, so a component without any other keeps a row of a null id. Of rows that repeat the id and the text,
    one stays; which, is not said."""
    rows = _grouped(docs, id_col, text_col, words, similarity)
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("best")).select(F.col("best.id").alias("keep_id"), F.col("best.key").alias("keep_key"))
    twice = cut(rows.groupBy("id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "twice")
    best = best.join(twice, (F.col("key") == F.col("keep_key")) & F.col("id").eqNullSafe(F.col("keep_id")), "left")
    best = cut(best.select("keep_id", "keep_key", F.coalesce("n", F.lit(1)).alias("n")), "kept")
    rows = docs.select(wrapped(docs).alias("row"), F.col(f"`{id_col}`").alias("id"), _text_key(text_col).alias("key"))
    met = (F.col("key") == F.col("keep_key")) & F.col("id").eqNullSafe(F.col("keep_id"))
    once = rows.join(shuffled(best.where("n = 1")), met, "left_semi").select("row")
    repeated = sized_join(rows, best.where("n > 1").select(F.col("keep_key").alias("key"), F.col("keep_id")), ["key"]).where(F.col("id").eqNullSafe(F.col("keep_id")))
    return once.union(repeated.groupBy("id", "key").agg(F.any_value("row").alias("row")).select("row")).select("row.*")
