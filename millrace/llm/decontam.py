"""Operator 10, benchmark decontamination by spaced-seed hashing.

Tokens are lower-cased runs of letters and digits (any byte outside ASCII belongs to a word). Fixed masks slide over the tokens;
the hash of a window takes the positions that the mask selects and ignores the others, so a substitution at an ignored position
does not change it. Hashes of training documents are joined with those of the benchmark items. A match proposes a diagonal (the
item's place in the document), and around each proposal the two token sequences are compared: an item is found in a document if
some stretch of ``window`` aligned tokens (or the whole item, if it is shorter) agrees in ``similarity`` of them at least.

A bitmap of the benchmark's hashes, of a size fixed in advance, lets most windows of the documents go before the join, and where the
hashes are few enough to be broadcast themselves, a look-up lets go of the rest. What they let pass may have no partner, never the
other way round. What passes travels as one row for each cluster of such windows with the
tokens around it, so texts are read once and never shuffled.

Defined results: null and empty texts hold nothing; an item without tokens is never found; an item of under five
tokens is looked for as a whole, without ignored positions; rows that repeat an id and text give the same findings once; items that repeat
are each found; empty tables give no findings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, sized_join, wrapped

#: Of an item's length (LONG and more share the last): masks, 1 where the token counts, 0 where it is ignored. Slid over the item, they
#: miss none of the patterns of substitutions that SIMILARITY allows: two in 10 to WINDOW tokens, one in 5 to 9, none in fewer.
MASKS = {
    5: ("111", "1101"),
    6: ("1111", "11011"),
    7: ("11111", "111101", "110111"),
    8: ("111111", "1111011", "1101111"),
    9: ("1111111", "11111101", "11110111", "11011111"),
    10: ("1101111", "11110011", "110011011", "11110101", "10101111"),
    11: ("11110111", "110011111", "1111010011", "1101001111", "1101110101", "101111011"),
}
LONG = max(MASKS)
WINDOW, SIMILARITY = 13, 0.8
#: Tokens kept on either side of a window that passed, and the distance at which two such windows still share a row.
MARGIN = 2 * WINDOW
#: Hashes up to which they are broadcast beside the bitmap.
FEW_HASHES = 4 << 20
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Byte to byte: lower-case for ASCII letters, 0 for what separates tokens.
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 0 for c in range(256)], np.uint8)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Tokens:
    """Hashes the tokens of many texts at once. The tables of powers grow with the longest stretch that is hashed in one go."""

    BASE, STEP = 0x100000001B3, 1 << 19

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the texts data[edges[i]:edges[i + 1]]: all token hashes in order, and the first token of each text (one more at the end)."""
        data = _FOLD[data]
        word = data != 0
        first = word.copy()
        first[1:] &= ~word[:-1]
        inner = edges[(edges > 0) & (edges < len(data))]
        first[inner] = word[inner]
        last = word.copy()
        last[:-1] &= ~word[1:]
        last[inner - 1] = word[inner - 1]
        starts, ends = np.nonzero(first)[0], np.nonzero(last)[0] + 1
        out, k = np.empty(len(starts), np.uint64), 0
        while k < len(starts):
            n = max(k + 1, int(np.searchsorted(ends, starts[k] + self.STEP, "right")))
            a, b = int(starts[k]), int(ends[n - 1])
            if len(self.up) <= b - a:
                self.up, self.down = _powers(self.BASE, b - a + 1), _powers(pow(self.BASE, -1, 1 << 64), b - a + 1)
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(data[a:b].astype(np.uint64) * self.up[: b - a], out=sums[1:])
            out[k:n] = mixed((sums[ends[k:n] - a] - sums[starts[k:n] - a]) * self.down[starts[k:n] - a])
            k = n
        return out, np.searchsorted(starts, edges)


def _factors(mask: str) -> list[tuple[int, np.uint64]]:
    state, out = np.array([len(mask) * 1000003 + int(mask, 2)], np.uint64), []
    for i, c in enumerate(mask):
        state = mixed(state + _ODD)
        if c == "1":
            out.append((i, state[0] | np.uint64(1)))
    return out


def masks_of(length: int) -> tuple[str, ...]:
    """The masks for items of so many tokens. An item of under five is looked for as a whole."""
    return MASKS.get(min(length, LONG), ("1" * length,))


def seeds(tokens: np.ndarray, edges: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which the mask fits into a text, and the hashes there."""
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i, factor in _factors(mask):
        h += tokens[i : i + n] * factor
    fits = np.ones(n, bool)
    for e in range(1, len(mask)):  # a text's last windows would reach into the next text
        at = edges[1:] - e
        fits[at[(at >= 0) & (at < n)]] = False
    where = np.nonzero(fits)[0]
    return where, mixed(h[where])


def binary_column(b: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """A binary column's bytes and edges, without a copy. Null is empty."""
    col = b.column(i)
    wide = pa.types.is_large_binary(col.type)
    edges = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[edges[0] : edges[-1]] if len(edges) else data[:0], edges - edges[0]


def slices(edges: np.ndarray, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of ``most`` bytes together, or a single longer text."""
    a = 0
    while a < len(edges) - 1:
        b = max(a + 1, int(np.searchsorted(edges, edges[a] + most, "right")) - 1)
        yield a, b
        a = b


def _lowered(text_col: str):
    return F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("binary")


def _item_tokens(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item, tokens of each benchmark row that has tokens; n the number of tokens; key a number of the row that is never null."""
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for b in batches:
            found, first = tokens(*binary_column(b, 1))
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(found.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), lists, pa.array(np.diff(first), pa.int32())], ["item", "tokens", "n"])

    return items.select(F.col(id_col).alias("item"), _lowered(text_col).alias("text")).mapInArrow(run, f"item {kind}, tokens array<long>, n int").where("n > 0").distinct().withColumn("key", F.xxhash64("item", "tokens"))


def _item_seeds(items: DataFrame) -> DataFrame:
    """hash, key, at (position in the item) for every window of every mask that an item's length allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, tokens in enumerate(b.column(1).to_pylist()):
                t = np.array(tokens, np.int64).view(np.uint64)
                for mask in masks_of(len(t)):
                    at, h = seeds(t, np.array([0, len(t)]), mask)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(h), b.column(0)[i].as_py()), pa.int64()), pa.array(at, pa.int32())], ["hash", "key", "at"])

    return items.select("key", "tokens").mapInArrow(run, "hash long, key long, at int")


def _filter(hashes: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray | None]:
    """A bitmap of 2**20 to 2**26 slots (64 for each of ``n`` hashes within those bounds), and the sorted hashes if they are few.
    Of more hashes, the bitmap is made by Spark and collected in pieces of 8 KB."""
    slots = 1 << min(26, max(20, (64 * n).bit_length()))
    out = np.zeros(slots, bool)
    if n <= FEW_HASHES:
        few = np.unique(hashes.toArrow()["hash"].to_numpy().view(np.uint64))
        out[(few & np.uint64(slots - 1)).astype(np.int64)] = True
        return out, few

    def pack(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << 16, bool)
        bits[table.column("low").to_numpy()] = True
        return pa.table({"piece": pa.array([table.column("piece")[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    slot = F.col("hash").bitwiseAND(F.lit(slots - 1).cast("long"))
    pieces = hashes.select(slot.alias("slot")).distinct().select(F.shiftright("slot", 16).cast("int").alias("piece"), (F.col("slot") % 65536).cast("int").alias("low"))
    for r in pieces.groupBy("piece").applyInArrow(pack, "piece int, bits binary").collect():
        out[r["piece"] << 16 : (r["piece"] + 1) << 16] = np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool)
    return out, None


def _clusters(docs: DataFrame, id_col: str, text_col: str, masks: list[str], known: tuple[np.ndarray, np.ndarray | None]) -> DataFrame:
    """doc, base (position of the first kept token), tokens, at and hash (arrays: the windows that the bitmap lets pass)."""
    kind, shared = docs.schema[id_col].dataType.simpleString(), docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not masks:  # no item has a token
            return
        tokens, (bits, few) = Tokens(), shared.value
        slot = np.uint64(len(bits) - 1)
        for b in batches:
            data, edges = binary_column(b, 1)
            for x, y in slices(edges):
                found, first = tokens(data[edges[x] : edges[y]], edges[x : y + 1] - edges[x])
                at, hashes = [], []
                for mask in masks:
                    where, h = seeds(found, first, mask)
                    ok = np.nonzero(bits[(h & slot).astype(np.int64)])[0]
                    if few is not None and len(ok):
                        ok = ok[few[np.minimum(np.searchsorted(few, h[ok]), len(few) - 1)] == h[ok]]
                    at.append(where[ok])
                    hashes.append(h[ok])
                at, hashes = np.concatenate(at), np.concatenate(hashes)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, hashes = at[order], hashes[order]
                doc = np.searchsorted(first, at, "right") - 1
                opens = np.nonzero(np.diff(at, prepend=at[0]) > MARGIN)[0]
                opens = np.union1d(np.union1d(opens, np.nonzero(np.diff(doc, prepend=doc[0]))[0]), [0])
                closes = np.append(opens[1:], len(at))
                base = np.maximum(at[opens] - MARGIN, first[doc[opens]])
                end = np.minimum(at[closes - 1] + MARGIN + max(map(len, masks)), first[doc[opens] + 1])
                kept = np.concatenate([found[p:q] for p, q in zip(base, end, strict=True)])
                size = np.diff(np.append(opens, len(at)))
                inside = at - np.repeat(first[doc[opens]], size)
                cuts = pa.array(np.append(opens, len(at)), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(x + doc[opens])),
                    pa.array(base - first[doc[opens]], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(end - base)]), pa.int32()), pa.array(kept.view(np.int64))),
                    pa.ListArray.from_arrays(cuts, pa.array(inside, pa.int64())),
                    pa.ListArray.from_arrays(cuts, pa.array(hashes.view(np.int64))),
                ], ["doc", "base", "tokens", "at", "hash"])

    return docs.select(F.col(f"`{id_col}`").alias("doc"), _lowered(text_col).alias("text")).mapInArrow(run, f"doc {kind}, base long, tokens array<long>, at array<long>, hash array<long>")


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, window: int) -> tuple[int, int, int]:
    """Of the item laid over the document's tokens at ``shift``: most agreeing tokens in a stretch of ``window``, its start in the
    item, and its length."""
    a, b = max(0, -shift), min(len(item), len(doc) - shift)
    width = min(window, len(item))
    if b - a < width:
        return 0, a, width
    same = np.concatenate([[0], np.cumsum(item[a:b] == doc[a + shift : b + shift])])
    counts = same[width:] - same[:-width]
    best = int(np.argmax(counts))
    return int(counts[best]), a + best, width


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each document and item found in it: doc, item, matched and width (tokens of the best stretch), doc_start and
    item_start (where it begins, in tokens)."""
    bench = cut(_item_tokens(items, item_col, item_text_col), "items")
    known = cut(_item_seeds(bench), "seeds")
    lengths = sorted(r["n"] for r in bench.select(F.least("n", F.lit(LONG)).alias("n")).distinct().collect())
    masks = list(dict.fromkeys(m for n in lengths for m in masks_of(n)))
    n = known.count()
    spots = _clusters(docs, id_col, text_col, masks, _filter(known.select("hash"), n)).distinct()
    spots = cut(spots.withColumn("spot", F.xxhash64("doc", "base", "tokens")), "spots")
    asked = spots.select("doc", "base", "spot", F.explode(F.arrays_zip("at", "hash")).alias("w")).select("doc", "base", "spot", F.col("w.at").alias("doc_at"), F.col("w.hash").alias("hash"))
    met = sized_join(asked, known, ["hash"], rows=n).select("doc", "base", "spot", "key", (F.col("doc_at") - F.col("at") - F.col("base")).alias("shift")).distinct()
    # Ids may be null, so they are compared as such; the numbers beside them are not.
    same = (F.col("m.spot") == F.col("s.spot")) & (F.col("m.base") == F.col("s.base")) & F.col("m.doc").eqNullSafe(F.col("s.doc"))
    laid = met.alias("m").join(spots.alias("s"), same).select("m.doc", "m.base", "m.key", "m.shift", "s.tokens")
    laid = sized_join(laid, bench.select("key", "item", F.col("tokens").alias("wanted")), ["key"])
    kinds = {c: laid.schema[c].dataType.simpleString() for c in ("doc", "item")}

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [overlap(np.array(t), np.array(w), s, window) for t, w, s in zip(b["tokens"].to_pylist(), b["wanted"].to_pylist(), b["shift"].to_pylist(), strict=True)]
            matched, start, width = (pa.array([r[i] for r in rows], pa.int32()) for i in range(3))
            yield pa.RecordBatch.from_arrays([b["doc"], b["item"], b["base"], b["shift"], matched, start, width], ["doc", "item", "base", "shift", "matched", "item_start", "width"])

    checked = laid.select("doc", "item", "base", "shift", "tokens", "wanted").mapInArrow(verify, f"doc {kinds['doc']}, item {kinds['item']}, base long, shift long, matched int, item_start int, width int")
    good = checked.where(F.col("matched") >= F.ceil(F.lit(similarity) * F.col("width") - 1e-9))
    good = good.select("doc", "item", "matched", "width", (F.col("base") + F.col("shift") + F.col("item_start")).alias("doc_start"), "item_start")
    best = F.struct((F.col("matched") / F.col("width")).alias("share"), (-F.col("doc_start")).alias("early"), (-F.col("item_start")).alias("first"))
    return good.groupBy("doc", "item").agg(F.max_by(F.struct("matched", "width", "doc_start", "item_start"), best).alias("x")).select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "x.*")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found. Each row is judged by its own text, also where ids repeat or are null."""
    key = F.struct(F.col(f"`{id_col}`").cast("string").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("text"))
    named = docs.select(key.alias("__doc"), F.col(f"`{text_col}`").alias("__text"))
    bad = cut(contaminated(named, items, "__doc", "__text", item_col, item_text_col).select(F.col("__doc").alias("key")).distinct(), "leaks")
    text = F.concat(F.col("key.text").cast("string"), F.lit(":"), F.coalesce(F.concat(F.lit("="), "key.id"), F.lit("")))
    keyed = docs.select(wrapped(docs).alias("row"), key.alias("key")).select("row", text.alias("key"))
    return sized_join(keyed, bad.select(text.alias("key")), ["key"], "left_anti").select("row.*")
