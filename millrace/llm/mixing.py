"""Operator 3, LM scoring by online logistic context mixing.

What is coded. A text is its words in lower case, one space between them and a line end after the last; an empty text is the line
end alone. Every byte of it is coded bit by bit, words that training knows included.

Bit predictors. The contexts of a byte are hashed: the 3 and the 6 bytes before it, across word ends, and the word so far (its last
eight bytes). A context and the bits coded so far pick a row of four counts, one for each value of the next two bits, and the counts on either side of a bit predict it. Spark sums the counts over all
training texts; the number of rows follows the fourth root of the training bytes, so the tables grow with the input and still fit
into a worker (some 80 MB at 0.5 GB of text, 1.7 GB at 100 TB). They are written to the shared folder and read there, never collected.

Fitting. What all predictors see of a byte is the word or the six bytes before it, and a text has the same again and again. So each task sorts the
training bytes by that, PART at a time, and writes the different ones with their numbers to the shared folder (some 0.9 bytes a byte of text); counts,
weights and map are sums over those, equal to sums over every byte of every training text. They are deleted when the model is fitted.

Mixing. The stretched predictions are added up with weights that the bit's place in the byte and the number of longer contexts seen
before select (gates). The weights that a text begins with are a logistic regression (Newton steps on sums over all training texts, each
half of them against counts of the other half, so that no text meets its own counts), and move online: after each TURN
bytes, along the text's coding errors. An adaptive map of the mixed prediction by bit place then refines it; it begins with
the counts of all training texts, by the first weights and found likewise, and goes on with the text's own.

Base. Documents are cut into blocks of bounded size, and each block into its different words and their places. Counts are summed by
word and go back to the blocks that hold the word: those of the FREQUENT words that most blocks hold by broadcast, the others
by a join, one row for each block and word.

Nothing depends on how rows are partitioned: counts are whole numbers, sums of the regression are rounded, and a text's state is its own.

Defined results: null text is empty; null ids count as the empty text for the fold; rows that repeat are scored alike; without
training rows no token is known, base scores are 0 and every bit is even until the text moves the weights and the map; an
empty table gives no rows; a text of any length is coded in pieces of bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, new_folder

#: Text of a block in bytes (or one longer document).
BLOCK_BYTES = 8 << 20
#: Words that are broadcast with their counts, and their longest in bytes: those that most blocks hold. The others travel.
FREQUENT, FREQUENT_BYTES = 1 << 18, 64
#: Rows of each predictor's table, times ROWS times the fourth root of the training bytes: last 3 and 6 bytes, word.
SHARES, ROWS = (2, 16, 16), 2048
P = len(SHARES)
#: Predictors whose having been seen makes the gate, bytes that contexts look back at most, and counts in a page of the tables.
LONGER, PAD, PAGE = (1, 2), 8, 1 << 16
GATES = len(LONGER) + 1
#: Prior of a count, and steps of a stretched prediction in a table.
PRIOR, SCALE = 0.4, 16.0
#: Folds of the training texts, each of which fits the first weights against the others; Newton steps, and ridge.
FOLDS, NEWTON, RIDGE = 2, 2, 1.0
#: Bytes between two updates of a text's weights, and their rate.
TURN, RATE = 1024, 0.02
#: Bytes that are looked up, counted or fitted at once, different ones in a row that is written, and bytes of which those alike are put together;
#: texts that are coded side by side and their bytes (or those of a piece of a longer text).
PIECE, STEP, PART, LANES, GROUP = 1 << 13, 1 << 14, 1 << 22, 32, 1 << 20
#: Bytes of rows that go to a Python worker at once: Spark's own 64 MB are there several times over, in the JVM and in the worker.
BATCH_BYTES = 4 << 20
#: Steps of the adaptive map, and the weight of what it begins with.
STEPS, FIRM = 24, 40.0
CELLS = 8 * STEPS
CODEC = "zstd"
_CELLS = ["back", "inside", "symbol", "times"]
LN10 = np.log(10.0)
_BIT = (np.arange(256)[:, None] >> np.arange(7, -1, -1) & 1).astype(np.float32)
_TOP = np.array([0, *((2**64 - 1) << (64 - 8 * m) & (2**64 - 1) for m in range(1, 9))], np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0x8EBC6AF09C88C6E3, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_MIX = np.uint64(0x589965CC75374CC3)
_SPREAD = np.uint32(0x9E3779B1)
#: For each of a byte's four steps and each byte: a number for the bits before the step.
_WAYS = np.array([[(1 << 2 * i | c >> 8 - 2 * i) * 0x85EBCA6B % 2**32 for c in range(256)] for i in range(4)], np.uint32)
_QUARTERS = np.arange(256)[:, None] >> np.array([6, 4, 2, 0]) & 3


def held_out(id_col: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == fold


def sizes_of(train_bytes: int) -> np.ndarray:
    """Rows of each predictor's table, a power of two."""
    return np.array([1 << max(6, round(np.log2(max(1.0, s * ROWS * train_bytes**0.25)))) for s in SHARES], np.int64)


def normal(text: bytes | None) -> bytes:
    """What is coded of a text."""
    return b" ".join(text.lower().split()) + b"\n" if text else b"\n"


class Scratch:
    """Arrays by name that are used again: touching fresh memory for each step costs more than the step."""

    def __init__(self):
        self.held = {}

    def __call__(self, name: str, rows: int, width: int, kind: type) -> np.ndarray:
        """An array (rows, width) of any content."""
        if name not in self.held or len(self.held[name]) < rows:
            self.held[name] = np.empty((rows, width), kind)
        return self.held[name][:rows]


def walked(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """PIECE of the ascending places ``at`` by PIECE: which they are, their part of data, and they in it."""
    for i in range(0, len(at), PIECE):
        some, first = at[i : i + PIECE], int(at[i]) - PAD
        yield slice(i, i + PIECE), data[first : some[-1] + 1], some - first


def before(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the bytes data[at], the eight bytes before (the last one highest), and how many of them belong to its word."""
    back = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))[at - 8]
    ends = np.maximum.accumulate(np.where(data <= 32, np.arange(len(data), dtype=np.int32), np.int32(-1)))  # -1: no space in sight
    return back, np.minimum(at - 1 - np.take(ends, at - 1), 8)


def places(back: np.ndarray, inside: np.ndarray, symbol: np.ndarray, sizes: np.ndarray, scratch: Scratch | None = None) -> Iterator[np.ndarray]:
    """``entries`` of bytes by what ``before`` gives of them. ``back`` may be cut to the six bytes or the word that contexts see."""
    word = back & np.take(_TOP, inside)
    ways, quarters, first = np.take(_WAYS, symbol, 1), np.take(_QUARTERS, symbol, 0), 0
    out = (scratch or Scratch())("entries", len(back), 4, np.int64)
    for k, key in enumerate((back >> np.uint64(40), back >> np.uint64(16), word)):
        h = ((key + np.uint64(k + 1)) * _ODD[k] >> np.uint64(32)).astype(np.uint32)
        for i in range(4):
            row = h ^ ways[i]
            row *= _SPREAD
            row >>= np.uint32(33 - int(sizes[k]).bit_length())
            out[:, i] = row
        out += first
        out *= 4
        out += quarters
        first += int(sizes[k])
        yield out


def entries(data: np.ndarray, at: np.ndarray, sizes: np.ndarray, scratch: Scratch | None = None) -> Iterator[np.ndarray]:
    """For each predictor, the four counts (of two bits each) that coding each of the bytes data[at] meets: an array (len(at), 4), the
    same one for all predictors.

    PAD bytes must stand before each of them: those of its text, or zeros before it. A word of over eight bytes counts with its last eight."""
    return places(*before(data, at), data[at], sizes, scratch)


class Seen:
    """Different bytes with what all predictors see before them: ``back`` and ``inside`` as of ``before``, ``symbol``, and ``times``, how often."""

    def __init__(self, back: np.ndarray, inside: np.ndarray, symbol: np.ndarray, times: np.ndarray):
        self.back, self.inside, self.symbol, self.times = back, inside, symbol, times

    @classmethod
    def of(cls, data: np.ndarray, at: np.ndarray) -> Seen:
        """Of the bytes data[at], PART at most. They are sorted by the last three bytes before them and some bits of a hash; only neighbours that agree
        in whole are put together, so a clash costs a row, never a count."""
        back, inside = before(data, at)
        back &= np.take(_TOP, np.maximum(inside, 6))
        symbol, bits = data[at], np.uint64((PART - 1).bit_length())
        packed = (back ^ back >> np.uint64(29)) * _ODD[3]
        packed += symbol * _ODD[4]
        packed ^= packed >> np.uint64(32)
        packed *= _MIX
        packed >>= np.uint64(24)
        packed |= back & _TOP[3]
        packed &= ~(np.uint64(1) << bits) + np.uint64(1)
        packed |= np.arange(len(at), dtype=np.uint64)
        packed.sort()
        packed &= (np.uint64(1) << bits) - np.uint64(1)
        order = packed.view(np.int64)
        back, symbol = np.take(back, order), np.take(symbol, order)
        new = np.concatenate([[0], np.nonzero((back[1:] != back[:-1]) | (symbol[1:] != symbol[:-1]))[0] + 1])
        return cls(back[new], inside[order[new]].astype(np.uint8), symbol[new], np.diff(np.append(new, len(order))).astype(np.uint32))

    @classmethod
    def read(cls, row: tuple[bytes, bytes, bytes, bytes]) -> Seen:
        planes, *rest = (np.frombuffer(x, kind) for x, kind in zip(row, (np.uint8, np.uint8, np.uint8, "<u4"), strict=True))
        return cls(np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel(), *rest)

    def row(self) -> list[bytes]:
        """As four cells: the bytes of ``back`` place by place (they pack well), and the others."""
        return [np.ascontiguousarray(self.back.view(np.uint8).reshape(-1, 8).T).tobytes(), self.inside.tobytes(), self.symbol.tobytes(), self.times.tobytes()]

    def parts(self, most: int) -> Iterator[Seen]:
        for i in range(0, len(self.back), most):
            yield Seen(*(x[i : i + most] for x in (self.back, self.inside, self.symbol, self.times)))


def stretched(counts: np.ndarray) -> np.ndarray:
    """Of rows of 4 counts: for each value, the two stretched predictions of a one on the way to it, as two int8 in an uint16."""
    tree = counts.reshape(-1, 4).astype(np.float32)
    out = np.zeros((len(tree), 4, 2), np.int8)
    for depth in range(2):
        sides = tree.reshape(len(tree), 1 << depth, 2, -1).sum(3)
        x = np.log((sides[:, :, 1] + PRIOR) / (sides[:, :, 0] + PRIOR))
        out[:, :, depth] = np.repeat(np.clip(np.rint(x * SCALE), -127, 127).astype(np.int8), 4 >> depth, 1)
    return out.reshape(-1, 2).view(np.uint16).ravel()


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other with zeros before each, and where each begins."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + PAD
    return np.frombuffer(b"".join(x for t in texts for x in (bytes(PAD), t)), np.uint8), np.cumsum(sizes) - sizes + PAD


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... as many as counts[i] says, for each i."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def cells(total: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The steps of the adaptive map that stretched mixes fall into; ``total`` is used up."""
    total += np.float32(12)
    total *= np.float32(STEPS / 24)
    np.copyto(out, total, casting="unsafe")
    return out


class Model:
    """Tables of stretched predictions, first weights (predictor, gate, bit) and first counts of the adaptive map."""

    def __init__(self, sizes: np.ndarray, table: np.ndarray, weights: np.ndarray | None = None, uses: np.ndarray | None = None, ones: np.ndarray | None = None):
        self.sizes, self.table, self.scratch = sizes, table, Scratch()
        self.weights = np.full((P, GATES, 8), 1.0 / P, np.float32) if weights is None else weights.astype(np.float32)
        even = np.tile(1 / (1 + np.exp(-((np.arange(STEPS) + 0.5) * 24 / STEPS - 12))), 8)  # a map that changes nothing
        self.first = even.astype(np.float32) if uses is None else ((ones + FIRM * even) / (uses + FIRM)).astype(np.float32)

    def predictions(self, data: np.ndarray, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Each predictor's stretched predictions (int8 of len(at), 8), and the gates, for ascending places ``at``. The next call
        overwrites them."""
        return self._looked_up(len(at), ((i, entries(part, some, self.sizes, self.scratch)) for i, part, some in walked(data, at)))

    def predictions_of(self, seen: Seen) -> tuple[list[np.ndarray], np.ndarray]:
        """Likewise for different bytes."""
        parts = enumerate(seen.parts(PIECE))
        return self._looked_up(len(seen.back), ((slice(i * PIECE, i * PIECE + PIECE), places(x.back, x.inside, x.symbol, self.sizes, self.scratch)) for i, x in parts))

    def _looked_up(self, n: int, found: Iterator[tuple[slice, Iterator[np.ndarray]]]) -> tuple[list[np.ndarray], np.ndarray]:
        inputs, gate = [self.scratch(f"inputs{k}", n, 4, np.uint16) for k in range(P)], np.zeros(n, np.uint8)
        for i, each in found:
            for k, e in enumerate(each):
                np.take(self.table, e, out=inputs[k][i], mode="clip")
        inputs = [x.view(np.int8) for x in inputs]
        for k in LONGER:
            gate += inputs[k][:, 0] != 0
        return inputs, gate

    def mixed(self, inputs: list[np.ndarray], weights: list[np.ndarray], key: np.ndarray) -> np.ndarray:
        """The stretched mix of inputs, each row with the weights[...][key] of its own."""
        total, more = self.scratch("total", len(key), 8, np.float32), self.scratch("more", len(key), 8, np.float32)
        for k, (x, w) in enumerate(zip(inputs, weights, strict=True)):
            into = more if k else total
            np.take(w, key, 0, out=into, mode="clip")
            into *= x
            if k:
                total += more
        total *= np.float32(1 / SCALE)
        return np.clip(total, -11.5, 11.5, out=total)

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Natural logarithm of the probability of each of some texts as ``normal`` gives them, and the map's counts (uses, ones) by cell."""
        out, counted, order, a = np.zeros(len(texts)), np.zeros((2, CELLS)), sorted(range(len(texts)), key=lambda i: -len(texts[i])), 0
        while a < len(order):
            b, size = a, 0
            while b < len(order) and b - a < LANES and (b == a or size + len(texts[order[b]]) <= GROUP):
                size += len(texts[order[b]])
                b += 1
            state = State(self, b - a)
            if b - a == 1:
                text = texts[order[a]]
                for i in range(0, len(text), GROUP):  # a long text in pieces, each after the bytes before it
                    piece = np.frombuffer((bytes(PAD) + text[:GROUP] if not i else text[i - PAD : i + GROUP]), np.uint8)
                    out[order[a]] += state.code(piece, np.array([PAD]), np.array([len(piece) - PAD]))[0]
            else:
                some = [texts[i] for i in order[a:b]]
                out[order[a:b]] = state.code(*laid_out(some), np.fromiter(map(len, some), np.int64, len(some)))
            counted += [state.uses.sum(0, dtype=np.float64), state.ones.sum(0, dtype=np.float64)]
            a = b
        return out, counted


class State:
    """The moving weights and maps of some texts."""

    def __init__(self, model: Model, texts: int):
        self.model = model
        self.weights = [np.tile(w, (texts, 1)) for w in model.weights]  # (texts * GATES, 8) each
        self.uses, self.ones = np.zeros((texts, CELLS), np.float32), np.zeros((texts, CELLS), np.float32)

    def code(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Logarithms of the probabilities of the texts data[starts:starts + sizes], longest first."""
        model, out = self.model, np.zeros(len(starts))
        at = spread(starts, sizes)
        inputs, gate = model.predictions(data, at)
        symbol, begin = data[at], np.cumsum(sizes) - sizes
        corner = np.arange(len(starts))[:, None] * CELLS + np.arange(8) * STEPS  # of each text's map
        for t in range(0, int(sizes[0]), TURN):
            live = int(np.searchsorted(-sizes, -t))  # the texts longer than t
            counts = np.minimum(sizes[:live] - t, TURN)
            rows, text = spread(begin[:live] + t, counts), np.repeat(np.arange(live), counts)
            key = (text * GATES + np.take(gate, rows)).astype(np.uint16)
            order = np.argsort(key, kind="stable")  # by text, as before, and in it by gate
            rows, key = np.take(rows, order), np.take(key, order)
            x = [model.scratch(f"x{k}", len(rows), 8, np.float32) for k in range(P)]
            for i, v in zip(inputs, x, strict=True):
                v[:] = np.take(i, rows, 0)
            total = model.mixed(x, self.weights, key)
            p, bit, q = (model.scratch(name, len(rows), 8, np.float32) for name in ("p", "bit", "q"))
            np.take(_BIT, np.take(symbol, rows), 0, out=bit, mode="clip")
            np.exp(np.negative(total, out=p), out=p)
            p += np.float32(1)
            np.reciprocal(p, out=p)
            cell, own = model.scratch("cell", len(rows), 8, np.int64), model.scratch("own", len(rows), 8, np.int64)
            cells(total, cell)
            cell += np.take(corner, text, 0, out=own, mode="clip")
            uses, ones = self.uses[:live], self.ones[:live]
            refined = (ones + FIRM * model.first) / (uses + FIRM)
            np.take(refined, cell, out=q, mode="clip")
            q += p
            q *= np.float32(0.5)
            miss = np.subtract(bit, p, out=p)
            q -= np.subtract(np.float32(1), bit, out=total)
            q = np.abs(q, out=q).ravel()
            q = q[::2] * q[1::2]
            q = np.log(q[::2] * q[1::2])  # of four bits each
            out[:live] += np.add.reduceat(q.astype(np.float64), 2 * (np.cumsum(counts) - counts))
            cell *= 2
            np.copyto(own, bit, casting="unsafe")
            cell += own
            both = np.bincount(cell.ravel(), minlength=2 * live * CELLS).reshape(live, CELLS, 2)
            ones += both[:, :, 1]
            uses += both[:, :, 0] + both[:, :, 1]
            size = np.bincount(key)
            where = np.nonzero(size)[0]
            size = size[where]
            edge, rate = np.cumsum(size) - size, (RATE / SCALE / np.sqrt(size)).astype(np.float32)[:, None]
            for w, v in zip(self.weights, x, strict=True):
                v *= miss
                w[where] += rate * np.add.reduceat(v, edge, 0)
        return out


def _lowered(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")


def _seen(rows: DataFrame) -> DataFrame:
    """fold, back, inside, symbol, times from text and fold (boolean): rows of STEP different bytes of the training texts at most, as ``Seen`` writes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}

        def put(f: bool) -> Iterator[pa.RecordBatch]:
            for data, at in _pieces(held.pop(f)[0]):
                for part in Seen.of(data, at).parts(STEP):
                    yield pa.RecordBatch.from_arrays([pa.array([f]), *(pa.array([x], pa.binary()) for x in part.row())], ["fold", *_CELLS])

        for b in batches:
            for t, f in zip(map(normal, b.column(0).to_pylist()), b.column(1).to_pylist(), strict=True):
                if f in held and held[f][1] + len(t) > PART:
                    yield from put(f)
                texts, size = held.get(f, ([], 0))
                held[f] = texts, size + len(t)
                texts.append(t)
        for f in list(held):
            yield from put(f)

    return rows.select("text", "fold").mapInArrow(run, "fold boolean, back binary, inside binary, symbol binary, times binary")


def _cells(batches: Iterator[pa.RecordBatch], first: int = 0) -> Iterator[tuple]:
    """What stands before the cells of ``Seen`` in each row, and those."""
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True):
            yield *row[:first], Seen.read(row[first:])


def _tables(seen: DataFrame, sizes: np.ndarray) -> DataFrame:
    """page, outside, inside and every (the stretched tables of the training texts outside the fold, of those in it, and of all) from what ``_seen`` gives."""
    total = 4 * int(sizes.sum())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, scratch = {}, Scratch()
        for f, seen in _cells(batches, 1):
            if f not in counts:
                counts[f] = np.zeros(total, np.uint32)
            for x in seen.parts(PIECE):
                times = np.repeat(x.times, 4)
                for e in places(x.back, x.inside, x.symbol, sizes, scratch):
                    np.add.at(counts[f], e.ravel(), times)
        for f, mine in counts.items():
            for page in range(-(-total // PAGE)):
                part = mine[page * PAGE : (page + 1) * PAGE]
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([f]), pa.array([pa.compress(part.tobytes(), CODEC, asbytes=True)], pa.binary())], ["page", "fold", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, sums = None, None

        def done() -> pa.RecordBatch:
            each = [stretched(x).tobytes() for x in (sums[0], sums[1], sums[0] + sums[1])]
            return pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), *(pa.array([x], pa.binary()) for x in each)], ["page", "outside", "inside", "every"])

        for b in batches:
            for p, f, c in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                more = np.frombuffer(pa.decompress(c, 4 * min(PAGE, total - p * PAGE), CODEC, asbytes=True), np.uint32)
                if p != page:
                    if page is not None:
                        yield done()
                    page, sums = p, np.zeros((2, len(more)), np.int64)
                sums[int(f)] += more
        if page is not None:
            yield done()

    # A page's partial counts pass by one after the other, however many there are.
    partial = seen.select("fold", *_CELLS).mapInArrow(count, "page int, fold boolean, counts binary")
    return partial.repartition("page").sortWithinPartitions("page").mapInArrow(add, "page int, outside binary, inside binary, every binary")


def read_table(folder: str, column: str, sizes: np.ndarray) -> np.ndarray:
    """A table out of the shared folder."""
    out = np.zeros(4 * int(sizes.sum()), np.uint16)
    store, at = pafs.FileSystem.from_uri(folder)
    for b in pads.dataset(at, filesystem=store, format="parquet").to_batches(columns=["page", column], batch_size=16):
        for page, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            out[page * PAGE : (page + 1) * PAGE] = np.frombuffer(data.as_buffer(), np.uint16)
    return out


class Training:
    """Fits a model to the rows (text, fold) and hands it to tasks: ``model()`` inside one reads the tables once for a worker."""

    def __init__(self, rows: DataFrame, train_bytes: int):
        self.spark, self.sizes, self.weights, self.map = rows.sparkSession, sizes_of(train_bytes), None, (None, None)
        self.folder, held = new_folder(self.spark, "tables"), new_folder(self.spark, "seen")
        made = _seen(rows)
        made.write.option("compression", CODEC).option("parquet.block.size", 8 << 20).parquet(held)  # a reader holds a row group at once
        seen = self.spark.read.schema(made.schema).parquet(held)
        _tables(seen, self.sizes).write.parquet(self.folder)
        for _ in range(NEWTON):
            self._newton(seen)
        self._fill(seen)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(held)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _maker(self, column: str):
        kept = self.spark.sparkContext.broadcast({})  # in each Python worker, it keeps the table from task to task
        folder, sizes, weights, (uses, ones) = self.folder, self.sizes, self.weights, self.map

        def model() -> Model:
            if column not in kept.value:
                kept.value[column] = read_table(folder, column, sizes)
            return Model(sizes, kept.value[column], weights, uses, ones)

        return model

    def maker(self):
        return self._maker("every")

    def _sums(self, seen: DataFrame, run) -> dict[int, float]:
        """Sums by number over all tasks (a fixed number of them), of what ``run(model, seen)`` gives; rounded, so that the order of adding is not seen.
        Each fold's texts meet the model of the other's, and a task those of one fold only."""

        def of(make):
            def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                sums, model = None, None
                for (some,) in _cells(batches):
                    model = model or make()
                    now = run(model, some)
                    sums = now if sums is None else sums + now
                if sums is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums)], ["i", "x"])

            return each

        parts = [seen.where(which).select(*_CELLS).mapInArrow(of(self._maker(column)), "i int, x double") for which, column in (("fold", "outside"), ("not fold", "inside"))]
        return {r["i"]: r["x"] for r in parts[0].union(parts[1]).groupBy("i").agg(F.sum("x").alias("x")).collect()}

    def _newton(self, seen: DataFrame) -> None:
        """A Newton step of the weights of every gate and bit."""

        def run(model: Model, seen: Seen) -> np.ndarray:
            out = np.zeros((P + P * P, GATES, 8))
            for some in seen.parts(PIECE):
                inputs, gate = model.predictions_of(some)
                order = np.argsort(gate, kind="stable")
                gate, bit, times = gate[order], np.take(_BIT, some.symbol[order], 0), some.times[order].astype(np.float64)[:, None]
                x = [np.take(i, order, 0).astype(np.float64) for i in inputs]
                p = 1 / (1 + np.exp(-model.mixed(x, model.weights, gate)))
                miss, slope = (bit - p) * (times / SCALE), (p - p * p) * (times / SCALE**2)
                edge = np.concatenate([[0], np.nonzero(np.diff(gate))[0] + 1, [len(gate)]])
                for a, b in zip(edge, edge[1:], strict=False):
                    for i in range(P):
                        out[i, gate[a]] += np.einsum("nb,nb->b", miss[a:b], x[i][a:b])
                        steep = slope[a:b] * x[i][a:b]
                        for j in range(i + 1):
                            out[P + P * i + j, gate[a]] += np.einsum("nb,nb->b", steep, x[j][a:b])
            return out.ravel()

        found = self._sums(seen, run)
        if not found:
            return
        sums = np.array([found[i] for i in range(len(found))]).reshape(P + P * P, GATES * 8)
        now = (np.full((P, GATES * 8), 1.0 / P) if self.weights is None else self.weights.reshape(P, -1)).astype(np.float64)
        for c in range(GATES * 8):
            lower = sums[P:, c].reshape(P, P)
            hessian = lower + np.tril(lower, -1).T + RIDGE * np.eye(P)
            now[:, c] += np.clip(np.linalg.solve(hessian, sums[:P, c] - RIDGE * (now[:, c] - 1.0 / P)), -0.5, 0.5)
        self.weights = np.round(now.reshape(P, GATES, 8), 5)

    def _fill(self, seen: DataFrame) -> None:
        """The counts that the adaptive map begins with, as many as make FIRM of a cell that is met often: of every training byte by the first weights."""

        def run(model: Model, seen: Seen) -> np.ndarray:
            out = np.zeros((2, CELLS))
            for some in seen.parts(PIECE):
                inputs, gate = model.predictions_of(some)
                cell = cells(model.mixed(inputs, model.weights, gate), np.empty((len(gate), 8), np.int64))
                cell += np.arange(8) * STEPS
                times, bit = np.repeat(some.times.astype(np.float64), 8), np.take(_BIT, some.symbol, 0).ravel()
                for o, weights in zip(out, (times, times * bit), strict=True):
                    o += np.bincount(cell.ravel(), weights, CELLS)
            return out.ravel()

        found = self._sums(seen, run)
        if found:
            self.map = tuple(np.array([found[i] for i in range(2 * CELLS)]).reshape(2, CELLS))


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts laid out, and the places of their bytes; a single long text in pieces."""
    data, starts = laid_out(texts)
    if len(texts) > 1:
        yield data, spread(starts, np.append(starts[1:] - PAD, len(data)) - starts)
    else:
        for i in range(PAD, len(data), PART):
            piece = data[i - PAD : i + PART]
            yield piece, np.arange(PAD, len(piece))


def _blocks(docs: DataFrame, id_col: str, text_col: str, held: Column, make) -> DataFrame:
    """block, docs, held, sizes (words of each document), scores, bytes, index (packed int32: the word of each token), words, times
    (training counts)."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["block", "docs", "held", "sizes", "scores", "bytes", "index", "words", "times"]
    schema = f"block long, docs array<{kind}>, held array<boolean>, sizes array<int>, scores array<double>, bytes array<long>, index binary, words array<binary>, times array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, seq, model = [], 0, 0, make()

        def flush() -> pa.RecordBatch:
            nonlocal rows, size, seq
            table = pa.Table.from_batches(rows)
            coded = [normal(t) for t in table["text"].to_pylist()]
            scores = model.score(coded)[0]
            split = [t.split() for t in coded]
            sizes = np.fromiter(map(len, split), np.int64, len(split))
            tokens = pa.array([w for s in split for w in s], pa.binary()).dictionary_encode()
            index, words = tokens.indices.to_numpy(), tokens.dictionary
            out = np.array(table["held"].to_pylist(), bool)
            times = np.bincount(index[~np.repeat(out, sizes)], minlength=len(words))
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            part = table["part"][0].as_py()
            row = [pa.array([part << 24 | seq]), one(table["id"].combine_chunks()), one(pa.array(out)), one(pa.array(sizes, pa.int32())), one(pa.array(scores)), one(pa.array(list(map(len, coded)), pa.int64())), pa.array([pa.compress(index.astype(np.int32).tobytes(), CODEC, asbytes=True)], pa.binary()), one(words), one(pa.array(times, pa.int32()))]
            rows, size, seq = [], 0, seq + 1
            return pa.RecordBatch.from_arrays(row, names)

        for b in batches:
            lengths = pc.binary_length(b.column(1)).to_pylist()
            a = 0
            for i in range(b.num_rows):
                size += lengths[i]
                if size >= BLOCK_BYTES or i == b.num_rows - 1:
                    rows.append(b.slice(a, i + 1 - a))
                    a = i + 1
                    if size >= BLOCK_BYTES:
                        yield flush()
        if rows:
            yield flush()

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), _lowered(text_col).alias("text"), held.alias("held"), F.spark_partition_id().alias("part"))
    return rows.mapInArrow(run, schema)


def score(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    ``held`` marks the rows that the model does not learn from. Scores are log10 probabilities; bits per byte are those of ``score``
    over the bytes that are coded.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)  # it stays, since Spark reads it as the result is written
    fold = F.pmod(F.xxhash64(_lowered(text_col)), F.lit(FOLDS)) == 0
    rows = docs.where(~held).select(_lowered(text_col).alias("text"), fold.alias("fold"))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    ends = int(seen["n"])
    make = Training(rows, int(seen["bytes"] or 0)).maker() if ends else (lambda: Model(sizes_of(0), np.zeros(4 * int(sizes_of(0).sum()), np.uint16)))

    blocks = cut(_blocks(docs, id_col, text_col, held, make), "blocks")
    each = blocks.select(F.inline(F.arrays_zip("words", "times"))).withColumnRenamed("words", "word")
    totals = cut(each.groupBy("word").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("blocks")), "words")
    sums = totals.agg(F.sum("times").alias("n"), F.count_if(F.col("times") > 0).alias("v")).first()
    n_all, v_all = int(sums["n"] or 0) + ends, int(sums["v"]) + bool(ends)

    top = totals.where(F.length("word") <= FREQUENT_BYTES).orderBy(F.desc("blocks"), "word").limit(FREQUENT).select("word", "times").toArrow()
    frequent = docs.sparkSession.sparkContext.broadcast(dict(zip(top["word"].to_pylist(), top["times"].to_pylist(), strict=True)))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for b in batches:
            for r in range(b.num_rows):
                words = b.column(1)[r].values
                at = np.array([i for i, w in enumerate(words.to_pylist()) if w not in known], np.int32)
                for k in range(0, len(at), 65536):
                    i = pa.array(at[k : k + 65536])
                    yield pa.RecordBatch.from_arrays([words.take(i), pa.array(np.full(len(i), b.column(0)[r].as_py()), pa.int64()), i], ["word", "of", "i"])

    # A word outside the FREQUENT has a row for each block that holds it, which Spark splits further where that is many.
    back = blocks.select("block", "words").mapInArrow(rest, "word binary, of long, i int").join(totals.select("word", "times"), "word").select("of", "i", "times")
    kind = docs.schema[id_col].dataType.simpleString()

    def finish(block: pa.Table, rows: pa.Table) -> pa.Table:
        get = frequent.value.get
        words = block["words"].combine_chunks().flatten().to_pylist()
        count = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        count[rows["i"].to_numpy()] = rows["times"].to_numpy()
        ids, held, sizes, scores, size = (block[c].combine_chunks().flatten() for c in ("docs", "held", "sizes", "scores", "bytes"))
        sizes, scores = sizes.to_numpy().astype(np.int64), scores.to_numpy() / LN10
        index = np.frombuffer(pa.decompress(block["index"][0].as_py(), 4 * int(sizes.sum()), CODEC, asbytes=True), np.int32)
        edges = np.concatenate([[0], np.cumsum(sizes)])

        def by_doc(x: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0.0], np.cumsum(x[index], dtype=np.float64)])
            return sums[edges[1:]] - sums[edges[:-1]]

        known = by_doc((count > 0).astype(np.float64)) + (ends > 0)
        bottom = np.log10(n_all + v_all + 1)
        base = by_doc(np.log10(count + 1) - bottom) + np.log10(ends + 1) - bottom
        per = -scores * np.log2(10) / size.to_numpy()
        return pa.table([ids, held, pa.array(sizes + 1), pa.array(known.astype(np.int64)), pa.array(np.full(len(sizes), n_all)), pa.array(base), pa.array(scores), size, pa.array(per)], names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"])

    whole = blocks.select("block", "docs", "held", "sizes", "scores", "bytes", "index", "words")
    return whole.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(finish, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double")
