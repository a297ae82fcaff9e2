"""Operator 4, SentencePiece encoding and decoding with N-best segmentation.

A text is a path through the lattice of vocabulary pieces, scored by the sum of the pieces' own scores. A forward Viterbi pass gives
every position the best score of any path that reaches it. Those scores are exact heuristics for a backward A* search from the end,
which therefore pops complete segmentations best first, without ever going back on one.

The lattice is cut, exactly, wherever no piece of the vocabulary holds the two neighbouring characters side by side: no path has a
piece across such a place. Each different part is solved once (and remembered, up to a bound); the N best segmentations of a text
come from those of the parts, of which only the N - 1 with the smallest loss for their second best can matter.

Encoding follows the SentencePiece conventions: a space is written as U+2581, one is put in front of the text, and a character
without a piece falls back to its UTF-8 bytes at a score 10 below the lowest of the vocabulary. A U+2581 of the text itself falls
back to bytes too, so decoding gives back every text exactly.

Defined results: null and empty texts have no ids, one segmentation of score 0, and decode to the empty text; fewer segmentations
than asked for give a shorter list; ties prefer the segmentation whose search got nearer the start first, so results do not depend
on the data around; rows are encoded one by one, so repeated rows agree.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from heapq import heappop, heappush, nsmallest
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Different parts that a Python worker remembers (some 300 bytes each), and characters that they have on average at most.
REMEMBER, PART_CHARS = 200_000, 40
_SWAP = str.maketrans({" ": SPACE, SPACE: " "})
_MISSING = object()


class Pieces:
    """A SentencePiece model file as a lattice."""

    def __init__(self, path: str, n: int = 3, remember: int = REMEMBER):
        from sentencepiece import SentencePieceProcessor

        sp, self.n, self.remember = SentencePieceProcessor(model_file=path), n, remember
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in ids if sp.is_byte(i)}
        self.unknown_id, self.unknown = sp.unk_id(), min((sp.get_score(i) for i in plain), default=0.0) - 10.0
        by = {i: bytes([b]) for b, i in self.bytes.items()}
        self.surface = [by.get(i, b"") for i in ids]
        for i in plain:
            self.surface[i] = sp.id_to_piece(i).replace(SPACE, " ").encode()
        if not by:
            self.surface[self.unknown_id] = " \u2047 ".encode()
        # Every piece, and every end of a piece (None if that is no piece): from a position, look backward until nothing is there.
        self.ends: dict[str, tuple[int, float] | None] = {}
        for i in plain:
            p = sp.id_to_piece(i)
            for k in range(1, len(p)):
                self.ends.setdefault(p[k:], None)
            self.ends[p] = (i, sp.get_score(i))
        letters = sorted({c for p in self.ends for c in p})
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.joined = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for p in self.ends:
            for a, b in zip(p, p[1:], strict=False):
                self.joined[self.letter[ord(a)], self.letter[ord(b)]] = True
        self.forget()

    def forget(self) -> None:
        """Start anew with what is remembered of parts: a number for each, and by number the part, best ids, score, and loss of the
        second best. Further segmentations are looked for where a text needs them."""
        self.known: dict[str, int] = {}
        self.part: list[str] = []
        self.best: list[bytes] = []
        self.score, self.loss, self.chars = array("d"), array("d"), 0

    def _fallback(self, c: str) -> tuple[int, ...]:
        return tuple(self.bytes[b] for b in c.translate(_SWAP).encode()) if self.bytes else (self.unknown_id,)

    def _reach(self, part: str, best: list[float], into: list[list[tuple]]) -> None:
        """Viterbi scores of, and arcs into, the positions of the part that the lists do not have yet."""
        ends = self.ends
        for j in range(len(best), len(part) + 1):
            arcs, top, i = [], -np.inf, j - 1
            while i >= 0 and (arc := ends.get(part[i:j], _MISSING)) is not _MISSING:
                if arc:
                    arcs.append((i, *arc))
                    if best[i] + arc[1] > top:
                        top = best[i] + arc[1]
                i -= 1
            if not arcs or arcs[0][0] != j - 1:
                arcs.append((j - 1, self._fallback(part[j - 1]), self.unknown))
                top = max(top, best[j - 1] + self.unknown)
            best.append(top)
            into.append(arcs)

    def learn(self, parts: list[str]) -> None:
        """Solve the parts (spaces and U+2581 already swapped). In sorted order, a part goes on from the prefix that it shares with
        the one before: Viterbi scores and arcs up to there are the same."""
        best, into, last = [0.0], [[]], ""
        for part in sorted(parts):
            k = 0
            for x, y in zip(part, last, strict=False):
                if x != y:
                    break
                k += 1
            del best[k + 1 :], into[k + 1 :]
            self._reach(part, best, into)
            last = part
            found = self._search(len(part), best, into, min(2, self.n))
            self.known[part] = len(self.best)
            self.part.append(part)
            self.best.append(found[0][1])
            self.score.append(found[0][0])
            self.loss.append(found[0][0] - found[1][0] if len(found) > 1 else np.inf)
            self.chars += len(part)

    def others(self, number: int) -> list[tuple[float, bytes]]:
        """The segmentations of a part after its best, as (loss, ids)."""
        best, into = [0.0], [[]]
        self._reach(self.part[number], best, into)
        first, *rest = self._search(len(self.part[number]), best, into, self.n)
        return [(first[0] - score, ids) for score, ids in rest]

    def _search(self, size: int, best: list[float], into: list[list[tuple]], n: int) -> list[tuple[float, bytes]]:
        """The n best paths to position ``size``: score and ids (int32 bytes), best first."""
        found, heap, made = [], [(-best[size], size, 0, 0.0, None)], 0
        while heap:
            _, at, _, score, path = heappop(heap)
            if not at:
                ids = array("i")
                while path is not None:
                    piece, path = path
                    if isinstance(piece, int):
                        ids.append(piece)
                    else:
                        ids.extend(piece)
                found.append((score, ids.tobytes()))
                if len(found) == n:
                    break
                continue
            for i, piece, s in into[at]:
                made += 1
                heappush(heap, (-(score + s + best[i]), i, made, score + s, (piece, path)))
        return found

    def _parts(self, text: str) -> list[str]:
        text = SPACE + (text.translate(_SWAP) if SPACE in text else text.replace(" ", SPACE))
        codes = self.letter[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        at = (np.nonzero(~self.joined[codes[:-1], codes[1:]])[0] + 1).tolist()
        return [text[a:b] for a, b in zip([0, *at], [*at, len(text)], strict=True)]

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, list[tuple[float, tuple[tuple[int, int], ...]]], np.ndarray]]:
        """For each text: ids of the best segmentation (int32 bytes), the N best as (score, changes), and its parts' numbers.

        A change (k, o) says that the text's k-th part takes its o-th other segmentation.
        """
        if len(self.known) > self.remember or self.chars > self.remember * PART_CHARS:
            self.forget()
        split = [self._parts(t) if t else [] for t in texts]
        if new := set(chain.from_iterable(split)).difference(self.known):
            self.learn(list(new))
        score, loss, out = np.array(self.score), np.array(self.loss), []
        for parts in split:
            numbers = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
            total, losses, options = float(score[numbers].sum()), loss[numbers], [(0.0, ())]
            few = min(self.n - 1, len(parts))
            for k in np.argpartition(losses, few - 1)[:few].tolist() if few else ():
                others = self.others(numbers[k])
                options = nsmallest(self.n, [*options, *((less + more, (*changes, (k, o))) for less, changes in options for o, (more, _) in enumerate(others))])
            out.append((b"".join(map(self.best.__getitem__, numbers.tolist())), [(total - less, changes) for less, changes in options], numbers))
        return out

    def whole(self, found: tuple) -> list[bytes]:
        """The ids (int32 bytes) of each of a text's segmentations that ``encode`` found, best first."""
        best, options, numbers = found
        out = []
        for _, changes in options:
            if changes:
                ids = list(map(self.best.__getitem__, numbers.tolist()))
                for k, o in changes:
                    ids[k] = self.others(numbers[k])[o][1]
                out.append(b"".join(ids))
            else:
                out.append(best)
        return out

    def nbest(self, text: str | None) -> list[tuple[float, list[int]]]:
        """The N best segmentations of a whole text: score and ids."""
        found = self.encode([text])[0]
        return [(s, np.frombuffer(ids, np.int32).tolist()) for (s, _), ids in zip(found[1], self.whole(found), strict=True)]

    def decode(self, ids) -> str:
        return b"".join(map(self.surface.__getitem__, ids))[1:].decode("utf-8", "replace")


def encode(docs: DataFrame, model: str, n: int = 3, id_col: str = "doc_id", text_col: str = "text", remember: int = REMEMBER) -> DataFrame:
    """id, n_pieces, ids (of the best segmentation), scores (of the n best, best first), round_trip (decoding gives the text), others (the
    ids of the n best after the first)."""
    kind = docs.schema[id_col].dataType.simpleString()

    held = docs.sparkSession.sparkContext.broadcast({})  # in each Python worker, it keeps the model from task to task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = held.value.setdefault("pieces", None) or Pieces(model, n, remember)
        held.value["pieces"] = pieces
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                texts = b.column(1).to_pylist()
                found = pieces.encode(texts)
                ids = [np.frombuffer(best, np.int32) for best, _, _ in found]
                scores = [[s for s, _ in options] for _, options, _ in found]
                same = [pieces.decode(i.tolist()) == (t or "") for i, t in zip(ids, texts, strict=True)]
                ends = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
                rest = [pieces.whole(f)[1:] for f in found]
                flat = [np.frombuffer(x, np.int32) for r in rest for x in r]
                inner = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, flat)]), pa.int32()), pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32)))
                others = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rest)]), pa.int32()), inner)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(ends), pa.int64()), lists, pa.array(scores, pa.list_(pa.float64())), pa.array(same), others], [id_col, "n_pieces", "ids", "scores", "round_trip", "others"])

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("__text")).mapInArrow(run, f"`{id_col}` {kind}, n_pieces long, ids array<int>, scores array<double>, round_trip boolean, others array<array<int>>")


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and text of rows of ids. Null ids decode to the empty text."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([pieces.decode(x or ()) for x in b.column(1).to_pylist()], pa.string())], [id_col, "text"])

    return encoded.select(F.col(f"`{id_col}`"), F.col(f"`{ids_col}`").alias("__ids")).mapInArrow(run, f"`{id_col}` {kind}, text string")
