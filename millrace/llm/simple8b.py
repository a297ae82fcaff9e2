"""Operator 8, token-ID output: Simple-8b word-aligned coding, its file format, and reading the files back.

Coding. A 64-bit word has a 4-bit selector and 60 data bits, which hold ``count`` ids of ``width`` bits each. Selector 15 is the
escape: the whole next word is one id of 60 bits or more. Blocks of ``BLOCK`` ids begin at a word of their own, and the words'
offsets are kept for each block, so all blocks are packed and unpacked side by side.

File. Little-endian: 8 bytes magic, then the numbers of documents, ids, blocks and words (uint64 each); the documents' ids
(int64); the documents' numbers of ids (uint32); the blocks' first words (uint64); the words (uint64).

Files hold documents in ascending id order. ``write`` deals documents into ranges of ids, sorts each range and writes it as files
of ``FILE_IDS`` ids at most (one document may exceed that) to a folder of the shared store; a task that runs again writes the same
files again, each under a temporary name first. ``read`` lists the folder, and takes each document's start from the files before.

Defined results: null and empty texts have the end id alone; rows that repeat an id are written one after the other, ordered by
text; null ids come first and are stored as the smallest int64; an empty table makes no files, and reads as no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, new_folder, sized_join

MAGIC, SUFFIX, BLOCK, FILE_IDS = b"S8B-IDS1", ".s8b", 256, 1 << 21
#: Ids in a word and bits of each, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)[2:]
WIDTHS = 60 // COUNTS
_LIMITS = np.uint64(1) << WIDTHS.astype(np.uint64)
ESCAPE = 15
#: Different words that a Python worker keeps the ids of.
KNOWN_WORDS = 800_000
#: Texts whose words are looked up together: the more there are, the more words they share.
AT_ONCE = 4096
_MARKS = b".,!?;:%&$#*|"
#: The first letter after those of Latin alphabets, and the one before it that lower case makes a letter and a mark.
_BEYOND, _DOTTED = "\u0250", "\u0130"
#: How byte-level vocabularies write the bytes that are not printable in Latin-1: in order, from U+0100 on.
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}
NO_ID = np.iinfo(np.int64).min


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the ids, and the first word of each block."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # The selector with most ids that fits at each position: the next COUNTS ids, within the block, are narrow enough. Where most
    # ids are narrow, running counts of the wide ones tell; where few are, the c-th narrow id from here must be c - 1 places on.
    first = np.searchsorted(_LIMITS, ids, "right").astype(np.int8)  # the first selector, from the narrowest, that holds the id
    best, room = np.full(n, ESCAPE, np.int8), np.minimum(BLOCK - np.arange(n, dtype=np.int32) % BLOCK, n - np.arange(n, dtype=np.int32))
    widest = int(first.max())
    for s in range(len(COUNTS) - 1, -1, -1):
        c, narrow = int(COUNTS[s]), first <= s
        few = np.count_nonzero(narrow)
        if widest <= s:
            best[room >= c] = s
        elif few > max(n // 4, c - 1):
            wide = np.cumsum(~narrow, dtype=np.int32)  # at least c ids, so none of these is empty
            ok = room[: n - c + 1] >= c
            ok[0] &= wide[c - 1] == 0
            ok[1:] &= wide[c:] == wide[: n - c]
            best[: n - c + 1][ok] = s
        elif few >= c:
            at = np.nonzero(narrow)[0]
            spots = at[: few - c + 1]
            spots = spots[at[c - 1 :] - spots == c - 1]
            best[spots[room[spots] >= c]] = s
    at = np.arange(blocks) * BLOCK
    ends = np.minimum(at + BLOCK, n)
    live, steps = np.arange(blocks), []
    while len(live):  # one word of every block that is not done yet
        pos = at[live]
        s = best[pos]
        steps.append((live, pos, s))
        at[live] = pos + np.where(s == ESCAPE, 1, COUNTS[np.minimum(s, len(COUNTS) - 1)])
        live = live[at[live] < ends[live]]
    block, pos, sel = (np.concatenate([x[i] for x in steps]) for i in range(3))
    order = np.argsort(pos, kind="stable")
    block, pos, sel = block[order], pos[order], sel[order]
    size = np.where(sel == ESCAPE, 2, 1)
    where = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s in range(len(COUNTS)):
        mine = np.nonzero(sel == s)[0]
        if len(mine):
            word = np.full(len(mine), np.uint64(s) << np.uint64(60))
            for i in range(int(COUNTS[s])):
                word |= ids[pos[mine] + i] << np.uint64(i * WIDTHS[s])
            words[where[mine]] = word
    mine = np.nonzero(sel == ESCAPE)[0]
    words[where[mine]] = np.uint64(ESCAPE) << np.uint64(60)
    words[where[mine] + 1] = ids[pos[mine]]
    return words, where[np.searchsorted(block, np.arange(blocks))].astype(np.uint64)


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids that ``encode`` packed."""
    ids, words = np.zeros(n, np.uint64), np.ascontiguousarray(words, np.uint64)
    if not n:
        return ids
    ends = np.append(offsets[1:], len(words)).astype(np.int64)
    at, to = offsets.astype(np.int64), np.arange(len(offsets)) * BLOCK
    live, steps = np.arange(len(offsets)), []
    selectors = (words >> np.uint64(60)).astype(np.int64)
    while len(live):
        s = selectors[at[live]]
        steps.append((at[live], to[live].copy(), s))
        to[live] += np.where(s == ESCAPE, 1, COUNTS[np.minimum(s, len(COUNTS) - 1)])
        at[live] += np.where(s == ESCAPE, 2, 1)
        live = live[at[live] < ends[live]]
    where, pos, sel = (np.concatenate([x[i] for x in steps]) for i in range(3))
    for s in range(len(COUNTS)):
        mine = sel == s
        if mine.any():
            word, p, mask = words[where[mine]], pos[mine], np.uint64((1 << int(WIDTHS[s])) - 1)
            for i in range(int(COUNTS[s])):
                ids[p + i] = word >> np.uint64(i * WIDTHS[s]) & mask
    mine = sel == ESCAPE
    ids[pos[mine]] = words[where[mine] + 1]
    return ids


def pack(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A file of documents and their ids, one after the other."""
    words, offsets = encode(ids)
    head = np.array([len(doc_ids), len(ids), len(offsets), len(words)], "<u8")
    return MAGIC + b"".join(x.tobytes() for x in (head, doc_ids.astype("<i8"), counts.astype("<u4"), offsets.astype("<u8"), words.astype("<u8")))


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, counts and ids of a file."""
    if data[:8] != MAGIC:
        raise ValueError("not a file of packed ids")
    docs, n, blocks, words = (int(x) for x in np.frombuffer(data, "<u8", 4, 8))
    at, out = 40, []
    for kind, size in (("<i8", docs), ("<u4", docs), ("<u8", blocks), ("<u8", words)):
        out.append(np.frombuffer(data, kind, size, at))
        at += out[-1].nbytes
    return out[0], out[1].astype(np.int64), decode(out[3], out[2], n)


def _latin(stem: bytes) -> bool:
    """Whether the text ends in a letter before U+0250 that lower case leaves one letter."""
    last = stem[-2:].decode("utf-8", "replace")[-1:]
    return last.isalpha() and last < _BEYOND and last != _DOTTED


class WordTokenizer:
    """UTF-8 texts to the ids that a ``tokenizers`` file gives them.

    A file whose normaliser is PLAIN and whose pre-tokenizer is CUTS lower-cases, drops white space and never joins across it. A
    text's ids are then those of its words between ASCII white space, one after the other, so each different word is encoded once and
    kept for later texts, up to a bound. A word that ends in common punctuation after an ASCII digit or a letter of a Latin alphabet
    is encoded in two: normalising leaves such a letter a letter, and the pre-tokenizer cuts there as well. Whatever else a file does, it
    gets whole texts.
    """

    PLAIN = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
    CUTS = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
    BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        self.model, self.known = Tokenizer.from_file(path), {}
        parts = json.loads(self.model.to_str())
        alone = all(not (a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"]) and not re.search(r"\s", a["content"]) for a in parts["added_tokens"])
        self.by_word = alone and parts["normalizer"] == self.PLAIN and parts["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [self.CUTS, self.BYTES]} and not parts["post_processor"] and not parts["truncation"] and not parts["padding"]

    def _learn(self, words: set[bytes]) -> None:
        known, halves, new = self.known, {}, set()
        for w in words:
            stem = w.rstrip(_MARKS)
            if len(stem) < len(w) and (stem[-1:].isalnum() or _latin(stem)):
                halves[w] = (stem, w[len(stem) :])
                new.update(halves[w])
            else:
                new.add(w)
        new.difference_update(known)
        # Letters of Latin alphabets need no normalising beyond lower case and no cutting, so the model takes them as they are.
        plain, tokenize = set(), self.model.model.tokenize
        for w in new:
            text = w.decode()
            if text.isalpha() and (text.isascii() or max(text) < _BEYOND and _DOTTED not in text):
                text = text.lower() if text.isascii() else text.lower().encode().decode("latin-1").translate(_BYTE_LETTERS)
                known[w] = array("I", [t.id for t in tokenize(text)]).tobytes()
                plain.add(w)
        rest = list(new.difference(plain))
        for i in range(0, len(rest), 2048):
            part = rest[i : i + 2048]
            found = self.model.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            known.update(zip(part, (array("I", e.ids).tobytes() for e in found), strict=True))
        for w, (stem, marks) in halves.items():
            known[w] = known[stem] + known[marks]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (a string array), and how many each has."""
        if not self.by_word:
            found = [e.ids for e in self.model.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words, index = coded.dictionary.cast(pa.binary()).to_pylist(), coded.indices.to_numpy()
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        parts = list(map(self.known.get, words))
        if None in parts:
            self._learn({w for w, p in zip(words, parts, strict=True) if p is None})
            parts = list(map(self.known.__getitem__, words))
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        start, size = (np.cumsum(size) - size).astype(np.int32)[index], size.astype(np.int32)[index]
        ends = np.cumsum(size, dtype=np.int32)
        where = np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32) + np.repeat(start - (ends - size), size)
        return np.frombuffer(b"".join(parts), np.uint32)[where], np.diff(np.concatenate([[0], ends])[np.cumsum([0, *pc.list_value_length(split).to_pylist()])])


def write(docs: DataFrame, tokenizer: str, end: int, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, ranges: int | None = None) -> str:
    """Write the ids of all texts, each with ``end`` after it, and return the folder."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "ids")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["id", F.crc32(F.col("text").cast("binary")), "text"]
    dealt = rows.repartitionByRange(ranges, *order[:2]) if ranges else rows.repartitionByRange(*order[:2])
    dealt = dealt.withColumn("part", F.spark_partition_id()).sortWithinPartitions(*order)

    kept = spark.sparkContext.broadcast({})  # in each Python worker, it keeps the tokenizer from task to task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = pafs.FileSystem.from_uri(folder)
        store.create_dir(at, recursive=True)
        encoded = kept.value["tokenizer"] = kept.value.get("tokenizer") or WordTokenizer(tokenizer)
        held, seq, part = [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, held
            doc, counts, ids = (np.concatenate([h[i] for h in held]) for i in range(3))
            name, data = f"{at}/part-{part:07d}-{seq:07d}{SUFFIX}", pack(doc, counts, ids)
            temporary = f"{at}/_{part:07d}-{seq:07d}-{np.random.default_rng().integers(1 << 62):x}"
            with store.open_output_stream(temporary) as f:
                f.write(data)
            store.move(temporary, name)
            seq, held = seq + 1, []
            return pa.RecordBatch.from_pydict({"file": [name], "bytes": [len(data)]})

        for b in batches:
            if b.num_rows:
                part = b.column(2)[0].as_py()
            ids = b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for i in range(0, b.num_rows, AT_ONCE):
                flat, counts = encoded(b.column(1).slice(i, AT_ONCE))
                counts = counts + 1
                held.append((ids[i : i + AT_ONCE], counts, np.insert(flat, np.cumsum(counts - 1), end)))
                if sum(len(h[2]) for h in held) >= FILE_IDS:
                    yield flush()
        if held:
            yield flush()

    dealt.select("id", "text", "part").mapInArrow(run, "file string, bytes long").agg(F.sum("bytes")).collect()
    return folder


def read(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """id, start, n_tokens, ids_crc32 of each document in a folder of files, from the files alone."""
    store, at = pafs.FileSystem.from_uri(folder)
    if store.get_file_info(at).type == pafs.FileType.NotFound:
        return spark.createDataFrame([], f"{id_col} long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                doc, counts, ids = unpack(b.column(1)[i].as_py())
                ends = np.cumsum(counts)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                name = b.column(0)[i].as_py().rsplit("/", 1)[-1]
                yield pa.RecordBatch.from_pydict({"part": [int(name[5:12])] * len(doc), "seq": [int(name[13:20])] * len(doc), "doc": doc, "inner": ends - counts, "n": counts, "crc": pa.array(crc, pa.int64())})

    rows = cut(files.mapInArrow(run, "part long, seq long, doc long, inner long, n long, crc long"), "ids-read")
    # Offsets in two levels, from a row for each file and then one for each range; the rows of a range are its files.
    sizes = rows.groupBy("part", "seq").agg(F.sum("n").alias("size"))
    parts = sizes.groupBy("part").agg(F.sum("size").alias("size"))
    before = parts.select("part", F.coalesce(F.sum("size").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inner = F.coalesce(F.sum("size").over(W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("part", "seq", inner.alias("skip")).join(before, "part").select("part", "seq", (F.col("base") + F.col("skip")).alias("first"))
    found = sized_join(rows, cut(starts, "starts"), ["part", "seq"])
    return found.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias(id_col), (F.col("first") + F.col("inner")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
