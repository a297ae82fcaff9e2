import math
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from millrace.llm import langid, mixing, pieces, queries, simple8b
from tests.llm import data
from tests.oracle import SF

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


# Language identification


def test_languages_are_told_on_held_out_documents(spark):
    got = queries.op9_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95 and all(0 <= r.score <= 1 for r in got)


def test_predictions_of_messy_rows(spark):
    docs = data.docs(spark)
    model = langid.fit(docs)
    got = langid.predict(docs, model).select("text", "language.*").collect()
    assert len(got) == docs.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == letters and (letters or r.score == 0)
    told = {r.text: r.lang_pred for r in got}
    assert np.mean([told[t] == lang for _, t, lang in data.texts()[:40]]) > 0.95
    assert len({(r.lang_pred, r.score) for r in got if r.text == "the same row"}) == 1


def test_backoff_goes_from_words_to_ever_shorter_grams():
    rows = np.log(np.array([[0.9, 0.1], [0.2, 0.8], [0.7, 0.3]], np.float32))
    model = langid.Model(["aa", "bb"], {"known": 0}, rows[:1], {"xyz": 0, "q": 1}, rows[1:])
    assert model.predict("known", {})[0] == "aa" and model.predict("zq", {})[0] == "aa"
    assert np.allclose(model.unseen("axyzq"), rows[1]) and np.allclose(model.unseen("aq"), rows[2]) and np.allclose(model.unseen("m"), 0)


def test_without_labels_nothing_is_told(spark):
    docs = data.docs(spark)
    model = langid.fit(docs.where("lang = 'no such'"))
    assert {r.lang_pred for r in langid.predict(docs, model).select("language.lang_pred").collect()} == {"und"}
    assert langid.keep_identified(data.empty(spark)).count() == 0


def test_the_stage_drops_what_cannot_be_told_only(spark):
    docs = data.docs(spark)
    kept = langid.keep_identified(docs)
    assert kept.schema == docs.schema
    assert sorted(str(r.text) for r in kept.collect()) == sorted(t for _, t, _ in data.texts() if any(c.isalpha() for c in t or ""))


# SentencePiece


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(PIECES, 4)


def every_path(model, text):
    s, out = pieces.SPACE + text.translate(pieces._SWAP), []

    def go(i, score, ids):
        if i == len(s):
            return out.append((score, tuple(ids)))
        single = False
        for j in range(i + 1, len(s) + 1):
            if arc := model.ends.get(s[i:j]):
                single |= j == i + 1
                go(j, score + arc[1], [*ids, arc[0]])
        if not single:
            go(i + 1, score + model.unknown, [*ids, *model._fallback(s[i])])

    go(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["the cat", "a  b", "x\n\ny", "é▁z", "nation", "zq!!", "  hi", "日本", "aaaaaa", "a b c", " ", "\t", "▁", "I'm"])
def test_the_n_best_are_those_of_all_paths(model, text):
    want, got = every_path(model, text), model.nbest(text)
    assert [s for s, _ in got] == [s for s, _ in want[:4]]
    assert len({tuple(i) for _, i in got}) == len(got) and {(s, tuple(i)) for s, i in got} <= set(want)
    assert all(model.decode(i) == text for _, i in got)


def test_scores_and_pieces_are_those_of_the_library(model):
    sp = SentencePieceProcessor(model_file=PIECES)
    text = "the quick brown fox, 1234 jumps\tover ▁ é 日本 dogs.\n"
    for score, ids in model.nbest(text):
        known = [i for i in ids if not sp.is_byte(i)]
        assert all(0 <= i < sp.get_piece_size() for i in ids)
        assert score == pytest.approx(sum(sp.get_score(i) for i in known) + model.unknown * sum(c in "\t▁\n日本" and c not in "日本" or (c in "日本" and not model.ends.get(c)) for c in text))
    assert model.nbest("") == [(0.0, [])] and model.nbest(None) == [(0.0, [])]


def test_order_and_memory_do_not_matter(model):
    texts = [t for _, t, _ in data.texts()]
    a = [(x[0], [s for s, _ in x[1]]) for x in model.encode(texts)]
    other = pieces.Pieces(PIECES, 4, remember=0)
    b = [(x[0][0], [s for s, _ in x[0][1]]) for x in (other.encode([t]) for t in reversed(texts))][::-1]
    assert a == b


def test_encoded_rows_decode_to_their_texts(spark):
    docs = data.docs(spark)
    coded = pieces.encode(docs, PIECES)
    rows = coded.collect()
    assert all(r.round_trip for r in rows) and len(rows) == docs.count()
    assert all(r.n_pieces == len(r.ids) and r.scores == sorted(r.scores, reverse=True) and 1 <= len(r.scores) <= 3 for r in rows)
    local = pieces.Pieces(PIECES, 3)
    for r in rows:
        assert len(r.others) == len(r.scores) - 1 and len({tuple(x) for x in [r.ids, *r.others]}) == len(r.scores)
        text = {i: t for i, t, _ in data.texts()}.get(r.doc_id) or ""
        if r.doc_id not in (None, 70) and len(text) < 5000:
            assert [ids for _, ids in local.nbest(text)] == [list(x) for x in (r.ids, *r.others)] and {local.decode(x) for x in r.others} <= {text}
    back = pieces.decode(coded.where("doc_id is not null and doc_id <> 70"), PIECES).collect()
    want = {i: t or "" for i, t, _ in data.texts()}
    assert all(r.text == want[r.doc_id] for r in back)
    assert pieces.encode(data.empty(spark), PIECES).count() == 0


# Token ids


@pytest.mark.parametrize("n", [0, 1, 5, 255, 256, 257, 3000])
@pytest.mark.parametrize("bits", [1, 6, 17, 40, 60, 64])
def test_packed_ids_come_back(n, bits):
    r = np.random.default_rng(n * bits)
    ids = r.integers(0, 1 << 63, n, dtype=np.uint64) >> np.uint64(max(0, 63 - bits))
    ids[n // 2 :] >>= np.uint64(bits // 2)
    words, offsets = simple8b.encode(ids)
    assert (simple8b.decode(words, offsets, n) == ids).all() and len(offsets) == -(-n // simple8b.BLOCK)
    assert bits >= 60 or len(words) <= n


def test_escapes_and_word_bounds():
    ids = np.array([(1 << 64) - 1, 1 << 60, (1 << 60) - 1, 0, 1], np.uint64)
    words, offsets = simple8b.encode(ids)
    assert [int(w >> np.uint64(60)) for w in words[[0, 2, 4]]] == [15, 15, 13] and (simple8b.decode(words, offsets, 5) == ids).all()
    with pytest.raises(ValueError):
        simple8b.unpack(b"something else")


def test_files_hold_every_document_in_order(spark):
    docs, end = data.docs(spark), 2
    tokenizer = Tokenizer.from_file(WORDS)
    for ranges in (1, 5):
        got = simple8b.read(spark, simple8b.write(docs, WORDS, end, ranges=ranges)).collect()
        got.sort(key=lambda r: r.start)
        ids = [-1 if r.doc_id is None else r.doc_id for r in got]
        assert ids == sorted(-1 if i is None else i for i, _, _ in data.texts())
        start = 0
        for r in got:
            assert r.start == start
            start += r.n_tokens
        want = Counter()
        for i, t, _ in data.texts():
            x = [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]
            want[i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())] += 1
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert simple8b.read(spark, simple8b.write(data.empty(spark), WORDS, end)).count() == 0


def test_words_apart_are_the_text_as_a_whole():
    import pyarrow as pa

    whole, apart = Tokenizer.from_file(WORDS), simple8b.WordTokenizer(WORDS)
    for t in ["a\x0bb\x0cc", "x\x1cy \x85z q r", " é ́ x", "it's I'LL 12 34!! <|endoftext|>a", "", "İstanbul ǅ", "don't, it's. 'tis! (a). é. …. 3. a1,b2. ½! x…! ,,a.. |.|", "ÉÉ!! EN!! ß.%%% Σας ΣΑΣ."]:
        assert apart(pa.array([t]))[0].tolist() == whole.encode(t, add_special_tokens=False).ids


def test_ids_of_any_letters_and_marks_are_those_of_the_library():
    import pyarrow as pa

    r = random.Random(8)
    letters = [chr(c) for c in range(0x21, 0x3000) if unicodedata.category(chr(c))[0] in "LMNPS"]
    odd = [chr(c) for c in range(0x3000, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c))[0] in "LMN"]
    marks, usual = ".,!?;:%&$#*|'\"()-<>", "abcdeéßñüİıǅ019"
    one = lambda: r.choice(marks if (x := r.random()) < 0.3 else usual if x < 0.6 else letters if x < 0.9 else odd)
    texts = [t + m for t in ("İ", "\u095f", "\u095c", "\u09dc", "\u0958", "a\u0301", "ŉ", "ǰ", "K", "<|endoftext|>", "x<|startoftext|") for m in (".", ",", "|", "!!", "'s.")]
    texts += ["".join(one() for _ in range(r.randint(1, 5))) + r.choice(marks) for _ in range(100_000)]
    texts += [" ".join(r.sample(texts, 6)) for _ in range(2_000)]
    whole, apart = Tokenizer.from_file(WORDS), simple8b.WordTokenizer(WORDS)
    assert apart.by_word
    ids, counts = apart(pa.array(texts))
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, want))
    assert ids.tolist() == [i for w in want for i in w]


def test_another_kind_of_file_gets_whole_texts():
    import pyarrow as pa

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, apart = Tokenizer.from_file(path), simple8b.WordTokenizer(path)
    texts = ["Two  words here.", "", "a\nb İ."]
    assert not apart.by_word
    assert apart(pa.array(texts))[0].tolist() == [i for t in texts for i in whole.encode(t, add_special_tokens=False).ids]


# Language model


def base(rows):
    counts = Counter()
    tokens = []
    for i, t, _ in rows:
        w = [*(t or "").encode().lower().split(), None]
        tokens.append(w)
        if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    return n, [(i, len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)) for (i, _, _), w in zip(rows, tokens, strict=True)]


@pytest.mark.parametrize("frequent", [1 << 17, 10])
def test_base_scores_by_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(mixing, "FREQUENT", frequent)
    monkeypatch.setattr(mixing, "BLOCK_BYTES", 20_000)
    n, want = base(data.texts())
    docs = data.docs(spark)
    got = mixing.score(docs, mixing.held_out(F.col("doc_id"))).collect()
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:3], round(r[3], 6))
    assert sorted(key((r.doc_id, r.n_tokens, r.n_known, r.base_score)) for r in got) == sorted(map(key, want))
    assert all(r.train_tokens == n and r.score < 0 and math.isfinite(r.score) for r in got)
    assert mixing.score(data.empty(spark), mixing.held_out(F.col("doc_id"))).count() == 0


def rows_of(text, at, sizes):
    """Of the byte at a place: each predictor's four rows, by the definition and in whole numbers."""
    seen, c = bytes(8) + text[:at], text[at]
    inside = 0
    while inside < 8 and seen[len(seen) - 1 - inside] > 32:
        inside += 1
    word = int.from_bytes(seen[len(seen) - inside :].rjust(8, b"\0"), "little")
    first, out = 0, []
    for k, key in enumerate((int.from_bytes(seen[-3:], "little"), int.from_bytes(seen[-6:], "little"), word)):
        h = (key + k + 1) * int(mixing._ODD[k]) % 2**64 >> 32
        bits = int(sizes[k]).bit_length() - 1
        out.append([first + ((h ^ (4**i | c >> 8 - 2 * i) * 0x85EBCA6B % 2**32) * 0x9E3779B1 % 2**32 >> 32 - bits) for i in range(4)])
        first += int(sizes[k])
    return out


class Plain:
    """The model bit by bit and byte by byte, with sums over a text's bytes since the last update."""

    def __init__(self, sizes):
        self.sizes, self.counts = sizes, Counter()

    def count(self, text):
        for at in range(len(text)):
            for places in rows_of(text, at, self.sizes):
                for i, row in enumerate(places):
                    self.counts[row, text[at] >> 6 - 2 * i & 3] += 1

    def inputs(self, text, at):
        out = []
        for places in rows_of(text, at, self.sizes):
            x = []
            for i, row in enumerate(places):
                c, v = [self.counts[row, j] for j in range(4)], text[at] >> 6 - 2 * i & 3
                for one, none in ((c[2] + c[3], c[0] + c[1]), (c[v & 2 | 1], c[v & 2])):
                    x.append(max(-127, min(127, round(math.log((one + mixing.PRIOR) / (none + mixing.PRIOR)) * mixing.SCALE))) / mixing.SCALE)
            out.append(x)
        return out

    def score(self, text, weights, first):
        weights, uses, ones, total = weights.astype(float), np.zeros(mixing.CELLS), np.zeros(mixing.CELLS), 0.0
        for begin in range(0, len(text), mixing.TURN):
            steps, seen, use, one = np.zeros_like(weights), np.zeros(mixing.GATES), np.zeros(mixing.CELLS), np.zeros(mixing.CELLS)
            for at in range(begin, min(begin + mixing.TURN, len(text))):
                x = self.inputs(text, at)
                gate = sum(x[k][0] != 0 for k in mixing.LONGER)
                seen[gate] += 1
                for b in range(8):
                    bit = text[at] >> 7 - b & 1
                    s = max(-11.5, min(11.5, sum(x[k][b] * weights[k, gate, b] for k in range(mixing.P))))
                    p, cell = 1 / (1 + math.exp(-s)), b * mixing.STEPS + int((s + 12) * mixing.STEPS / 24)
                    q = (p + (ones[cell] + mixing.FIRM * first[cell]) / (uses[cell] + mixing.FIRM)) / 2
                    total += math.log(q if bit else 1 - q)
                    use[cell] += 1
                    one[cell] += bit
                    for k in range(mixing.P):
                        steps[k, gate, b] += (bit - p) * x[k][b]
            weights += mixing.RATE * steps / np.sqrt(np.maximum(seen, 1))[None, :, None]
            uses, ones = uses + use, ones + one
        return total


def test_scores_are_those_of_the_plain_model(monkeypatch):
    monkeypatch.setattr(mixing, "TURN", 50)
    sizes = mixing.sizes_of(1)
    texts = [mixing.normal(t) for t in (b"the cat sat on the mat", b"The dog sat  on a LOG", b"", None, b"x", "Ünïcode wörds and averyverylongwordthatgoeson and on".encode() * 3)]
    plain = Plain(sizes)
    counts = np.zeros(4 * int(sizes.sum()), np.uint32)
    for t in texts[:3]:
        plain.count(t)
        for d, at in mixing._pieces([t]):
            for e in mixing.entries(d, at, sizes):
                np.add.at(counts, e.ravel(), np.uint32(1))
    assert {(i // 4, i % 4): int(c) for i, c in enumerate(counts) if c} == dict(plain.counts)
    r = np.random.default_rng(1)
    weights, uses, ones = r.normal(0.3, 0.2, (mixing.P, mixing.GATES, 8)), np.full(mixing.CELLS, 9.0), r.integers(0, 9, mixing.CELLS)
    model = mixing.Model(sizes, mixing.stretched(counts), weights, uses, ones)
    got, want = model.score(texts)[0], [plain.score(t, weights, model.first) for t in texts]
    assert got == pytest.approx(want, rel=1e-5)
    alone = [model.score([t])[0][0] for t in texts]
    assert alone == pytest.approx(got.tolist(), rel=1e-9)
    monkeypatch.setattr(mixing, "GROUP", 100)  # a multiple of TURN; long texts are then coded in pieces
    monkeypatch.setattr(mixing, "PIECE", 30)
    assert model.score(texts)[0] == pytest.approx(got, rel=1e-9)


def test_the_bytes_after_any_text_are_a_distribution():
    sizes = mixing.sizes_of(1)
    model = mixing.Model(sizes, mixing.stretched(np.random.default_rng(0).integers(0, 5, 4 * int(sizes.sum())).astype(np.uint32)))
    state = lambda: mixing.State(model, 256)
    after = b"the ca"
    before = model.score([after])[0][0]
    odds = state().code(*mixing.laid_out([after + bytes([c]) for c in range(256)]), np.full(256, len(after) + 1))
    assert np.exp(odds - before).sum() == pytest.approx(1, abs=1e-4)


def test_scores_do_not_depend_on_partitions(spark):
    docs = data.docs(spark)
    key = lambda r: (-1 if r.doc_id is None else r.doc_id, round(r.base_score, 6), round(r.score, 4), r.n_bytes)
    a, b = (sorted(map(key, mixing.score(docs.repartition(n, "text"), mixing.held_out(F.col("doc_id"))).collect())) for n in (1, 5))
    assert [x[:2] + x[3:] for x in a] == [x[:2] + x[3:] for x in b] and [x[2] for x in a] == pytest.approx([x[2] for x in b], rel=1e-5)


def test_held_out_documents_cost_less_than_by_their_bytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in queries.op3_lm_scoring(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    texts = {r.doc_id: mixing.normal((r.text or "").encode()) for r in docs.collect()}
    assert all(r.n_bytes == len(texts[r.doc_id]) for r in got)
    counts = Counter(b"".join(texts[r.doc_id] for r in got))
    n = sum(counts.values())
    bits = -sum(r.score for r in got) * math.log2(10)
    assert bits < 0.75 * -sum(c * math.log2(c / n) for c in counts.values())
    # The base is no distribution (every unseen word has the same share, whatever there is of them), so on so few documents it looks better
    # than it is. On sf0.1, the model is ahead of it: the README has the figures.
    assert sum(r.score for r in got) > 1.1 * sum(r.base_score for r in got)


def test_without_training_rows_scores_are_finite(spark):
    docs = data.docs(spark).limit(5)
    got = mixing.score(docs, F.lit(True)).collect()
    assert all(r.base_score == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)


def test_words_over_the_start_of_a_piece_keep_their_contexts():
    sizes = mixing.sizes_of(1)
    text = b"a" * (mixing.PIECE + 5) + b" some words " + b"bcdefghijk" * mixing.PIECE
    data, starts = mixing.laid_out([text])
    at = mixing.spread(starts, np.array([len(text)]))
    whole = [e.copy() for e in mixing.entries(data, at, sizes)]
    for i, part, some in mixing.walked(data, at):
        for e, w in zip(mixing.entries(part, some, sizes), whole, strict=True):
            assert (e == w[i]).all()


def test_the_sample_of_the_language_classifier_is_bounded_whatever_the_ids(spark):
    words = [f"w{''.join(chr(97 + int(c)) for c in str(i))}" for i in range(300)]
    for ids in (range(300), [None] * 300, [7] * 300):
        docs = spark.createDataFrame([(i, w, "aa") for i, w in zip(ids, words, strict=True)] + [(1, "zz", "bb")] * 50 + [(2, None, "cc")], "doc_id long, text string, lang string")
        model = langid.fit(docs, fit_rows=40)
        assert model.langs == ["aa", "bb"] and len(model.words) == 41
        counts = [langid.fit(docs.repartition(n), fit_rows=40).words.keys() for n in (1, 5)]
        assert counts[0] == counts[1] == model.words.keys()


def test_all_training_texts_fit_the_weights_and_the_map(spark, monkeypatch):
    made = []
    begin = mixing.Training.__init__
    monkeypatch.setattr(mixing.Training, "__init__", lambda self, *args: (begin(self, *args), made.append(self))[0])
    texts = [(i, f"text number {i} of some, again and again {i * i}") for i in range(60)] + [(60, None), (61, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    held = {r.doc_id for r in docs.where(mixing.held_out(F.col("doc_id"))).collect()}
    assert mixing.score(docs, mixing.held_out(F.col("doc_id"))).count() == 62
    bits = 8 * sum(len(mixing.normal((t or "").encode())) for i, t in texts if i not in held)
    assert made[0].map[0].sum() == bits


def test_bytes_that_come_again_are_fitted_once_with_all_their_counts(monkeypatch):
    words = ["the", "cat", "sat", "onthematagain", "Ünïcode", "x", "averyverylongword"]
    r = np.random.default_rng(5)
    texts = [mixing.normal(" ".join(r.choice(words, 300)).encode()) for _ in range(20)] + [b"\n", b"x\n"]
    sizes, n = mixing.sizes_of(1), sum(map(len, texts))
    one, by, rows = *(np.zeros(4 * int(sizes.sum()), np.uint32) for _ in range(2)), []
    for data, at in mixing._pieces(texts):
        for e in mixing.entries(data, at, sizes):
            np.add.at(one, e.ravel(), np.uint32(1))
        rows += [x.row() for x in mixing.Seen.of(data, at).parts(100)]
    seen = [mixing.Seen.read(row) for row in rows]
    for x in seen:
        for e in mixing.places(x.back, x.inside, x.symbol, sizes):
            np.add.at(by, e.ravel(), np.repeat(x.times, 4))
    assert (by == one).all() and one.sum() == 12 * n and len(rows) > 1
    assert sum(len(x.back) for x in seen) < n / 10 and sum(int(x.times.sum()) for x in seen) == n

    # The sums of a Newton step and the map are those over every byte on its own.
    model = mixing.Model(sizes, mixing.stretched(one))
    training = object.__new__(mixing.Training)
    each = [mixing.Seen(*mixing.before(data, at), data[at], np.ones(len(at), np.uint32)) for data, at in mixing._pieces(texts)]
    found = []
    for parts in (seen, each):
        training.weights = None
        monkeypatch.setattr(training, "_sums", lambda _, run, parts=parts: dict(enumerate(sum(run(model, x) for x in parts))), raising=False)
        training._newton(None)
        training._fill(None)
        found.append((training.weights, *training.map))
    assert all(a == pytest.approx(b, rel=1e-6) for a, b in zip(*found, strict=True))
