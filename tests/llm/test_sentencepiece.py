import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece as library
from pyspark.sql import functions as F

from graphfeed.llm import sentencepiece as S


@pytest.fixture(scope="module")
def vocabulary():
    return S.load()


@pytest.fixture(scope="module")
def coder(vocabulary):
    return S.Coder(vocabulary)


def _varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


@pytest.fixture(scope="module")
def unigram():
    """The library on the same pieces, told that the model is of the unigram type."""
    data, out = open(S.VOCABULARY, "rb").read(), b""
    for number, value in S._fields(data):
        value += b"\x18\x01" if number == 2 else b""
        out += _varint(number << 3 | 2) + _varint(len(value)) + value
    return library.SentencePieceProcessor(model_proto=out)


def test_trie_holds_the_pieces(vocabulary):
    trie = vocabulary.trie
    for i, (piece, kind) in enumerate(zip(vocabulary.pieces, vocabulary.kinds, strict=True)):
        if kind != S.NORMAL:
            continue
        state = 0
        for byte in piece.encode():
            to = trie.base[state] + byte
            assert trie.check[to] == state
            state = to
        assert trie.value[state] == i


def brute(unit, vocabulary):
    """Best total score over all ways to cut a short unit."""
    score = {p: s for p, s, k in zip(vocabulary.pieces, vocabulary.scores, vocabulary.kinds, strict=True)
             if k == S.NORMAL}
    best = [0.0] + [None] * len(unit)
    for end in range(1, len(unit) + 1):
        ways = [best[a] + score[unit[a:end]] for a in range(end) if unit[a:end] in score]
        if unit[end - 1] not in score:
            ways.append(best[end - 1] + vocabulary.least)
        best[end] = max(ways)
    return best[-1]


def test_best_score(vocabulary, coder):
    rng = random.Random(4)
    for _ in range(300):
        unit = "▁" + "".join(rng.choice("abcdehinorst漢é") for _ in range(rng.randrange(1, 12)))
        ids = coder.segment(unit)
        kinds = [vocabulary.kinds[i] for i in ids]
        runs = sum(unit.count(c) for c in set(unit) if c not in vocabulary.pieces)
        total = sum(vocabulary.scores[i] for i, k in zip(ids, kinds, strict=True) if k == S.NORMAL)
        assert total + runs * vocabulary.least == pytest.approx(brute(unit, vocabulary))


WORDS = "the naïve reader ariear Erthenin considers internationalisation 漢字 \U0001f600 ß x▁y".split()


def test_agrees_with_the_library(coder, unigram):
    for word in [*WORDS, " a  b ", "\n\n a", "   ", "a\tb"]:
        best = unigram.nbest_encode_as_ids(word, 8)[0]  # its lattice search, not its shortcut
        assert coder.encode(word) == best
        assert coder.decode(coder.encode(word)) == unigram.decode(best)


def test_words_one_by_one_or_together(vocabulary, coder):
    text = "the  internationalisation of\nwords \n 漢 and " * 3
    assert coder.encode(text) == coder.segment(coder.normalised(text))


def test_round_trip(frame, spark):
    texts = [None, "", " ", "a", "  lead and trail  ", "é漢\U0001f600\x00\x01 tab\tline\n\r\n", "long" * 60_000,
             "x " * 50_000, "▁", "a", "a"]
    docs = frame(enumerate(texts))
    rows = S.encoded(docs, F.col("doc_id"), F.col("text"))
    back = {r._id: r for r in S.decoded(rows).collect()}
    for i, text in enumerate(texts):
        assert back[i].text == (text or "").replace("▁", " ")
        assert back[i].lossless == ("▁" not in (text or "")) and back[i].n_pieces == len(back[i].ids)
    assert S.encoded(docs.limit(0), F.col("doc_id"), F.col("text")).count() == 0
    nothing = spark.createDataFrame([(1, None)], "text long, ids array<int>")
    assert S.decoded(nothing).first().text is None


def test_side_by_side_as_alone(vocabulary, coder):
    rng = random.Random(5)
    units = ["".join(rng.choice("▁abcdehinorst漢é\U0001f600") for _ in range(rng.randrange(1, 14)))
             for _ in range(500)]
    for places, rows in S.by_size(((u.encode(), i) for i, u in enumerate(units)), 7):
        flat, stops = coder.lattice.best(rows)
        for i, first, stop in zip(places, [0, *abs(stops)[:-1]], stops, strict=True):
            alone = coder.segment(units[i])
            unknown = any(vocabulary.kinds[p] == S.BYTE for p in alone)
            assert (stop < 0) == unknown and (unknown or flat[first:stop].tolist() == alone)


def test_sums_of_a_word_alone_as_side_by_side(vocabulary):
    coder = S.Coder(vocabulary.rescored(np.arange(len(vocabulary.pieces)) % 7))
    rng = random.Random(7)
    for size in (1, 5, 80, 300):
        unit = "▁" + "".join(rng.choice("abcdehinorst漢é") for _ in range(size))
        alone, together = (np.zeros(len(vocabulary.pieces), np.int64) for _ in range(2))
        coder.expected(unit, 3, alone)
        for counts, rows in S.by_size([(unit.encode(), 3)]):
            coder.lattice.expected(rows, np.array(counts), together)
        assert np.abs(alone - together).max() <= size and alone.sum() > 0


def test_words_of_the_generation_before(vocabulary, monkeypatch):
    monkeypatch.setattr(S, "REMEMBERED", 5)
    coder = S.Coder(vocabulary)
    texts = [[f"▁{w}{i}" for w in ("the", "and", "reader")] for i in range(8)]
    for units in [*texts, *texts]:
        coder.remember([units])
        assert coder.joined(units).tolist() == [p for u in units for p in coder.segment(u)]
        assert len(coder.known) + len(coder.before) <= 16


def cuts(unit, score):
    if not unit:
        yield []
    for n in range(1, len(unit) + 1):
        if unit[:n] in score:
            yield from ([unit[:n], *rest] for rest in cuts(unit[n:], score))


def test_expected_counts_are_sums_over_all_cuts(spark, vocabulary):
    rescored = vocabulary.rescored(np.arange(len(vocabulary.pieces)) % 7)
    score = {p: s for p, s, k in zip(rescored.pieces, rescored.scores, rescored.kinds, strict=True)
             if k == S.NORMAL}
    assert sum(np.exp(list(score.values()))) == pytest.approx(1)
    words, want = {"▁the": 5, "▁reader": 2, "▁naïve": 3, "\n": 4}, {}
    for word, n in words.items():
        ways = list(cuts(word, score))
        weights = np.exp([sum(score[p] for p in way) for way in ways])
        for way, weight in zip(ways, weights / weights.sum() if ways else [], strict=True):
            for piece in way:
                want[piece] = want.get(piece, 0) + n * weight
    got = S.expected_counts(spark.createDataFrame(list(words.items()), "unit string, n long"), rescored)
    assert {rescored.pieces[i]: got[i] for i in np.flatnonzero(got)} == pytest.approx(
        {p: w for p, w in want.items() if w >= 0.5 / S.UNITS}, abs=1e-2)


def test_frequent_words_are_whole_pieces(frame):
    text = "the reader and the information of the other people"
    docs = frame([(i, text) for i in range(20)])
    vocabulary = S.load()
    for row in S.encoded(docs, F.col("doc_id"), F.col("text")).collect():
        assert [vocabulary.pieces[i] for i in row.ids] == ["▁" + w for w in text.split()]


def test_every_word_is_counted(frame, vocabulary, monkeypatch):
    monkeypatch.setattr(S, "COUNTED", 3)  # counts go out whenever so many words are held
    docs = frame([(1, "a b c d e f a"), (2, "a\nb " + "x" * 500), (3, None)])
    got = {r.unit: r.n for r in S.word_counts(docs, F.col("text"), vocabulary).collect()}
    assert got == {"▁a": 3, "▁b": 1, "b": 1, "▁c": 1, "▁d": 1, "▁e": 1, "▁f": 1, "\n": 1, "▁" + "x" * 500: 1}


def test_units_of_many_texts_as_of_each(vocabulary):
    texts = ["a b  a\nb \n\n c", "▁▁ x▁y", "", " \n ", "漢 \U0001f600 a", "x" * 300, "a\tb\x1f c\u00a0d"]
    normal = [vocabulary.normalised(text) for text in texts]
    units, order, ends = vocabulary.unit_table(normal)
    assert len(set(units)) == len(units) and ends[-1] == len(order)
    for own, first, end in zip(normal, [0, *ends[:-1]], ends, strict=True):
        assert [units[i] for i in order[first:end] if units[i]] == vocabulary.units(own)


def test_pieces_strung_from_distinct_units(coder, vocabulary):
    texts = ["the reader and the 漢 reader", "x" * 200 + " the", "", "and\nthe"]
    normal = [vocabulary.normalised(text) for text in texts]
    units, order, ends = vocabulary.unit_table(normal)
    coder.remember([units])
    flat, stops = coder.strung(units, order)
    for text, first, end in zip(texts, [0, *stops[ends - 1][:-1]], stops[ends - 1], strict=True):
        assert flat[first:end].tolist() == coder.encode(text)


def test_texts_taken_together_stay_small_in_memory(coder, vocabulary):
    rng = random.Random(9)
    words = [f"{rng.getrandbits(40):x}" for _ in range(5000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(700)]  # three million characters in one batch
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["_text"])
    coder.remember([vocabulary.units(vocabulary.normalised(" ".join(words)))])
    n_texts = most = 0
    for part, own in S.parted(batch):
        tracemalloc.start()
        units, order, ends = vocabulary.unit_table([vocabulary.normalised(text) for text in own])
        coder.strung(units, order)
        most = max(most, tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        n_texts += len(part)
    assert n_texts == len(texts)
    assert most < 30e6


def test_sums_with_and_without_logarithms(vocabulary, monkeypatch):
    lattice = S.Lattice(vocabulary.rescored(np.arange(len(vocabulary.pieces)) % 7))
    rng = random.Random(8)
    units = ["▁" + "".join(rng.choice("abcdehinorst漢é\U0001f600") for _ in range(rng.randrange(1, 9)))
             for _ in range(300)]
    plain, logs = (np.zeros(len(vocabulary.pieces), np.int64) for _ in range(2))
    for into, most in ((plain, S.PLAIN), (logs, -1.0)):
        monkeypatch.setattr(S, "PLAIN", most)
        for _, rows in S.by_size((u.encode(), 1) for u in units):
            lattice.expected(rows, np.ones(len(rows), np.int64), into)
    assert np.abs(plain - logs).max() <= 2 and plain.sum() > 0


def test_counted_words_by_size():
    words = {"▁the": 5, "▁né": 2, "abcd": 3, "x" * 100: 7, "▁a": 1, "éa": 4}
    whole = pa.RecordBatch.from_pydict({"unit": list(words), "n": list(words.values())})
    for batches in ([whole], [whole.slice(0, 2), whole.slice(2)]):
        alone, got = [], {}
        for counts, rows in S.counted_by_size(batches, lambda unit, n: alone.append((unit, n)), 2):
            got |= {row.tobytes().decode(): n for row, n in zip(rows, counts, strict=True)}
        assert got | dict(alone) == words and alone == [("x" * 100, 7)]


def test_words_do_not_walk_the_trie_offset_by_offset(vocabulary):
    """The trie is walked once per length of piece, not once per offset and length."""
    class Counting(np.ndarray):
        walks = 0

        def __getitem__(self, key):
            Counting.walks += 1
            return np.asarray(self)[key]

    lattice = S.Lattice(vocabulary)
    lattice.base = lattice.base.view(Counting)
    word = "▁internationalisationsinternationalisation".encode()
    lattice.best(np.frombuffer(word, np.uint8).reshape(1, -1))
    assert Counting.walks <= 1 + max(len(p.encode()) for p in vocabulary.pieces)
