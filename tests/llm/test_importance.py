"""Importance resampling against a plain computation over all features."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphfeed.llm import importance as I

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return words, [zlib.crc32(f.encode()) % 10_000 for f in
                   words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]]


def brute(docs, target):
    raw, wanted = [0] * 10_000, [0] * 10_000
    for counts, texts in ((raw, [t for _, t in docs]), (wanted, target)):
        for text in texts:
            for bucket in features(text)[1]:
                counts[bucket] += 1
    gain = [math.floor(1000 * math.log(((t + 1) * (sum(raw) + 10_000)) / ((s + 1) * (sum(wanted) + 10_000))))
            for s, t in zip(raw, wanted, strict=True)]
    rows, able = [], []
    for doc_id, text in docs:
        words, own = features(text)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(own), weight,
                     weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(words) >= 20:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, row in enumerate(able[:25 * len(able) // 100]):
        row[4] = i + 1
    return sorted(map(tuple, rows), key=str)


def drawn(docs, target):
    return sorted(map(tuple, I.resampled(docs, target, F.col("doc_id"), F.col("text"), F.col("text")).collect()),
                  key=str)


def test_against_brute_force(spark, frame):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdeé1") for _ in range(rng.randrange(1, 7))) for _ in range(300)]

    def text():
        return "".join(rng.choice(vocabulary).title() + rng.choice([" ", "  ", ". ", "-", "\n", "日本 "])
                       for _ in range(rng.randrange(60)))

    rows = [(i, text()) for i in range(400)]
    rows += [(None, None), (None, text()), (900, "x" * 100_000), (901, ""), (902, "?! ")]
    rows += [(3, "again " * 30)] * 2  # repeated rows tie
    target = [text() for _ in range(20)] + [None]
    docs = frame(rows).repartition(5)
    got = drawn(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    assert got == brute(rows, target)
    assert sum(r[4] is not None for r in got) > 40


def test_crc_of_words_and_pairs():
    rng = random.Random(2)
    words = ["".join(rng.choice("abé0") for _ in range(rng.choice([1, 2, 3, 9, 33, 700]))).encode()
             for _ in range(300)]
    sizes = np.array([len(w) for w in words])
    hasher = I.Hasher()
    crc = hasher.words(np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes, sizes)
    assert crc.tolist() == [zlib.crc32(w) for w in words]
    assert hasher.pairs(crc[:-1], crc[1:], sizes[1:]).tolist() == [
        zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:], strict=False)]


@pytest.mark.parametrize("error", [None, 1e-6])
def test_cutoff_is_the_kth_value(spark, error):
    rng = random.Random(5)
    values = [rng.randrange(50) for _ in range(2000)] + [7] * 900
    rows = spark.createDataFrame([(v,) for v in values], "score long")
    for k in (1, 10, 725, 2899, 2900):
        # a bracket that starts too narrow is widened
        assert I.cutoff(rows, 2900, k, 50, error) == sorted(values, reverse=True)[k - 1]
    assert I.cutoff(rows, 2900, 0) is None


def test_empty(frame):
    docs = frame([(1, "a b")])
    assert drawn(docs.limit(0), docs) == []
    assert drawn(docs, docs.limit(0))[0][4] is None
