"""Repeated byte strings against a plain count of all of them."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from graphfeed.llm import suffix_dedup as D


def brute(rows, length):
    texts = [(r.doc_id, (r.text or "").encode()) for r in rows]
    seen = {}
    for _, data in texts:
        for p in range(len(data) - length + 1):
            seen[data[p:p + length]] = seen.get(data[p:p + length], 0) + 1
    out = []
    for doc_id, data in texts:
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if seen[data[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(docs, length, **sizes):
    rows = D.deduplicated(docs, F.col("doc_id"), F.col("text"), length=length, **sizes)
    return sorted(((r._id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest())
                   for r in rows.collect()), key=str)


def passages(seed, length):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé ") for _ in range(1200)) for _ in range(4)]
    rows = []
    for i in range(50):
        text = ""
        for _ in range(rng.randrange(6)):
            at = rng.randrange(1100)
            text += rng.choice(base)[at:at + rng.randrange(5, 3 * length)]
            text += "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60)))
        rows.append((i, text))
    # repeated rows, nulls, overlaps with itself, just below and at the length
    rows += [(100, rows[3][1])] * 2 + [(None, None), (None, ""), (101, "ab" * 1500),
             (102, "x" * (length - 1)), (103, "x" * length), (104, "y" * (length + 1))]
    return rows


@pytest.mark.parametrize("length", [11, 40, 400])
def test_against_all_strings(frame, length):
    docs = frame(passages(length, length)).repartition(3)
    # small blocks and parts: strings are shared within and between them
    assert found(docs, length, block_bytes=9000, part_keys=3000) == brute(docs.collect(), length)


def test_hot_text_and_very_long_text(frame):
    rng = random.Random(4)
    long = "".join(rng.choice("abcdef ") for _ in range(400_000))
    rows = [(i, "the same line of text in every copy " * 20) for i in range(300)]
    rows += [(1000, long), (1001, "short"), (1002, "z" * 50 + long[1000:1600] + "z" * 50)]
    got = {r[0]: r for r in found(frame(rows), 400, block_bytes=50_000)}
    assert all(got[i][2] == got[i][1] for i in range(300))
    assert got[1000][2:4] == (600, 1) and got[1002][2:4] == (600, 1) and got[1001][2] == 0


def test_empty(frame):
    assert found(frame([(1, "a")]).limit(0), 400) == []


def test_covers_bring_all_differences():
    for v, cover in D.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    assert D.modulus(400) == 91
    with pytest.raises(ValueError):
        D.modulus(10)
