"""The divergence audit against a plain count, and the transducer against the sorted list."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphfeed.llm import divergence as D

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(docs, least):
    seen, counts, groups = {}, {}, {}
    for row in docs:
        lang, source = row.lang or "", row.source or ""
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row.text or "")
        groups.setdefault(lang, set()).add(source)
        terms = TERM.findall(text)
        for term in set(terms):
            seen[lang, term] = seen.get((lang, term), 0) + 1
        for term in terms:
            counts[lang, source, term] = counts.get((lang, source, term), 0) + 1
    out = []
    for lang, sources in groups.items():
        kept = sorted((t for (la, t), n in seen.items() if la == lang and n >= least), key=str.encode)

        def shares(own, lang=lang, kept=kept):
            n = [sum(counts.get((lang, s, t), 0) for s in own) for t in kept]
            return n, [1 + 10**9 * (c + 5) // (sum(n) + 5 * len(kept)) for c in n]

        q = shares(sources)[1]
        by_source = {s: shares([s]) for s in sources}
        for source in sources:
            n, p = by_source[source]
            parts = {
                "pair": [(sum(abs(x - y) for x, y in zip(p, by_source[o][1], strict=True)), o)
                         for o in sources - {source}],
                "term": [(x - y, t) for x, y, c, t in zip(p, q, n, kept, strict=True) if c > 0 and x > y]}
            for part, rows in parts.items():
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(rows)
                        if part == "pair" or i < 50]
    return sorted(out, key=str)


def audited(docs, **options):
    return sorted(map(tuple, D.audited(docs, F.col("text"), F.col("lang"), F.col("source"),
                                       **options).collect()), key=str)


@pytest.fixture(scope="module")
def docs(frame):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 6))) for _ in range(300)]

    def text():
        return "".join(rng.choice(vocabulary).title() + rng.choice([" ", "1", ". ", "日本 "])
                       for _ in range(rng.randrange(60)))

    rows = [(i, text(), f"s{min(rng.randrange(9), 5)}", rng.choice(["en", "de", None])) for i in range(400)]
    rows += [(None, None, None, "en"), (1, "", "a", "xx"), (1, "one", "b", "xx"), (2, None, None, None),
             (7, "qq " * 50_000, "s1", "en")]
    return frame(rows + rows[:3])


@pytest.mark.parametrize("least", [5, 30, 10_000])
def test_against_brute_force(docs, least):
    # several blocks and slices, chunks of few terms, few sources at once
    old = D.CHUNK, D.SOURCES, D.SLICE
    D.CHUNK, D.SOURCES, D.SLICE = 64, 4, 5000
    try:
        got = audited(docs.repartition(4), least_docs=least, block_bytes=20_000)
    finally:
        D.CHUNK, D.SOURCES, D.SLICE = old
    assert got == brute(docs.collect(), least)


def test_transducer_gives_places_and_is_minimal():
    rng = random.Random(3)
    terms = sorted({"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 6))).encode() for _ in range(900)})
    others = [b"a" * 9, b"zz", terms[5] + b"\xc3", terms[-1][:-1] + b"z"]
    every = terms + [o for o in others if o not in terms]
    sizes = np.array([len(t) for t in every])
    machine = D.Transducer(terms)
    places = machine.places(np.frombuffer(b"".join(every), np.uint8), np.cumsum(sizes) - sizes, sizes)
    assert places.tolist() == [*range(len(terms)), *[-1] * (len(every) - len(terms))]
    # as many states as there are different sets of endings
    endings = {}
    for term in terms:
        for i in range(len(term) + 1):
            endings.setdefault(term[:i], set()).add(term[i:])
    assert len(machine.final) == len({frozenset(e) for e in endings.values()})


def test_empty(frame):
    assert audited(frame([(1, "a")]).limit(0)) == []
