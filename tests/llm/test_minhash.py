import random

import numpy as np
import pytest

from graphfeed.llm import minhash as M
from graphfeed.llm.components import components


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if len(words) >= k else {tuple(words)}


def brute(rows, k, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = {}
    for (i, _), g in zip(rows, group, strict=True):
        if i is not None:
            ids[g] = min(ids.get(g, i), i)
    return [(i, len(s), ids.get(g) if s else i) for (i, _), s, g in zip(rows, sets, group, strict=True)]


def _rows():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, base = [], [rng.choice(vocabulary) for _ in range(120)]
    for i in range(150):  # one large group of near copies, with similarities around the threshold
        words = list(base)
        for _ in range(rng.randrange(7)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((1000 - i, " ".join(words)))
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 60))]
        rows += [(2000 + 3 * i, " ".join(words)), (2001 + 3 * i, " ".join(words + ["tail"])),
                 (2002 + 3 * i, " ".join(words[: len(words) // 2] * 2))]
    rows += [(5000 + i, "Same Text of all the copies Here") for i in range(100)]
    return rows + [(1, None), (2, ""), (3, " \n "), (4, "one two"), (5, "ONE two"), (6, "one two three"),
                   (None, "same text of all the copies here"), (None, "lonely words without any id here now"),
                   (None, "lonely words without any id here now"), (7, "z " * 30_000), (8, "z " * 20_000), (4, "one two")]


@pytest.mark.parametrize("k", [4, 5])
def test_components_are_exact(frame, k):
    rows = _rows()
    got = M.near_duplicates(frame(rows), shingle_words=k).collect()
    assert sorted(str((r._id, r.n_shingles, r.component_id)) for r in got) == sorted(map(str, brute(rows, k)))


def test_one_row_of_each_group_stays(frame):
    rows = _rows()
    docs = frame(rows)
    out = M.deduplicated(docs)
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == docs.columns
    groups = {(c, None if c is not None else t) for (i, t), (_, n, c) in zip(rows, brute(rows, 5), strict=True) if n}
    blank = sum(not shingles(t, 5) for _, t in rows)
    assert len(kept) == len(groups) + blank
    assert {i for i, t in kept if shingles(t, 5) and i is not None} == {c for c, _ in groups if c is not None}


def test_empty(frame):
    docs = frame([(1, "a")])
    assert M.near_duplicates(docs.limit(0)).count() == 0 and M.deduplicated(docs.limit(0)).count() == 0
    assert M.near_duplicates(docs).first().component_id == 1


def test_posterior_bound():
    """A pair at the threshold is dropped with about the chosen probability, one far below almost always."""
    random_ = np.random.default_rng(1)
    table = M.least_matches(miss=1e-2)

    def dropped(similarity):
        hits = random_.random((20_000, M.HASHES)) < similarity
        return np.any([hits[:, :n].sum(1) < least for n, least in table], axis=0).mean()

    assert dropped(0.8) < 0.1 and dropped(0.5) > 0.99
    assert [n for n, _ in table] == list(range(M.BATCH, M.HASHES + 1, M.BATCH))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000, i) for i in range(1001, 1200)]
    edges += [(i, i + 1) for i in range(2000, 2060)]
    group = {n: n for e in edges for n in e}
    for a, b in edges:
        low, high = sorted((group[a], group[b]))
        group = {n: low if g == high else g for n, g in group.items()}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: g for n, g in group.items() if n in got}
    assert {n for n, g in group.items() if sum(x == g for x in group.values()) > 1} == set(got)
