import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphfeed.llm import ngram_lm as L


def brute(docs, order, mu):
    seqs = [["", *(w.decode() for w in (t or "").encode().lower().split()), ""] for _, _, t in docs]
    counts = [Counter() for _ in range(order + 1)]
    for (_, train, _), s in zip(docs, seqs, strict=True):
        for i in range(1, len(s)) if train else ():
            for n in range(1, order + 1):
                if i - n + 1 >= 0:
                    counts[n][tuple(s[i - n + 1:i + 1])] += 1
    total, distinct = sum(counts[1].values()), len(counts[1])
    starts = sum(train for _, train, _ in docs)

    def seen(context):
        return starts if context == ("",) else counts[len(context)][context]

    def chance(s, i, n):
        if n == 1:
            return (counts[1][s[i],] + 0.5) / (total + 0.5 * (distinct + 1))
        if i - n + 1 < 0:
            return chance(s, i, n - 1)
        gram = tuple(s[i - n + 1:i + 1])
        return (counts[n][gram] + mu * chance(s, i, n - 1)) / (seen(gram[:-1]) + mu)

    return [(len(s) - 1, sum(counts[1][w,] > 0 for w in s[1:]),
             sum(math.log10(chance(s, i, 1)) for i in range(1, len(s))),
             sum(math.log10(chance(s, i, order)) for i in range(1, len(s)))) for s in seqs]


def _docs():
    rng = random.Random(8)
    docs = [(i, rng.random() < 0.8, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(30))))
            for i in range(120)]
    return docs + [(500, True, None), (501, False, ""), (502, False, "unseen ZZZ a"), (503, True, "A b\x1cé\xa0x\nÀ"),
                   (None, True, "a b"), (7, True, "a b c"), (7, True, "a b c"), (504, True, "a b " * 20_000)]


@pytest.mark.parametrize("order, block, part", [(1, 10**6, 10**6), (2, 10**6, 10**6), (2, 200, 50), (3, 300, 100), (4, 500, 400)])
def test_scores_are_those_of_the_formula(spark, order, block, part):
    docs = _docs()
    frame = spark.createDataFrame([(i, *d, 1, 2) for i, d in enumerate(docs)],
                                  "row long, doc_id long, train boolean, text string, block int, n int")
    got = L.scored(frame, F.col("row"), F.col("train"), F.col("text"), order, 5.0, block, part).collect()
    assert len(got) == len(docs)
    want = brute(docs, order, 5.0)
    for r in got:
        n, known, base, score = want[r._id]
        assert (r.n_tokens, r.n_known, r.held_out) == (n, known, not docs[r._id][1])
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, rel=1e-9)


def test_next_words_sum_to_one(spark):
    """Over the vocabulary and the unknown word, in any context."""
    words = ["a", "b", "c", "never"]
    docs = [(i, True, t) for i, t in enumerate(["a b c a", "b b a", "c"])]
    probes = [(100 + i, False, f"a {w}") for i, w in enumerate(words)] + [(200, False, "a")]
    frame = spark.createDataFrame(docs + probes, "doc_id long, train boolean, text string")
    got = {r._id: r for r in L.scored(frame, F.col("doc_id"), F.col("train"), F.col("text"), 1).collect()}
    first = got[200].score  # a and the end
    end = math.log10((3 + 0.5) / (got[200].train_tokens + 0.5 * 5))
    total = sum(10 ** (got[100 + i].score - first) for i in range(4)) + 10**end
    assert total == pytest.approx(1.0)


def test_null_ids_nothing_to_learn_and_empty(spark):
    frame = spark.createDataFrame([(None, "x y"), (2**62 + 1, "x")], "doc_id long, text string")
    got = L.scored(frame, F.col("doc_id"), F.lit(False), F.col("text")).collect()
    assert {r._id for r in got} == {None, 2**62 + 1} and all(r.train_tokens == 0 and r.n_known == 0 for r in got)
    assert L.scored(frame.limit(0), F.col("doc_id"), F.lit(True), F.col("text")).count() == 0
