import math

import pytest
from pyspark.sql import functions as F

from graphfeed.llm import quality_rules as Q


def brute(text):
    words = [w for w in __import__("re").split(r"[ \t-\r]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", " \n\t ", "a", "a b", "a b c a b c", "x x x x x", "l1\nl1\n\nl2\nl1", "#$ é漢 <a>",
         "a b c d a b c e a b c", "w " * 30_000, "  nbsp x", "\x1c\x1f a"]


def test_counts(frame):
    docs = frame(enumerate(TEXTS))
    got = {r.doc_id: tuple(r[c] for c in Q.COUNTS)
           for r in Q.text_counts(docs.select("doc_id", "text")).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("k, n, share", [(0, 10, 0.1), (3, 50, 0.05), (20, 400, 0.07), (5, 5, 0.5)])
def test_binomial(spark, k, n, share):
    want = sum(math.comb(n, i) * share**i * (1 - share)**(n - i) for i in range(k + 1))
    row = spark.range(1).select(
        Q.binomial_at_most(F.lit(k), F.lit(n), share).alias("p")).first()
    assert row.p == pytest.approx(want, rel=1e-9)


@pytest.fixture(scope="module")
def labelled(frame, spark):
    good = "plain words of a text that goes on and says other things each time it is read number "
    rows = [(i, " ".join(f"{w}{i}x{j}" for j in range(5) for w in good.split()), "s", "en") for i in range(900)]
    rows += [(900 + i, " ".join(f"w{i}x{j}|#%" for j in range(60)), "s", "en") for i in range(60)]
    rows += [(2000, " ".join(f"{w}" for w in range(80)), "s", None), (2001, None), (None, "short")]
    labels = [(i, int(i < 900)) for i in range(960)] + [(5, 0), (None, 1), (7, None)]
    return frame(rows), spark.createDataFrame(labels, "doc_id long, quality int")


def test_certified_rules_reject_bad_and_keep_good(labelled):
    docs, labels = labelled
    rows = {r.doc_id: r for r in Q.verdicts(docs, labels).collect()}
    assert all(rows[i].kept for i in range(900)) and not any(rows[i].kept for i in range(900, 960))
    assert rows[900].rejected_by and not rows[900].base_failed
    assert rows[2000].kept and rows[2001].base_failed and not rows[None].kept
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.kept}


def test_few_labels_certify_nothing(labelled, spark):
    docs, _ = labelled
    few = spark.createDataFrame([(1, 1), (901, 0)], "doc_id long, quality int")
    rows = Q.verdicts(docs, few).collect()
    assert all(r.kept != r.base_failed for r in rows)


@pytest.fixture(scope="module")
def strata(frame, spark):
    """Three languages with 220 good and 30 bad labels, each with bad texts of its own kind; one
    where every good text looks bad, and one with few labels."""
    good = "plain words of a text that goes on and says other things each time it is read number ".split()
    bad = {"de": lambda i, j: f"w{i}x{j}|#%", "fr": lambda i, j: f"longwordbyitself{i}and{j}", "es": lambda i, j: "ab"[j % 2]
           + str((i + j) % 9), "it": lambda i, j: f"w{i}x{j}|#%", None: lambda i, j: f"w{i}x{j}|#%"}
    rows, labels = [], []
    for k, (lang, word) in enumerate(bad.items()):
        for i in range(250 if lang else 40):
            is_bad = i % 8 == 0
            odd = is_bad or lang == "it"
            made = [word(i, j) if odd else f"{good[j % len(good)]}{i}x{j}" for j in range(60)]
            rows.append((1000 * k + i, " ".join(made), "s", lang))
            labels.append((1000 * k + i, int(not is_bad)))
    return frame(rows), spark.createDataFrame(labels, "doc_id long, quality int"), rows, dict(labels)


def test_every_stratum_has_rules_of_its_own(strata):
    docs, labels, rows, good = strata
    got = {r.doc_id: r for r in Q.verdicts(docs, labels).collect()}
    for i, _, _, lang in rows:
        if lang in ("de", "fr", "es") and not got[i].base_failed:
            assert got[i].kept == bool(good[i]), (i, lang)
        if lang in ("it", None):
            assert got[i].kept == (not got[i].base_failed)


def test_certified_rules_by_brute_force(strata):
    """Chosen on one part of the labels, certified in sequence on the other."""
    docs, labels, rows, good = strata
    marked = Q.text_counts(docs.select(F.col("doc_id").alias("_id"), F.col("lang").alias("stratum"),
                                       F.col("text").alias("_text")), "_text").join(
        Q.labels_by_id(labels), F.col("_id") == F.col("_label_id"))
    seen = marked.select("_id", "stratum", "good", "holdout",
                         *[v.alias(n) for n, v in Q.measures().items()]).collect()
    for r in seen:
        assert r.holdout == (__import__("zlib").crc32(str(r["_id"]).encode()) % 5 >= Q.CHOOSING)
    chosen = {}
    for lang in {r.stratum for r in seen}:
        part = [r for r in seen if r.stratum == lang and not r.holdout]
        n, best = sum(r.good for r in part), []
        for rule, cutoffs in Q.CUTOFFS.items():
            ways = []
            for c in cutoffs:
                k = sum(r.good and r[rule] > c for r in part)
                gain = sum(not r.good and r[rule] > c for r in part) - k
                if gain > 0 and k <= n * (Q.RISK / len(Q.CUTOFFS)):
                    ways.append((gain, c))
            if ways:
                best.append((-max(ways)[0], rule, max(ways)[1]))
        if best:
            chosen[lang] = sorted(best)
    want = set()
    for lang, best in chosen.items():
        part = [r for r in seen if r.stratum == lang and r.holdout and r.good]
        for j in range(1, len(best) + 1):
            n, k = len(part), sum(any(r[rule] > c for _, rule, c in best[:j]) for r in part)
            p = sum(math.comb(n, i) * Q.RISK**i * (1 - Q.RISK)**(n - i) for i in range(k + 1))
            if p > Q.DOUBT / len(chosen):
                break
            want.add((lang, best[j - 1][1], best[j - 1][2], j, n, k))
    got = {tuple(r) for r in Q.certified_cutoffs(marked).select(
        "stratum", "rule", "cutoff", "place", "n_good", "false_rejects").collect()}
    assert got == want and {w[0] for w in want} == {"de", "fr", "es"}


def test_empty_and_repeated(frame, labelled):
    docs, labels = labelled
    assert Q.verdicts(docs.limit(0), labels).count() == 0
    assert Q.verdicts(docs.limit(1).union(docs.limit(1)), labels.limit(0)).count() == 2
