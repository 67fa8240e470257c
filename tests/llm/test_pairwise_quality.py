import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphfeed.llm import pairwise_quality as Q
from graphfeed.llm import queries
from graphfeed.llm.common import table


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.op8_pairwise_quality(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").filter(
        "held_out").collect()
    good = np.array([r.quality == 1 for r in rows])
    score = np.array([r.score for r in rows])
    pairs = (score[good][:, None] > score[~good][None]).mean()
    assert pairs > 0.95 and np.mean([r.predicted == r.quality for r in rows]) > 0.9
    assert all((r.score >= 0.3) == r.predicted for r in rows)


def test_labels_of_held_out_ids_teach_nothing(spark, frame):
    rows = [(i, ("fine words of text " if i % 3 else "### | | %% ") * (5 + i % 40)) for i in range(300)]
    docs = frame(rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)], "doc_id long, quality int")
    flipped = labels.withColumn("quality", F.when(F.col("doc_id") >= 200, 1 - F.col("quality")).otherwise(
        F.col("quality")))

    def run(marks):
        found = Q.ranked(docs, marks, F.col("doc_id"), F.col("text"), F.col("_id") < 200)
        return {r._id: r.score for r in found.collect()}

    one = run(labels)
    assert one == run(flipped)
    assert all((one[i] >= Q.CUT) == (i % 3 > 0) for i in range(300))


def test_newton_finds_the_minimum():
    random = np.random.default_rng(3)
    x = random.standard_normal((400, Q.FEATURES))
    model = Q.Ranking(x, x[:, 0] + 0.3 * random.standard_normal(400) > 0)
    gaps = random.standard_normal((500, 2 * Q.FEATURES))
    model.weights[:] = 0
    model._fit(gaps)

    def loss(w):
        return np.log1p(np.exp(-gaps @ w)).mean() + Q.RIDGE / 2 * w @ w

    best = loss(model.weights)
    for _ in range(50):
        assert loss(model.weights + 1e-2 * random.standard_normal(len(model.weights))) >= best


def test_edges(spark, frame):
    docs = frame([(1, None), (2, ""), (None, "a b"), (3, "x" * 300_000), (4, "w " * 100_000), (2, "")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = Q.ranked(docs, none, F.col("doc_id"), F.col("text"), F.lit(True)).collect()
    assert len(rows) == 6 and all(r.score == pytest.approx(Q.CUT) for r in rows)
    one_kind = spark.createDataFrame([(1, 1), (2, 1), (2, None), (None, 0)], "doc_id long, quality int")
    rows = Q.ranked(docs, one_kind, F.col("doc_id"), F.col("text"), F.lit(True)).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert Q.ranked(docs.limit(0), none, F.col("doc_id"), F.col("text"), F.lit(True)).count() == 0


def test_cut_is_the_quantile_of_all_labelled_rows(spark):
    random = np.random.default_rng(8)
    x = random.standard_normal((400, Q.FEATURES))
    good = x[:, 0] + random.standard_normal(400) > 0.4
    rows = [(i, v.tolist(), bool(g)) for i, (v, g) in enumerate(zip(x, good, strict=True))]
    df = spark.createDataFrame(rows, "_id long, features array<double>, good boolean")
    model = Q.fitted(df.select("_id", "features"), df.select("_id", "good"), sample=60)
    assert model.cut == pytest.approx(np.quantile(model.raw(x), (~good).mean()), abs=1e-9)


def test_query_against_plain_numpy(spark):
    """The whole query at once: labelled rows in order of id, one process, no Spark."""
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    marks = {r.doc_id: r.quality == 1 for r in table(spark, sf_dir, "labels").collect()}
    classes = Q._class_table()
    x = {i: Q.features((t or "").encode(), classes) for i, t in texts.items()}
    taught = [i for i in sorted(marks) if i in texts and zlib.crc32(str(i).encode()) % 5]
    model = Q.Ranking(np.array([x[i] for i in taught]), np.array([marks[i] for i in taught]))
    rows = queries.op8_pairwise_quality(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = float(model.score(x[r.doc_id])[0])
        assert r.score == pytest.approx(want, abs=1e-9) and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
