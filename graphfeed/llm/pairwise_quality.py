"""Document quality from preference pairs (Bradley-Terry).

In a pair a labelled good document is preferred to a bad one. The chance of that preference is the
logistic function of the difference of two scores, a score being a weighted sum of features of
the text; the weights minimise the logistic loss over pairs. A document is then predicted good
if its score reaches a quantile of the scores of all labelled training rows: the share of bad labels.

Features are measured on every whole text in one pass and stored, a few numbers per document.
Weights are fitted on a bounded sample: the labelled training documents with the smallest
hashes of their ids, about ``SAMPLE`` of them, and ``PAIRS`` pairs of them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphfeed.lineage import stored
from graphfeed.llm.common import hash_sample
from graphfeed.operators.skew import number_within

SAMPLE = 20_000
PAIRS = 200_000
CUT = 0.3
RIDGE = 1e-3
SEED = 11

# The byte classes whose shares are features.
CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n",
           b"#*$%&|<>", b".,;:!?", b"'\"()[]{}", b"=+-_/\\@~^`", bytes(range(128, 256))]


def _class_table() -> np.ndarray:
    table = np.zeros((256, len(CLASSES)))
    for i, members in enumerate(CLASSES):
        table[list(members), i] = 1
    return table


FEATURES = len(CLASSES) + 11


def features(text: bytes, table: np.ndarray) -> np.ndarray:
    """What a text looks like, as numbers; an empty text gives zeros."""
    out = np.zeros(FEATURES)
    words = text.split()
    if not words:
        return out
    out[:len(CLASSES)] = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ table / len(text)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), float, len(words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    pairs = set(zip(words, words[1:], strict=False))
    n = len(words)
    out[len(CLASSES):] = [
        np.log1p(n), lengths.mean(), np.log1p(lengths.max()), lengths.std(),
        len(counts) / n, max(counts.values()) / n, (n - 1 - len(pairs)) / n,
        1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)), (lengths <= 1).mean(),
        len(set(words[:-1]) & set(words[1:])) / n]
    return out


def measured(docs: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """(_id, features) of every row; null counts as empty."""
    schema = pa.schema([("_id", pa.int64()), ("features", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _class_table()
        for batch in batches:
            found = [features(v.as_py() or b"", table) for v in batch["_text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], pa.array(found, pa.list_(pa.float64()))], schema=schema)

    return docs.select(doc_id.cast("long").alias("_id"), text.cast("binary").alias("_text")).mapInArrow(
        run, "_id long, features array<double>")


class Ranking:
    """Weights learnt from pairs, and the map from raw scores to 0..1."""

    def __init__(self, x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = SEED) -> None:
        self.mean, self.spread = (x.mean(0), x.std(0) + 1e-6) if len(x) else (
            np.zeros(FEATURES), np.ones(FEATURES))
        random = np.random.default_rng(seed)
        z = self._inputs(x)
        self.weights = np.zeros(z.shape[1])
        best, worst = np.flatnonzero(good), np.flatnonzero(~good)
        if len(best) and len(worst):
            pairs = min(pairs, 20 * len(x))
            self._fit(z[random.choice(best, pairs)] - z[random.choice(worst, pairs)])
        raw = z @ self.weights
        bad_share = (~good).mean() if len(good) else 0.0
        self.cut = float(np.quantile(raw, bad_share)) if len(raw) else 0.0
        self.scale = (float(np.std(raw)) / 4 if len(raw) else 0.0) or 1.0

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        """Standard scores and, as too much can be as bad as too little, their sizes."""
        z = np.clip((x.reshape(-1, FEATURES) - self.mean) / self.spread, -6, 6)
        return np.hstack([z, np.abs(z)])

    def _fit(self, gaps: np.ndarray) -> None:
        """Newton steps on the mean logistic loss with a ridge."""
        for _ in range(25):
            p = 1 / (1 + np.exp(np.clip(gaps @ self.weights, -30, 30)))  # chance of the wrong order
            slope = -(gaps * p[:, None]).mean(0) + RIDGE * self.weights
            bend = (gaps * (p * (1 - p))[:, None]).T @ gaps / len(gaps) + RIDGE * np.eye(gaps.shape[1])
            step = np.linalg.solve(bend, slope)
            self.weights -= step
            if np.abs(step).max() < 1e-6:
                break

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self._inputs(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0..1; a raw score at the quantile becomes ``CUT``."""
        raw = (self.raw(x) - self.cut) / self.scale
        return 1 / (1 + np.exp(-np.clip(raw + np.log(CUT / (1 - CUT)), -700, 700)))


def fitted(measures: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranking:
    """The ranking learnt from labelled rows: ``labels`` has ``_id`` and ``good``, one row per id.

    Weights come from about ``sample`` rows, the cut from all.
    """
    known = stored(measures.filter(F.col("_id").isNotNull()).join(labels, "_id").select(
        "_id", "features", "good"), "quality-known")
    count = known.count()
    rows = sorted(hash_sample(known, "_id", sample, count).collect())
    model = Ranking(np.array([r["features"] for r in rows]).reshape(-1, FEATURES),
                    np.array([r["good"] for r in rows], bool))
    if count > len(rows):
        model.cut = cut_of_all(known, model)
    return model


def cut_of_all(known: DataFrame, model: Ranking) -> float:
    """The raw score at the share of bad labels among all rows of ``known``, as ``np.quantile``."""
    schema = pa.schema([("_id", pa.int64()), ("raw", pa.float64()), ("good", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["features"].flatten().to_numpy().reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], pa.array(model.raw(x), pa.float64()), batch["good"]], schema=schema)

    raw = stored(known.select("_id", "features", "good").mapInArrow(
        run, "_id long, raw double, good boolean"), "quality-labelled")
    size = raw.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("good")).alias("bad")).first()
    at = (size["n"] - 1) * (size["bad"] / size["n"])
    low = int(at)
    near = number_within(raw, [], [F.col("raw"), F.col("_id")]).filter(
        F.col("position").isin(low + 1, low + 2)).select("raw").collect()  # at most two rows
    return float(np.quantile([r["raw"] for r in near], at - low))


def ranked(docs: DataFrame, labels: DataFrame, doc_id: Column, text: Column, train: Column
           ) -> DataFrame:
    """Per row of ``docs``: _id, score, predicted.

    ``labels`` has ``doc_id`` and ``quality``; ids with a null or with both labels are left out. Only
    ids for which ``train`` (of ``_id``) holds teach. Null and empty texts are scored like others.
    Without labels of both kinds every score is ``CUT``.
    """
    measures = stored(measured(docs, doc_id, text), "quality-features")
    marks = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy(F.col("doc_id").alias("_id"))
             .agg(F.min("quality").alias("_low"), F.max("quality").alias("_high"))
             .filter((F.col("_low") == F.col("_high")) & train)
             .select("_id", (F.col("_low") == 1).alias("good")))
    model = fitted(measures, marks)
    schema = pa.schema([("_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["features"].flatten().to_numpy().reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], pa.array(model.score(x), pa.float64())], schema=schema)

    return measures.mapInArrow(run, "_id long, score double").withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))
