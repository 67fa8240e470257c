"""Importance resampling towards a target corpus, by hashed word features.

Features are runs of one and two words, hashed by CRC-32 into ``BUCKETS`` buckets. A bucket gains by
how much more frequent it is in the target than in the documents; a document's weight is the mean
gain of its features. With Gumbel noise, fixed by the id, added to the weights, the highest scores
are a sample without replacement in proportion to the exponents of the weights.

* Counts per bucket are arrays of ``BUCKETS`` numbers, added up by Spark. Words are found and hashed
  side by side in numpy arrays over the bytes of a batch; the CRC of two words follows from theirs.
* The cutoff is found without sorting the table: a quantile sketch gives a bracket of scores
  around it, exact counts of the rows outside say whether the cutoff is inside, or the bracket is
  widened; only the bracket's rows are sorted.
* The drawn rows are range-partitioned by their order and numbered by counts per range.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphfeed.lineage import stored
from graphfeed.llm.blocks import buffer_of, runs
from graphfeed.operators.skew import number_within

BUCKETS = 10_000
SCALE = 1000  # gains and noise are whole thousandths
SEED = "7"
PERCENT = 25
LEAST_WORDS = 20
ACCURACY = 1000  # the sketch is off by at most one part in so many
SLICE = 1 << 22  # bytes that are hashed together
FEW = 16  # words left below which each is hashed by itself

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def _crc_table() -> np.ndarray:
    """The CRC-32 register after one byte, from a register of zero."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


class Hasher:
    """CRC-32 of many words side by side, and of pairs of them joined by a space."""

    def __init__(self) -> None:
        self.table = _crc_table()
        # what zero bytes do to each byte of a register, for 1, 2, 4, ... of them
        zeros = [[self.table if i == 0 else (np.arange(256, dtype=np.uint32) << np.uint32(8 * (i - 1)))
                  for i in range(4)]]
        while len(zeros) < 31:
            zeros.append([self._through(zeros[-1], part) for part in zeros[-1]])
        self.zeros = zeros

    @staticmethod
    def _through(parts: list[np.ndarray], register: np.ndarray) -> np.ndarray:
        out = parts[0][register & 255]
        for i in range(1, 4):
            out = out ^ parts[i][register >> np.uint32(8 * i) & 255]
        return out

    def words(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """CRC-32 of the bytes from each of ``starts``."""
        register = np.full(len(starts), 0xFFFFFFFF, np.uint32)
        live, at = np.arange(len(starts)), 0
        while len(live) >= FEW:
            byte = data[starts[live] + at]
            own = register[live]
            register[live] = self.table[(own ^ byte) & 255] ^ own >> np.uint32(8)
            at += 1
            live = live[sizes[live] > at]
        out = ~register
        for i in live.tolist():
            out[i] = zlib.crc32(data[starts[i]:starts[i] + sizes[i]])
        return out

    def pairs(self, first: np.ndarray, second: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """CRC-32 of a word, a space and another word of the given size, from the words' CRCs."""
        register = ~first
        register = ~(self.table[(register ^ np.uint32(32)) & 255] ^ register >> np.uint32(8))
        bit = 0
        while (sizes >> bit).any():
            some = np.flatnonzero(sizes >> bit & 1)
            register[some] = self._through(self.zeros[bit], register[some])
            bit += 1
        return register ^ second


def _features(texts: pa.Array, hasher: Hasher) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, words by row, their buckets, buckets of pairs by the place of the second word).

    Rows come in runs of about ``SLICE`` bytes; each run's last word ends with its last row. The
    bucket of a pair is -1 where a row's first word has none before it.
    """
    whole, offsets = buffer_of(texts)
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1
        last = max(last, first + 1)
        bounds = offsets[first:last + 1] - offsets[first]
        data = _LOWER[whole[offsets[first]:offsets[last]]]
        starts, sizes = runs(_IN_WORD[data], bounds)
        n_words = np.diff(np.searchsorted(starts, bounds))
        crc = hasher.words(data, starts, sizes)
        both = np.full(len(starts), -1, np.int64)
        if len(starts) > 1:
            both[1:] = hasher.pairs(crc[:-1], crc[1:], sizes[1:]) % np.uint32(BUCKETS)
        heads = np.cumsum(n_words) - n_words
        both[heads[n_words > 0]] = -1
        yield first, n_words, (crc % np.uint32(BUCKETS)).astype(np.int64), both
        first = last


def _body(text: Column) -> Column:
    return F.coalesce(text.cast("binary"), F.lit(b"")).alias("_text")


def bucket_counts(texts: DataFrame, text: Column) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = Hasher(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, words, pairs in _features(batch["_text"], hasher):
                counts += np.bincount(words, minlength=BUCKETS)
                counts += np.bincount(pairs[pairs >= 0], minlength=BUCKETS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], schema=schema)

    out = np.zeros(BUCKETS, np.int64)
    # at most one row per bucket
    for row in texts.select(_body(text)).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much more frequent each bucket is in the target."""
    of_raw, of_target = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([
        math.floor(SCALE * math.log(((t + 1) * of_raw) / ((s + 1) * of_target)))
        for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def _noise(doc_id: Column, seed: str) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(float(-SCALE)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def scored(docs: DataFrame, target: DataFrame, doc_id: Column, text: Column, target_text: Column,
           seed: str = SEED) -> DataFrame:
    """Per row of ``docs``: _id, n_words, n_features, weight, score.

    A null text has no words; without features the weight is 0. A null id is noised as the empty
    text. An empty target or table counts no feature in any bucket.
    """
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    schema = pa.schema([("_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()),
                        ("weight", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        more = np.append(gain, 0)  # a pair that is none gains nothing
        for batch in batches:
            ids = batch["_id"]
            for first, n_words, words, pairs in _features(batch["_text"], hasher):
                sums = np.concatenate([[0], np.cumsum(gain[words] + more[pairs])])
                n = np.where(n_words > 0, 2 * n_words - 1, 0)
                ends = np.cumsum(n_words)
                total = sums[ends] - sums[ends - n_words]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(n)), pa.array(n_words), pa.array(n),
                     pa.array(total // np.maximum(n, 1))], schema=schema)

    rows = docs.select(doc_id.cast("long").alias("_id"), _body(text)).mapInArrow(
        run, "_id long, n_words long, n_features long, weight long")
    return rows.withColumn("score", (F.col("weight") + _noise(F.col("_id"), seed)).cast("long"))


def cutoff(rows: DataFrame, n: int, k: int, accuracy: int = ACCURACY, error: float | None = None
           ) -> int | None:
    """The ``k``-th highest of the ``n`` values of ``score``, by a bracket that is proven.

    ``error`` is the share of rows by which the bracket goes beyond the rank on each side; it
    starts at twice what the sketch may be off, and doubles until the counts outside are right.
    """
    if k <= 0:
        return None
    error = error or 2.0 / accuracy
    while True:
        middle = 1 - k / n
        # the sketch is of the scores in ascending order
        low, high = (rows.agg(F.percentile_approx(
            "score", F.array(F.lit(max(0.0, middle - error)), F.lit(min(1.0, middle + error))),
            F.lit(accuracy)).alias("q")).first()["q"])
        low, high = (None if error >= middle else low), (None if error >= 1 - middle else high)
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col("score") >= low)
        if high is not None:
            inside = inside & (F.col("score") <= high)
        above = F.lit(False) if high is None else F.col("score") > high
        n_above, n_inside = rows.agg(F.count_if(above), F.count_if(inside)).first()
        if n_above < k <= n_above + n_inside:
            break
        error *= 2
    place = k - n_above
    bracket = rows.filter(inside).select("score")
    return number_within(bracket, [], [F.col("score").desc()]).filter(
        F.col("position") == place).first()["score"]


def resampled(docs: DataFrame, target: DataFrame, doc_id: Column, text: Column, target_text: Column,
              percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """Per row of ``docs``: _id, n_features, weight, score, rank.

    Of the N rows with at least ``least_words`` words, floor(percent * N / 100) are drawn and ranked
    from 1 by score, the highest first, ties by smaller id, null ids last; of repeated rows any may
    come first. The others have a null rank. Empty tables give no rows.
    """
    rows = stored(scored(docs, target, doc_id, text, target_text, seed), "resample-scores")
    able = rows.filter(F.col("n_words") >= least_words)
    n = able.count()
    k = percent * n // 100
    limit = cutoff(able, n, k)
    out = ["_id", "n_features", "weight", "score"]
    if limit is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    can = (F.col("n_words") >= least_words) & (F.col("score") >= limit)
    # rows that tie with the cutoff are ranked too, and fall out beyond k
    ranked = number_within(
        rows.filter(can).select(*out), [], [F.col("score").desc(), F.col("_id").asc_nulls_last()], "rank")
    return ranked.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank"))).unionByName(
        rows.filter(~can).select(*out, F.lit(None).cast("long").alias("rank")))
