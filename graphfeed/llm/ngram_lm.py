"""N-gram language model as a weighted backoff automaton, learnt and applied in blocks.

The model interpolates by Dirichlet priors: ``P(w | h) = (c(hw) + mu P(w | h')) / (c(h) + mu)``
with h' the context without its first word, down to ``P(w) = (c(w) + 1/2) / (N + (V + 1)/2)``. It
is a backoff model: an n-gram that was seen has that probability on its arc, and from a context
to the next shorter one leads a failure arc of weight ``mu / (c(h) + mu)``.

All n-grams of all training documents count; none is pruned, so the model grows with the corpus
and never has to fit anywhere. Documents are cut into blocks of about ``BLOCK_TOKENS`` tokens, and
for each block the part of the automaton is made that its texts can reach:

* a block is written once as token codes of its own vocabulary;
* each block sends its distinct n-grams (64-bit hashes) with their training counts to the part of
  the key space they fall in, where the counts of all blocks are summed;
* the sums come back to the blocks that asked, in the order of the question;
* states, arcs and failure arcs are built from them, and each document is read once from left
  to right: the state is carried, and log10 probabilities of arcs and failure arcs add up.

A frequent n-gram is asked for at most once per block. Parts and blocks hold a bounded number
of n-grams, and every exchange is packed arrays.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphfeed.lineage import stored

ORDER = 2
MU = 100.0
BLOCK_TOKENS = 1_000_000
PART_KEYS = 1_500_000
END = b""  # no word is empty; also stands before the first word


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed: high bytes of small numbers cost nothing."""
    if not len(numbers):
        return b""
    planes = numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    if not data:
        return np.empty(0, kind)
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _sorted_packed(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _sorted_unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, "<u8"), dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BLOCKS = pa.schema([
    ("block", pa.int64()), ("ids", pa.binary()), ("no_id", pa.binary()), ("train", pa.binary()),
    ("ends", pa.binary()), ("codes", pa.binary()), ("words", pa.binary()),
    ("n_tokens", pa.int64()), ("n_train_tokens", pa.int64())])
BLOCKS_DDL = ("block long, ids binary, no_id binary, train binary, ends binary, codes binary, "
              "words binary, n_tokens long, n_train_tokens long")


class _Block:
    """Documents being gathered: token codes in the order of first sight."""

    def __init__(self) -> None:
        self.ids, self.train, self.ends, self.codes, self.size = [], [], [], [], 0
        self.vocabulary: dict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.vocabulary[END]  # noqa: B018  the end has code 0

    def add(self, doc_id: int | None, train: bool, text: bytes | None) -> None:
        words = (text or b"").lower().split()
        codes = np.fromiter(map(self.vocabulary.__getitem__, words), np.uint32, len(words))
        self.codes += [np.zeros(1, np.uint32), codes, np.zeros(1, np.uint32)]
        self.size += len(words) + 2
        self.ids.append(doc_id)
        self.train.append(train)
        self.ends.append(self.size)

    def row(self, number: int) -> dict:
        codes = np.concatenate(self.codes)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.vocabulary), np.uint64,
                             len(self.vocabulary))
        tokens = np.diff(self.ends, prepend=0) - 1
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        return {"block": number, "ids": _packed(ids),
                "no_id": np.array([i is None for i in self.ids]).tobytes(),
                "train": np.array(self.train).tobytes(),
                "ends": _packed(np.array(self.ends, np.int64)),
                "codes": _packed(codes), "words": hashes.tobytes(), "n_tokens": int(tokens.sum()),
                "n_train_tokens": int(tokens[np.array(self.train)].sum())}


def _blocks(docs: DataFrame, doc_id: Column, train: Column, text: Column,
            block_tokens: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for one, learn, body in zip(batch["_id"].to_pylist(), batch["_train"].to_pylist(),
                                        batch["_text"], strict=True):
                block.add(one, learn, body.as_py())
                if block.size >= block_tokens:
                    yield pa.RecordBatch.from_pylist([block.row(number)], BLOCKS)
                    number, block = number + 1, _Block()
        if block.ids:
            yield pa.RecordBatch.from_pylist([block.row(number)], BLOCKS)

    return docs.select(doc_id.cast("long").alias("_id"), train.alias("_train"),
                       text.cast("binary").alias("_text")).mapInArrow(run, BLOCKS_DDL)


def _grams(codes: np.ndarray, hashes: np.ndarray, ends: np.ndarray, order: int
           ) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For n from 1: (distinct n-gram hashes in order, where each position's is among them,
    the first position of each, the positions with an n-gram).

    A document is the start, its words and the end; the start is never predicted and has no
    unigram, but it is the first word of contexts.
    """
    starts = np.concatenate([[0], ends[:-1]])
    place = np.arange(len(codes)) - np.repeat(starts, np.diff(ends, prepend=0))
    own = _mixed(hashes[codes])
    hashed, out = own, []
    for n in range(1, order + 1):
        if n > 1:
            hashed = np.concatenate([[np.uint64(0)], hashed[:-1]])
            hashed = _mixed(hashed * np.uint64(0x9E3779B97F4A7C15) + own + np.uint64(n))
        at = np.flatnonzero(place >= max(n - 1, 1))
        keys, first, inverse = np.unique(hashed[at], return_index=True, return_inverse=True)
        out.append((keys, inverse, at[first], at))
    return out


def _load(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (_unpacked(row["codes"], "<u4"), np.frombuffer(row["words"], np.uint64),
            _unpacked(row["ends"], "<i8"), np.frombuffer(row["train"], bool))


def _questions(blocks: DataFrame, order: int, parts: int) -> DataFrame:
    """(part, block, keys, counts): the n-grams of each block and how often it trains them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, hashes, ends, train = _load(row)
                learns = np.repeat(train, np.diff(ends, prepend=0))
                rows = []
                for n, (keys, inverse, _, at) in enumerate(_grams(codes, hashes, ends, order), 1):
                    counts = np.bincount(inverse, learns[at], len(keys)).astype("<u4")
                    for part, low, high in _cut(keys, parts):
                        rows.append({
                            "part": part, "block": row["block"], "n": n,
                            "keys": _sorted_packed(keys[low:high]),
                            "counts": _packed(counts[low:high])})
                        if len(rows) >= 512:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("n", pa.int32()),
                        ("keys", pa.binary()), ("counts", pa.binary())])
    return blocks.select("block", "codes", "words", "ends", "train").mapInArrow(
        run, "part int, block long, n int, keys binary, counts binary")


def _cut(keys: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """(part, from, to): the runs of sorted keys that fall into each part of the key space."""
    limits = (np.arange(1, parts, dtype=np.float64) * (2.0**64 / parts)).astype(np.uint64)
    edges = np.concatenate([[0], np.searchsorted(keys, limits), [len(keys)]])
    for part in np.flatnonzero(np.diff(edges)):
        yield int(part), int(edges[part]), int(edges[part + 1])


def _answers(questions: DataFrame) -> DataFrame:
    """(block, n, part, counts, distinct): sums over all blocks, in the order of the question.

    One more row per part, with a null block, has the number of distinct training words there.
    """
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out, words = [], 0
        for n, group in frame.groupby("n"):
            keys = [_sorted_unpacked(k) for k in group["keys"]]
            counts = np.concatenate([_unpacked(c, "<u4") for c in group["counts"]])
            every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(inverse, counts, len(every)).astype("<u8")
            words += int((total > 0).sum()) if n == 1 else 0
            answers = np.split(total[inverse], np.cumsum([len(k) for k in keys])[:-1])
            out += [(block, n, _packed(np.ascontiguousarray(a)))
                    for block, a in zip(group["block"], answers, strict=True)]
        out.append((None, 0, b""))
        frame = pd.DataFrame(out, columns=["block", "n", "counts"]).astype({"block": "Int64"})
        return frame.assign(distinct=words)

    def with_part(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return run(frame).assign(part=key[0])

    return questions.groupBy("part").applyInPandas(
        with_part, "block long, n int, counts binary, part int, distinct long")


class Automaton:
    """The reachable part of the model: states are contexts, arcs are n-grams that were seen."""

    def __init__(self, grams, counts: list[np.ndarray], codes: np.ndarray, total: int,
                 distinct: int, mu: float) -> None:
        self.words = int(codes.max()) + 1
        smoothing = total + 0.5 * (distinct + 1)
        order = len(grams)
        # state 0 is the empty context; then the n-grams of each order below the last
        offsets = np.cumsum([1, *[len(g[0]) for g in grams]])
        state_at = np.zeros(len(codes), np.int64)  # the state after a position is read, by order
        seen_at = np.zeros(len(codes), np.int64)  # how often that context was seen
        self.fail, self.back = [0], [0.0]
        arcs, weights, targets = [], [], []
        chance_at = np.zeros(len(codes))
        starts = grams[0][3][np.flatnonzero(np.diff(grams[0][3], prepend=-2) > 1)] - 1
        ends_count = counts[0][grams[0][1][np.flatnonzero(codes[grams[0][3]] == 0)[0]]]
        self.start = 0
        for n, ((_, inverse, first, at), count) in enumerate(zip(grams, counts, strict=True), 1):
            if n == 1:
                chance = (count + 0.5) / smoothing
                source = np.zeros(len(count), np.int64)
                base = np.zeros(self.words)
                base[codes[first]] = chance
                self.base, self.count = base, np.zeros(self.words, np.int64)
                self.count[codes[first]] = count
            else:
                before = seen_at[first - 1].astype(float)
                chance = (count + mu * chance_at[first]) / (before + mu)
                source = state_at[first - 1]
            kept = (count > 0) if n > 1 else np.ones(len(count), bool)
            own = offsets[n - 1] + np.arange(len(count))
            shorter = state_at[first]
            is_state = (count > 0) & (n < order)
            arcs.append((source * self.words + codes[first])[kept])
            weights.append(np.log10(chance[kept]))
            targets.append(np.where(is_state, own, shorter)[kept])
            if n < order:
                self.fail += shorter.tolist()
                self.back += np.log10(mu / (count + mu)).tolist()
            # contexts of this order, for the n-grams of the next one
            chance_at[at] = chance[inverse]
            state_at[at] = np.where(is_state, own, shorter)[inverse]
            seen_at[at] = np.where(count > 0, count, 0)[inverse]
            if n == 1 and order > 1:
                # the start is the context of first words: its state is the end's
                end = grams[0][1][np.flatnonzero(codes[grams[0][3]] == 0)[0]]
                self.start = int(own[end]) if ends_count > 0 else 0
                state_at[starts], seen_at[starts] = self.start, ends_count
        self.arcs = dict(zip(np.concatenate(arcs).tolist(),
                             zip(np.concatenate(weights).tolist(),
                                 np.concatenate(targets).tolist(), strict=True), strict=True))

    def score(self, codes: list[int]) -> float:
        """log10 probability of the words and the end, read once from left to right."""
        arcs, fail, back, words = self.arcs, self.fail, self.back, self.words
        state, total = self.start, 0.0
        for code in codes:
            arc = arcs.get(state * words + code)
            while arc is None:
                total += back[state]
                state = fail[state]
                arc = arcs.get(state * words + code)
            total += arc[0]
            state = arc[1]
        return total


SCORED_DDL = ("_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")


def scored(
    docs: DataFrame, doc_id: Column, train: Column, text: Column, order: int = ORDER,
    mu: float = MU, block_tokens: int = BLOCK_TOKENS, part_keys: int = PART_KEYS,
) -> DataFrame:
    """Per row of ``docs``: _id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose ``train`` is true are learnt from; a null counts as true. A null text is empty and
    has the end as its one token. Repeated rows are scored and learnt each. With no training
    document every word is unknown.
    """
    blocks = stored(_blocks(docs, doc_id, F.coalesce(train, F.lit(True)), text,
                            block_tokens), "lm-blocks")
    total, tokens = blocks.agg(F.coalesce(F.sum("n_train_tokens"), F.lit(0)),
                               F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    parts = max(1, -(-tokens * order // part_keys))
    answers = stored(_answers(_questions(blocks, order, parts)), "lm-counts")
    distinct = answers.filter("block is null").agg(
        F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]

    def score(asked: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        row = asked.iloc[0]
        codes, hashes, ends, train = _load(row)
        grams = _grams(codes, hashes, ends, order)
        told = told.sort_values(["n", "part"])
        counts = [np.concatenate([_unpacked(c, "<u8") for c in told["counts"][told["n"] == n]]
                                 ).astype(np.int64) for n in range(1, order + 1)]
        automaton = Automaton(grams, counts, codes, total, distinct, mu)
        spoken, starts = codes.tolist(), np.concatenate([[0], ends[:-1]])
        known, base = automaton.count[codes] > 0, np.log10(automaton.base[codes])
        bounds = list(zip((starts + 1).tolist(), ends.tolist(), strict=True))
        return pd.DataFrame({
            "_id": pd.arrays.IntegerArray(_unpacked(row["ids"], "<i8"),
                                          np.frombuffer(row["no_id"], bool).copy()),
            "held_out": ~train,
            "n_tokens": ends - starts - 1,
            "n_known": [int(known[a:b].sum()) for a, b in bounds], "train_tokens": total,
            "base_score": [float(base[a:b].sum()) for a, b in bounds],
            "score": [automaton.score(spoken[a:b]) for a, b in bounds]})

    return (blocks.select("block", "ids", "no_id", "train", "ends", "codes", "words").groupBy("block")
            .cogroup(answers.filter("block is not null").groupBy("block"))
            .applyInPandas(score, SCORED_DDL))
