"""Repeated byte strings of a fixed length, found over all texts by a difference cover.

Places whose offset modulo ``v`` lies in a difference cover are the sample: whatever the places of
two equal strings, some shift below ``v`` brings both to sampled places. The sampled suffixes are
sorted, named and recursed on as in difference-cover suffix sorting, only as deep as the strings
are long, and suffixes that are known to be alone leave at each step:

* *names*: sampled places get a name for their next ``v`` bytes, and the names are sorted;
* *recursion*: the names of a text at stride ``v`` are a text of their own. Where three in a row
  occur elsewhere, the triple is named and sorted again;
* *merge*: every place, sampled or not, that has a repeated triple less than ``v`` bytes ahead is
  sorted by its whole prefix of ``length`` bytes, and neighbours in that order are compared.

Names are fingerprints: their order serves as well as that of the bytes, since only equality
counts. The first two steps only discard, by 48 bits. The last decides, by 96 bits of two
unrelated fingerprints; among 10^13 places an accidental match is to be expected once in some
thousand runs.

Sorting is an exchange of packed keys between blocks of texts and parts of the key space (see
``blocks``). Equal texts are found by their SHA-256 first and sorted once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphfeed.lineage import stored
from graphfeed.llm.blocks import (
    BLOCK_BYTES, PART_KEYS, QUESTIONS_DDL, Block, Keys, answers_of, blocks_of, with_answers)

LENGTH = 400
NAME_SHIFT = 16  # bits that names which only discard do without
CHUNK = 1 << 18

# Perfect difference sets by their modulus.
COVERS = {
    3: [0, 1],
    7: [0, 1, 3],
    13: [0, 1, 3, 9],
    21: [0, 1, 4, 14, 16],
    31: [0, 1, 3, 8, 12, 18],
    57: [0, 1, 3, 13, 32, 36, 43, 52],
    73: [0, 1, 3, 7, 15, 31, 36, 54, 63],
    91: [0, 1, 3, 9, 27, 49, 56, 61, 77, 81],
}


def modulus(length: int) -> int:
    """The largest modulus whose shift and triple fit into ``length`` bytes."""
    fitting = [v for v in COVERS if 4 * v - 1 <= length]
    if not fitting:
        raise ValueError(f"strings of at least {4 * min(COVERS) - 1} bytes are needed")
    return max(fitting)


def _tables(seed: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number per byte, and the powers of a base and of its inverse."""
    rng = np.random.default_rng(seed)
    by_byte = rng.integers(0, 2**64, 256, dtype=np.uint64)
    base = int(rng.integers(0, 2**61, dtype=np.uint64)) * 8 + 5
    powers = []
    for factor in (base, pow(base, -1, 2**64)):
        steps = np.full(size + 1, factor, np.uint64)
        steps[0] = 1
        powers.append(np.cumprod(steps, dtype=np.uint64))
    return by_byte, *powers


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def fingerprints(data: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    """64 bits for the ``length`` bytes from each of the ascending places ``at``."""
    by_byte, powers, inverse = _tables(seed, CHUNK + length)
    out = np.empty(len(at), np.uint64)
    edges = np.searchsorted(at, np.arange(0, len(data) + CHUNK, CHUNK))
    for i in np.flatnonzero(np.diff(edges)):
        low, high, first = edges[i], edges[i + 1], int(i) * CHUNK
        part = data[first:first + CHUNK + length]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(by_byte[part] * powers[:len(part)], out=sums[1:])
        own = at[low:high] - first
        out[low:high] = (sums[own + length] - sums[own]) * inverse[own]
    return _spread(out)


SINGLE, FIRST, COPY = 0, 1, 2  # a text that occurs once, the first of equal ones, another one


class Sorting:
    """What a block asks at each step, given the answers to the steps before.

    The first answer says which texts of the block have equals.
    """

    def __init__(self, block: Block, told: list[list[np.ndarray]], length: int, parts: list[int]
                 ) -> None:
        self.block, self.told, self.length, self.parts = block, told[1:], length, parts
        self.state = np.full(len(block.ends), SINGLE, np.uint8)
        for some in told[0]:
            rows = some.view("<i4").reshape(-1, 2)
            self.state[rows[:, 0]] = rows[:, 1]
        # texts that take part in the sorting
        long = np.flatnonzero((self.state != COPY) & (block.ends - block.starts >= length))
        self.starts, self.ends = block.starts[long], block.ends[long]
        self.v = modulus(length)

    def _text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1

    def names(self) -> tuple[np.ndarray, Keys]:
        v, cover = self.v, np.array(COVERS[self.v])
        at = [np.empty(0, np.int64)]
        for start, end in zip(self.starts.tolist(), self.ends.tolist(), strict=True):
            places = (np.arange(start, end, v)[:, None] + cover).ravel()
            at.append(places[:np.searchsorted(places, end - v, "right")])
        at = np.concatenate(at)
        self._names = fingerprints(self.block.data, at, v, 1)
        return at, Keys(self._short(self._names), None, self.parts[0])

    def triples(self) -> tuple[np.ndarray, Keys]:
        at, keys = self.names()
        some = np.flatnonzero(keys.repeated(self.told[0]))
        lasting = np.zeros(len(at), bool)
        lasting[some] = True
        # within a text the next places of the same residue are as many further as the cover has
        some = some[at[some] + 3 * self.v <= self.ends[self._text_of(at[some])]]
        step = len(COVERS[self.v])
        some = some[lasting[some + step] & lasting[some + 2 * step]]
        a, b, c = (self._names[some + i * step] for i in range(3))
        whole = _spread(_spread(_spread(a) + b) + c)
        return at[some], Keys(self._short(whole), None, self.parts[1])

    def suffixes(self) -> tuple[np.ndarray, Keys]:
        at, keys = self.triples()
        anchors = at[keys.repeated(self.told[1])]
        # all places less than v before an anchor in its text, if the whole prefix is in it too
        change = np.zeros(len(self.block.data) + 2, np.int32)
        np.add.at(change, np.maximum(anchors - self.v + 1, self.starts[self._text_of(anchors)]), 1)
        np.add.at(change, anchors + 1, -1)
        places = np.flatnonzero(np.cumsum(change, dtype=np.int32))
        places = places[places + self.length <= self.ends[self._text_of(places)]]
        data, length = self.block.data, self.length
        tails = (fingerprints(data, places, length, 3) >> np.uint64(32)).astype("<u4")
        return places, Keys(fingerprints(data, places, length, 2), tails, self.parts[2])

    def repeated(self) -> np.ndarray:
        """The places of all strings of ``length`` bytes that occur elsewhere too."""
        at, keys = self.suffixes()
        return at[keys.repeated(self.told[2])]

    @staticmethod
    def _short(keys: np.ndarray) -> np.ndarray:
        return keys >> np.uint64(NAME_SHIFT) << np.uint64(NAME_SHIFT)


def _equal_texts(blocks: DataFrame) -> DataFrame:
    """(block, part, bits): the rows of each block whose text occurs more than once, and how."""
    schema = pa.schema([("block", pa.int64()), ("row", pa.int32()), ("sha", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rest in zip(batch["block"].to_pylist(), batch["rest"].to_pylist(), strict=True):
                with pa.ipc.open_stream(rest) as reader:
                    shas = reader.read_all()["_sha"].combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(shas), pa.int64()),
                     pa.array(range(len(shas)), pa.int32()), shas.cast(pa.binary())], schema=schema)

    each = stored(blocks.select("block", "rest").mapInArrow(rows, "block long, row int, sha binary"),
                  "text-shas")
    copied = each.groupBy("sha").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("block", "row")).alias("first")
    ).filter("n > 1").select("sha", "first")
    state = F.when(F.struct("block", "row") == F.col("first"), FIRST).otherwise(COPY)
    found = each.join(copied, "sha").select("block", "row", state.cast("int").alias("state"))

    def pairs(_: tuple, table: pa.Table) -> pa.Table:
        both = np.stack([table["row"].to_numpy(), table["state"].to_numpy()], 1).astype("<i4")
        return pa.table({"block": table["block"][:1], "part": pa.array([0], pa.int32()),
                         "bits": pa.array([both.tobytes()], pa.binary())})

    return found.groupBy("block").applyInArrow(pairs, "block long, part int, bits binary")


KEPT_DDL = ("_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, "
            "kept binary")
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def deduplicated(docs: DataFrame, doc_id: Column, text: Column, length: int = LENGTH,
                 block_bytes: int = BLOCK_BYTES, part_keys: int = PART_KEYS) -> DataFrame:
    """Per row of ``docs``: _id, n_bytes, n_removed, spans, kept.

    Removed is every byte covered by a string of ``length`` bytes of the text's UTF-8 that also
    starts anywhere else, in the same text or another; ``spans`` are the maximal removed runs and
    ``kept`` the other bytes in order, which may cut a character. Repeated rows are copies of each
    other: if long enough they go whole, all of them. Null and empty texts and those shorter than
    ``length`` keep what they have. Null ids are kept. A text counts to the memory of the one task
    that reads it; a string may repeat any number of times.
    """
    v = modulus(length)
    blocks = blocks_of(docs, text, {
        "_id": doc_id.cast("long"),
        "_sha": F.unhex(F.sha2(F.coalesce(text.cast("binary"), F.lit(b"")), 256))},
        "dedup-blocks", block_bytes)
    told = [stored(_equal_texts(blocks), "dedup-equal")]
    size = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    density = len(COVERS[v]) / v
    parts: list[int] = []

    def step(ask: Callable[[Sorting], Keys], expected: float, shift: int, name: str) -> int:
        """One sorting; the number of keys that blocks share."""
        parts.append(1 + int(expected / part_keys))
        asked = list(parts)
        questions = with_answers(
            blocks, told, lambda block, bits: ask(Sorting(block, bits, length, asked)).questions(
                block.number, shift), QUESTIONS_DDL)
        told.append(stored(answers_of(questions), name))
        return told[-1].agg(F.coalesce(F.sum("n_shared"), F.lit(0))).first()[0]

    shared = step(lambda s: s.names()[1], size * density, NAME_SHIFT, "dedup-names")
    shared = step(lambda s: s.triples()[1], shared, NAME_SHIFT, "dedup-triples")
    # a shared triple may stand at several places of its block
    step(lambda s: s.suffixes()[1], 2 * shared / density, 0, "dedup-suffixes")

    def cut(block: Block, bits: list[list[np.ndarray]]) -> pa.Table:
        sorting = Sorting(block, bits, length, parts)
        places = sorting.repeated()
        gone = np.zeros(len(block.data) + 1, np.int32)
        np.add.at(gone, places, 1)
        np.add.at(gone, places + length, -1)
        gone = np.cumsum(gone, dtype=np.int32)[:-1] > 0
        rows = []
        for i, (a, b) in enumerate(zip(block.starts.tolist(), block.ends.tolist(), strict=True)):
            if sorting.state[i] != SINGLE and b - a >= length:
                rows.append((b - a, b - a, [(0, b - a)], b""))
                continue
            own = gone[a:b]
            edges = np.flatnonzero(np.diff(own.view(np.int8), prepend=0, append=0)).reshape(-1, 2)
            rows.append((b - a, int(own.sum()), edges.tolist(), block.data[a:b][~own].tobytes()))
        sizes, removed, spans, kept = zip(*rows, strict=True)
        return pa.table([
            block.rest["_id"].combine_chunks(), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
            pa.array([[{"start": x, "end": y} for x, y in own] for own in spans], _SPANS),
            pa.array(kept, pa.binary())], names=["_id", "n_bytes", "n_removed", "spans", "kept"])

    return with_answers(blocks, told, cut, KEPT_DDL)
