"""Texts in blocks of bounded size, and the exchange by which blocks learn which keys they share.

A block is a row: texts of some ten megabytes one after another, compressed, with what else is
needed of their rows. Blocks are written bucketed by their number, so what is found out about a
block joins it without moving the texts again.

In an exchange every block sends its distinct keys, sorted and packed, to the part of the key
space they fall in, and gets back one bit per key in the order of the question: whether another
block has that key too.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphfeed.lineage import scratch_path

BLOCK_BYTES = 8_000_000
PART_KEYS = 1_500_000

BLOCKS = pa.schema([("block", pa.int64()), ("texts", pa.binary()), ("ends", pa.binary()),
                    ("rest", pa.binary()), ("n_bytes", pa.int64())])
BLOCKS_DDL = "block long, texts binary, ends binary, rest binary, n_bytes long"


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed: high bytes of small numbers cost nothing."""
    if not len(numbers):
        return b""
    planes = numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    if not data:
        return np.empty(0, kind)
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


class Block:
    """The texts of a block as bytes, where each ends, and the other columns of their rows."""

    def __init__(self, row: dict) -> None:
        self.number = row["block"]
        self.data = np.frombuffer(zstandard.decompress(row["texts"]), np.uint8)
        self.ends = unpacked(row["ends"], "<i8")
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        with pa.ipc.open_stream(row["rest"]) as reader:
            self.rest = reader.read_all()


def blocks_of(docs: DataFrame, text: Column, rest: dict[str, Column], name: str,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, texts, ends, rest, n_bytes): all rows of ``docs``, a null text as an empty one.

    A block ends with the row that fills it, so a longer text makes a larger block.
    """
    def row(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts)
        texts = [buffer_of(t) for t in whole["_text"].chunks]
        sizes = np.concatenate([np.diff(offsets) for _, offsets in texts])
        data = b"".join(data[offsets[0]:offsets[-1]] for data, offsets in texts)
        sink = pa.BufferOutputStream()
        others = whole.drop_columns(["_text"])
        with pa.ipc.new_stream(sink, others.schema,
                               options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(others)
        return pa.RecordBatch.from_pylist([{
            "block": number, "texts": zstandard.compress(data, 3),
            "ends": packed(np.cumsum(sizes).astype("<i8")),
            "rest": sink.getvalue().to_pybytes(), "n_bytes": len(data)}], BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            texts = batch["_text"].cast(pa.large_binary())
            ends, first = np.cumsum(np.diff(buffer_of(texts)[1])), 0
            while first < len(texts):
                before = int(ends[first - 1]) if first else 0
                last = int(np.searchsorted(ends, before + block_bytes - size)) + 1
                last = min(max(last, first + 1), len(texts))
                part = batch.slice(first, last - first)
                parts.append(part.set_column(
                    part.schema.get_field_index("_text"), "_text", texts.slice(first, last - first)))
                size += int(ends[last - 1]) - before
                if size >= block_bytes:
                    yield row(number, parts)
                    number, parts, size = number + 1, [], 0
                first = last
            # what waits must not hold on to whole batches
            parts = [pa.concat_batches(parts)] if len(parts) > 1 else parts
        if parts:
            yield row(number, parts)

    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(text.cast("binary"), F.lit(b"")).alias("_text"),
        *[value.alias(key) for key, value in rest.items()]).mapInArrow(run, BLOCKS_DDL)
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    (rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block")
     .option("path", scratch_path(spark, name)).saveAsTable(table))
    atexit.register(_forget, spark, table)
    return spark.table(table)


def _forget(spark: SparkSession, table: str) -> None:
    with contextlib.suppress(Exception):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that hold binary values without nulls, and the bounds of the values in them."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    bounds = (np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
              if offsets is not None and offsets.size else np.zeros(1, np.int64))
    return np.frombuffer(data if data is not None else b"", np.uint8), bounds


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the runs of true within each text; ``bounds`` are the texts' bounds."""
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    some = np.diff(bounds) > 0
    heads, lasts = bounds[:-1][some], bounds[1:][some] - 1
    begins[heads], ends[lasts] = inside[heads], inside[lasts]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1 - starts


def with_answers(blocks: DataFrame, answers: list[DataFrame],
                 run: Callable[[Block, list[list[np.ndarray]]], pa.Table], ddl: str) -> DataFrame:
    """``run`` on every block with, for each of ``answers``, its bits by part."""
    told, turns = None, len(answers)
    for i, each in enumerate(answers):
        each = each.select("block", F.lit(i).alias("turn"), "part", "bits")
        told = each if told is None else told.unionByName(each)

    def call(_: tuple, row: pa.Table, bits: pa.Table) -> pa.Table:
        by_turn: list[list] = [[] for _ in range(turns)]
        for one in sorted(bits.to_pylist(), key=lambda r: (r["turn"], r["part"])):
            by_turn[one["turn"]].append(np.frombuffer(one["bits"], np.uint8))
        return run(Block(row.to_pylist()[0]), by_turn)

    if told is None:
        return blocks.groupBy("block").applyInArrow(
            lambda _, row: run(Block(row.to_pylist()[0]), []), ddl)
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(call, ddl)


QUESTIONS = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("n", pa.int64()),
                       ("keys", pa.binary()), ("tails", pa.binary())])
QUESTIONS_DDL = "part int, block long, n long, keys binary, tails binary"


class Keys:
    """The distinct keys of a block in order, and which place holds which.

    A key is 64 bits, or 96 with ``tails``, 32 bits more.
    """

    def __init__(self, keys: np.ndarray, tails: np.ndarray | None, parts: int) -> None:
        order = np.argsort(keys, kind="stable") if tails is None else np.lexsort((tails, keys))
        keys = keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        if tails is not None:
            tails = tails[order]
            new[1:] |= tails[1:] != tails[:-1]
        self.keys, self.tails = keys[new], None if tails is None else tails[new]
        self.place = np.empty(len(keys), np.int32)
        self.place[order] = np.cumsum(new) - 1
        limits = (np.arange(1, parts, dtype=np.float64) * (2.0**64 / parts)).astype(np.uint64)
        edges = np.concatenate([[0], np.searchsorted(self.keys, limits), [len(self.keys)]])
        self.parts = [(int(p), int(edges[p]), int(edges[p + 1])) for p in np.flatnonzero(np.diff(edges))]

    def questions(self, block: int, shift: int = 0) -> pa.Table:
        """One row per part; the lowest ``shift`` bits of the keys are zero and not sent."""
        low = np.uint64(shift)
        return pa.Table.from_pylist([{
            "part": part, "block": block, "n": b - a,
            "keys": packed(np.diff(self.keys[a:b] >> low, prepend=np.uint64(0))),
            "tails": None if self.tails is None else packed(self.tails[a:b])}
            for part, a, b in self.parts], QUESTIONS)

    def repeated(self, bits: list[np.ndarray]) -> np.ndarray:
        """Per place: its key occurs at another place, of this block or another one."""
        shared = np.zeros(len(self.keys), bool)
        for (_, a, b), own in zip(self.parts, bits, strict=True):
            shared[a:b] = np.unpackbits(own, count=b - a).view(bool)
        return (shared | (np.bincount(self.place, minlength=len(self.keys)) > 1))[self.place]


def answers_of(questions: DataFrame) -> DataFrame:
    """(block, part, n_shared, bits): whether each key of a question is in another block's too."""
    schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("n_shared", pa.int64()),
                        ("bits", pa.binary())])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        asked = rows.select(["block", "n"]).to_pandas()
        keys = np.concatenate([np.cumsum(unpacked(k.as_py(), "<u8"), dtype=np.uint64)
                               for k in rows["keys"]])
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        if rows["tails"].null_count == 0:
            tails = np.concatenate([unpacked(t.as_py(), "<u4") for t in rows["tails"]])
            if np.any(same & (tails[order][1:] != tails[order][:-1])):
                order = np.lexsort((tails, keys))
                same = (keys[order][1:] == keys[order][:-1]) & (tails[order][1:] == tails[order][:-1])
        shared = np.zeros(len(keys), bool)
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        ends = np.cumsum(asked["n"].to_numpy())
        return pa.Table.from_pylist([
            {"block": int(block), "part": key[0].as_py(), "n_shared": int(own.sum()),
             "bits": np.packbits(own).tobytes()}
            for block, own in zip(asked["block"], np.split(shared, ends[:-1]), strict=True)], schema)

    return questions.groupBy("part").applyInArrow(
        run, "block long, part int, n_shared long, bits binary")
