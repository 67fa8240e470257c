"""Moving values along edges in cells of bounded size, with sums and pruning in one step.

A cell holds the rows of some labels and all edges into some nodes, so the sums it makes are whole
and what is below the limit never leaves it. Edges are packed once per block of nodes: the
ordinary ones by source, the light ones by the node they lead to. Inside a cell each label is
summed in arrays; the work follows the edges of the rows that it has, and no contribution is a row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphfeed.lineage import stored

# Edges and rows that a cell should have: some 16 bytes an edge, 24 a row, and as much again for sorting.
CELL_EDGES = 8_000_000
CELL_ROWS = 4_000_000
# Rows below which it does not pay to give a core a cell of its own.
LEAST_ROWS = 10_000

# Rows that hold a label's bounds instead of a value at a node.
ONE, ALL = -1, -2

_ARRAYS = {"sources": "<i8", "near_starts": "<i8", "near_nodes": "<i4", "near_weights": "<f8",
           "nodes": "<i8", "far_starts": "<i8", "far_sources": "<i4", "far_weights": "<f8", "wide": "<i8"}
_PACK_DDL = "block int, " + ", ".join(f"{name} binary" for name in _ARRAYS)
_MOVED_DDL = "node long, label long, value double"
_MOVED = pa.schema([("node", pa.int64()), ("label", pa.int64()), ("value", pa.float64())])


def _starts(sorted_codes: np.ndarray, n: int) -> np.ndarray:
    """Where the run of each code from 0 to n - 1 begins, and the end."""
    return np.searchsorted(sorted_codes, np.arange(n + 1)).astype("<i8")


def _pack(edges: pa.Table) -> pa.Table:
    src, dst, weight = (edges[c].to_numpy() for c in ("src", "dst", "weight"))
    light = edges["light"].to_numpy(zero_copy_only=False)
    nodes, code = np.unique(dst, return_inverse=True)
    code = code.astype("<i4")
    near = np.flatnonzero(~light)
    near = near[np.argsort(src[near], kind="stable")]
    sources, source = np.unique(src[near], return_inverse=True)
    far = np.flatnonzero(light)
    far = far[np.argsort(code[far], kind="stable")]
    wide, far_source = np.unique(src[far], return_inverse=True)
    arrays = {
        "sources": sources, "near_starts": _starts(source, len(sources)),
        "near_nodes": code[near], "near_weights": weight[near],
        "nodes": nodes, "far_starts": _starts(code[far], len(nodes)),
        "far_sources": far_source, "far_weights": weight[far], "wide": wide,
    }
    columns = {"block": pa.array([edges["block"][0].as_py()], pa.int32())}
    columns |= {name: pa.array([arrays[name].astype(kind).tobytes()], pa.binary())
                for name, kind in _ARRAYS.items()}
    return pa.table(columns)


def packed(near: DataFrame, far: DataFrame, cell_edges: int = CELL_EDGES) -> tuple[DataFrame, int]:
    """The edges as arrays, a row per block of nodes, and the number of blocks."""
    edges = near.select("src", "dst", "weight", F.lit(False).alias("light")).unionByName(
        far.select("src", "dst", "weight", F.lit(True).alias("light"))).dropna()
    blocks = max(1, -(-edges.count() // cell_edges))
    block = F.pmod(F.xxhash64("dst"), F.lit(blocks)).cast("int")
    # a block is a row of up to hundreds of megabytes
    packs = edges.withColumn("block", block).groupBy("block").applyInArrow(_pack, _PACK_DDL)
    return stored(packs, "packed-edges"), blocks


def runs(starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the runs of ``at``, one after another, and the length of each run."""
    first = starts[at]
    lengths = starts[at + 1] - first
    ends = np.cumsum(lengths)
    places = np.repeat(first - ends + lengths, lengths)
    places += np.arange(len(places))
    return places, lengths


def found(sorted_ids: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The place of each of ``ids``; -1 where it is not there."""
    if not len(sorted_ids):
        return np.full(len(ids), -1)
    at = np.minimum(np.searchsorted(sorted_ids, ids), len(sorted_ids) - 1)
    return np.where(sorted_ids[at] == ids, at, -1)


def _sums(nodes: np.ndarray, values: np.ndarray, n: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Nodes whose sum is above ``least``, not below zero, and the sums."""
    if len(nodes) * 32 < n:  # few of the nodes: sorting costs less than a sum per node
        order = np.argsort(nodes, kind="stable")
        nodes = nodes[order]
        first = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]])) if len(nodes) else nodes
        sums = np.add.reduceat(values[order], first) if len(nodes) else values
        kept = sums > least
        return nodes[first][kept], sums[kept]
    # of nothing it makes whole numbers
    sums = np.bincount(nodes, values, minlength=n).astype(float, copy=False)
    kept = np.flatnonzero(sums > least)
    return kept, sums[kept]


class _Block:
    """The edges into the nodes of a block."""

    def __init__(self, pack: pa.Table) -> None:
        row = pack.to_pylist()[0]
        for name, kind in _ARRAYS.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.n_wide = np.diff(self.far_starts).astype(float)
        self.most_wide = self.n_wide.max(initial=0.0)
        self.held = np.zeros(len(self.wide))

    def moved(self, at: np.ndarray, wide_at: np.ndarray, values: np.ndarray, one: float, every: float,
              limit: float) -> tuple[np.ndarray, np.ndarray]:
        """Nodes that a label with ``values`` at some sources reaches along ordinary edges, and sums.

        What light edges add is looked up where their reach is up to the limit, and left to
        others where it is above.
        """
        near = at >= 0
        places, lengths = runs(self.near_starts, at[near])
        moved = np.repeat(values[near], lengths)
        moved *= self.near_weights[places]
        most = min(one * self.most_wide, every)
        nodes, sums = _sums(self.near_nodes[places], moved, len(self.nodes), max(limit - most, 0.0))
        reach = np.minimum(one * self.n_wide[nodes], every)
        open_ = reach > limit
        asked = np.flatnonzero((reach > 0) & ~open_ & (sums + reach > limit))
        if len(asked):
            wide = np.flatnonzero(wide_at >= 0)
            np.add.at(self.held, wide_at[wide], values[wide])
            places, lengths = runs(self.far_starts, nodes[asked])
            along = self.held[self.far_sources[places]] * self.far_weights[places]
            sums[asked] += np.bincount(np.repeat(np.arange(len(asked)), lengths), along, len(asked))
            self.held[wide_at[wide]] = 0.0
        kept = open_ | (sums > limit)
        return nodes[kept], sums[kept]


def _in_cell(limit: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(rows: pa.Table, packs: pa.Table) -> pa.Table:
        if not (rows.num_rows and packs.num_rows):
            return _MOVED.empty_table()
        block = _Block(packs)
        label = rows["label"].to_numpy()
        order = np.argsort(label, kind="stable")
        label, node, value = label[order], rows["node"].to_numpy()[order], rows["value"].to_numpy()[order]
        del rows, packs, order
        at, wide_at = found(block.sources, node), found(block.wide, node)
        firsts = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
        ends = np.append(firsts[1:], len(label))
        bounds = {kind: dict(zip(label[mine].tolist(), value[mine].tolist(), strict=True))
                  for kind, mine in ((ONE, node == ONE), (ALL, node == ALL))}
        nodes, labels, sums = [], [], []
        for first, end in zip(firsts.tolist(), ends.tolist(), strict=True):
            of = int(label[first])
            reached, total = block.moved(at[first:end], wide_at[first:end], value[first:end],
                                         bounds[ONE].get(of, 0.0), bounds[ALL].get(of, 0.0), limit)
            nodes.append(block.nodes[reached])
            labels.append(np.full(len(reached), of))
            sums.append(total)
        return pa.table([np.concatenate(nodes), np.concatenate(labels), np.concatenate(sums)], schema=_MOVED)

    return run


def moved(ranks: DataFrame, bounds: DataFrame, packs: DataFrame, blocks: int, limit: float,
          cell_rows: int | None = None) -> DataFrame:
    """(node, label, value) after moving (node, label, value) along packed edges, summed.

    ``bounds`` has, per label, the most that one light edge adds to a node and all of them
    together. Where both tell that light edges can add more than the limit to a node (its reach),
    the value is the sum along ordinary edges alone, else the whole sum if it is above the limit.
    """
    spark = ranks.sparkSession
    n, cores = ranks.count(), spark.sparkContext.defaultParallelism
    parts = max(1, -(-n // (cell_rows or CELL_ROWS)), min(cores, n // LEAST_ROWS))
    if parts > cores:
        parts += -parts % cores
    by_part = F.broadcast(places(spark, parts, blocks))
    rows = ranks.select("node", "label", "value")
    for kind, name in ((ONE, "one"), (ALL, "all")):
        rows = rows.unionByName(bounds.select(
            F.lit(kind).cast("long").alias("node"), "label", F.col(name).alias("value")))
    part = F.pmod(F.xxhash64("label"), F.lit(parts)).cast("int")
    rows = rows.withColumn("part", part).join(by_part, "part").select("cell", "node", "label", "value")
    # a task each copies the packs for some parts
    packs = packs.crossJoin(spark.range(parts, numPartitions=cores).select(
        F.col("id").cast("int").alias("part"))).join(by_part, ["part", "block"]).select(
        F.col("cell").alias("to"), *packs.columns)
    return (
        rows.repartition(parts * blocks, "cell").groupBy("cell")
        .cogroup(packs.repartition(parts * blocks, "to").groupBy("to"))
        .applyInArrow(_in_cell(limit), _MOVED_DDL)
    )


def places(spark: SparkSession, parts: int, blocks: int) -> DataFrame:
    """(part, block, cell): a key for each cell, such that cells hash to tasks of their own.

    A key that falls where another one does makes a task longer, nothing else.
    """
    n = parts * blocks
    tries = spark.range(32 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("task"))
    found = [r["id"] for r in tries.groupBy("task").agg(F.min("id").alias("id")).collect()]
    # numbers from above those tried for tasks that none of them falls to
    found += range(32 * n, 33 * n - len(found))
    return spark.createDataFrame(
        [(i // blocks, i % blocks, key) for i, key in enumerate(found)], "part int, block int, cell long")
