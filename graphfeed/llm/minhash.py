"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

1. A text becomes the set of its word shingles, hashed to 64 bits; equal sets become one node,
   so copies cost one row each from then on.
2. A node's signature of ``HASHES`` minima is cut into bands; nodes that share a band are
   candidates. At similarity 0.8 a pair misses all 32 bands of 4 with probability 5e-8.
3. In a band, every node is first compared with one pivot, which puts a large group of copies
   into one component at one comparison per node and band. Bands whose nodes are then all in one
   component are done. In the others, the nodes outside the band's main component are compared
   with all nodes of other components, in blocks of at most about ``BLOCK`` nodes a side, so no
   task holds a whole band. A pair is skipped only if its two nodes are known to be in one
   component, or meet in a band of a lower number.
4. A comparison reads signatures in batches. After each batch the pair is dropped if the
   posterior probability (uniform prior) that its similarity reaches the threshold is below
   ``MISS``. What survives is verified on the full sets; only links leave a block.

Sets of nodes without a shared band are never built a second time.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphfeed.lineage import stored
from graphfeed.llm.components import components

SHINGLE_WORDS = 5
PERCENT = 80
BANDS = 32
ROWS = 4
HASHES = BANDS * ROWS
BATCH = 16
MISS = 1e-7
BLOCK = 2048
BLOCK_SHINGLES = 1_000_000
SEED = 20240229


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes, k: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``k`` words; A-Z in lower case.

    A shorter text is one shingle; a text without words has none. ``bytes.split`` and
    ``bytes.lower`` know ASCII only: the separators are space and tab to carriage return.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(k, len(words))
    mix = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        mix = _mixed(mix * np.uint64(0x9E3779B97F4A7C15) + h[i:len(words) - width + 1 + i])
    return np.unique(mix)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    return (random.integers(0, 2**64, (HASHES, 1), np.uint64) | np.uint64(1),
            random.integers(0, 2**64, (HASHES, 1), np.uint64))


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, 2**32 - 1, np.uint64)
    for i in range(0, len(shingles), 2048):
        part = (shingles[i:i + 2048] * a + b) >> np.uint64(32)
        least = np.minimum(least, part.min(axis=1))
    return least.astype("<u4")


SIGNED = pa.schema([("_row", pa.int64()), ("_id", pa.int64()), ("n_shingles", pa.int64()),
                    ("set_hash", pa.binary()), ("signature", pa.binary())])
WITH_SET = pa.schema([("set_hash", pa.binary()), ("shingles", pa.list_(pa.int64()))])


def signed(docs: DataFrame, row: Column, doc_id: Column, text: Column, k: int) -> DataFrame:
    """(_row, _id, n_shingles, set_hash, signature) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _permutations()
        hashes = _WordHashes()
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for value in batch["_text"]:
                found = shingle_set(value.as_py() or b"", k, hashes)
                sizes.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                signatures.append(signature(found, a, b).tobytes() if len(found) else None)
                if len(hashes) > 1_000_000:
                    hashes.clear()
            yield pa.RecordBatch.from_arrays(
                [batch["_row"], batch["_id"], pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())], schema=SIGNED)

    return docs.select(row.cast("long").alias("_row"), doc_id.cast("long").alias("_id"),
                       text.cast("binary").alias("_text")).mapInArrow(
        run, "_row long, _id long, n_shingles long, set_hash binary, signature binary")


def _sets(docs: DataFrame, doc_id: Column, text: Column, k: int, wanted: DataFrame) -> DataFrame:
    """(set_hash, shingles) of the documents whose id is in ``wanted``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for i in range(0, len(batch), 256):  # sets are larger than texts
                found = [shingle_set(v.as_py() or b"", k, hashes) for v in batch["_text"][i:i + 256]]
                if len(hashes) > 1_000_000:
                    hashes.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(f.tobytes()) for f in found], pa.binary()),
                     pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))],
                    schema=WITH_SET)

    some = docs.select(doc_id.cast("long").alias("_id"), text.cast("binary").alias("_text"))
    # by hash at every size: the ids are small, the texts are not to be sorted
    want = wanted.select(F.col("_id").alias("_want")).distinct().hint("shuffle_hash")
    return some.join(want, F.col("_id").eqNullSafe(F.col("_want")), "left_semi").select(
        "_text").mapInArrow(run, "set_hash binary, shingles array<long>")


def least_matches(percent: int = PERCENT, miss: float = MISS, hashes: int = HASHES,
                  batch: int = BATCH) -> list[tuple[int, int]]:
    """(hashes seen, matches below which a pair is dropped) after each batch.

    With a uniform prior the similarity given m of n matches is Beta(m + 1, n - m + 1), and
    P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    t, table = percent / 100, []
    for n in range(batch, hashes + 1, batch):
        total, least = 0.0, 0
        for m in range(n + 1):
            total += comb(n + 1, m) * t**m * (1 - t)**(n + 1 - m)
            if total >= miss:
                least = m
                break
        table.append((n, least))
    return table


def _alive(x: np.ndarray, y: np.ndarray, table: list[tuple[int, int]]) -> np.ndarray:
    """The rows of ``x`` and ``y`` (signatures) that no batch drops."""
    alive, seen, matches = np.arange(len(x)), 0, np.zeros(len(x), np.int64)
    for n, least in table:
        matches[alive] += (x[alive, seen:n] == y[alive, seen:n]).sum(axis=1)
        alive, seen = alive[matches[alive] >= least], n
    return alive


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, HASHES)


def _survivors(pairs: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b, with both signatures) that no batch drops."""
    table = least_matches(percent, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                taken = pa.array(_alive(_signatures(batch["_sa"]), _signatures(batch["_sb"]), table))
                yield pa.RecordBatch.from_arrays(
                    [batch["a"].take(taken), batch["b"].take(taken)], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """How many numbers two sorted sets have in common."""
    both = np.sort(np.concatenate([x, y]))
    return int((both[1:] == both[:-1]).sum())


class _Groups:
    """Nodes of a block that are known to be linked, to skip what needs no comparison."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def top(self, node: int) -> int:
        while (above := self.up.get(node, node)) != node:
            self.up[node] = self.up.get(above, above)
            node = above
        return node

    def join(self, a: int, b: int) -> None:
        self.up[self.top(a)] = self.top(b)


def _links_of(group: pa.RecordBatch, percent: int, table: list[tuple[int, int]]
              ) -> list[tuple[int, int]]:
    """Links between the outer nodes (side 0) and the nodes (side 1) of a block of a band."""
    side, node, part, outer = (group[c].to_numpy(zero_copy_only=False)
                               for c in ("side", "node", "component", "outer"))
    own_band = int(group["band"][0].as_py()) & (BANDS - 1)
    signs, sets = _signatures(group["signature"]), group["shingles"]
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    linked, links = _Groups(), []
    for i in range(0, len(left), 64):
        some = left[i:i + 64]
        # two outer nodes meet twice; one time counts
        meet = (part[some][:, None] != part[right]) & (
            ~outer[right] | (node[some][:, None] < node[right]))
        x, y = np.nonzero(meet)
        x, y = some[x], right[y]
        alive = _alive(signs[x], signs[y], table)
        x, y = x[alive], y[alive]
        bands = (signs[x] == signs[y]).reshape(-1, BANDS, ROWS).all(2)
        first = bands.argmax(1) == own_band
        for a, b in zip(x[first].tolist(), y[first].tolist(), strict=True):
            if linked.top(int(part[a])) == linked.top(int(part[b])):
                continue
            one, two = sets[a].values.to_numpy(), sets[b].values.to_numpy()
            both = _shared(one, two)
            if 100 * both >= percent * (len(one) + len(two) - both):
                links.append((int(node[a]), int(node[b])))
                linked.join(int(part[a]), int(part[b]))
    return links


def _blocked(here: DataFrame, nodes: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links (u, v) in open bands (``here``: band, node, component) that join all components
    which the bands' pairs link. ``nodes`` has node, signature and shingles.

    The outer nodes of a band, those outside its main component, are cut into blocks, all of its
    nodes into chunks, and each block meets each chunk in a group of its own.
    """
    by_part = here.groupBy("band", "component").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    main = F.struct("n", "size", "component")
    shape = by_part.groupBy("band").agg(
        F.max(main).alias("main"), F.sum("n").alias("_n"), F.sum("size").alias("_size"))
    outer, outer_size = F.col("_n") - F.col("main.n"), F.col("_size") - F.col("main.size")
    shape = shape.select("band", F.col("main.component").alias("main"), *[
        F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_SHINGLES)).cast("int").alias(name)
        for name, n, size in [("chunks", F.col("_n"), F.col("_size")), ("blocks", outer, outer_size)]])
    rows = here.join(shape, "band").select(
        "band", "node", "component", (F.col("component") != F.col("main")).alias("outer"),
        "chunks", "blocks")
    own = F.xxhash64("node", F.lit(1))

    def side(df: DataFrame, number: int, fixed: str, spread: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.col(f"{spread}s") - 1)).alias(spread)
        return df.select("band", "node", "component", "outer", F.lit(number).alias("side"),
                         F.pmod(own, F.col(f"{fixed}s")).cast("int").alias(fixed), every)

    sides = side(rows.filter("outer"), 0, "block", "chunk").unionByName(
        side(rows, 1, "chunk", "block"))
    keys = ["band", "block", "chunk"]
    table = least_matches(percent, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups come one after another; the last one of a batch may go on in the next."""
        def out(group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if links := _links_of(group, percent, table):
                u, v = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            key = np.column_stack([batch[k].to_numpy() for k in keys])
            before = key[0] if not held else np.array([held[-1][k][-1].as_py() for k in keys])
            starts = np.flatnonzero((key != np.vstack([before, key[:-1]])).any(1)).tolist()
            for i, (a, b) in enumerate(zip([0, *starts], [*starts, len(batch)], strict=True)):
                if i and held:
                    yield from out(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held = []
                if a < b:
                    held.append(batch.slice(a, b - a))
        if held:
            yield from out(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return (sides.join(nodes, "node").repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(run, "u long, v long"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (u, v): pairs of nodes whose full sets reach the threshold."""
    shared = F.size(F.array_intersect("_xa", "_xb"))
    return (
        pairs.join(sets.toDF("a", "_xa"), "a").join(sets.toDF("b", "_xb"), "b")
        .select("a", "b", shared.alias("_both"), (F.size("_xa") + F.size("_xb")).alias("_sum"))
        .filter(100 * F.col("_both") >= percent * (F.col("_sum") - F.col("_both")))
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )


def _link(nodes: DataFrame, members: DataFrame, sets: DataFrame, percent: int,
          miss: float) -> DataFrame:
    """(node, component) of the nodes that are linked with another."""
    signs = nodes.select("node", "signature")
    pivots = members.groupBy("band").agg(F.min("node").alias("_pivot"))
    pairs = members.join(pivots, "band").filter(F.col("node") != F.col("_pivot")).select(
        F.col("_pivot").alias("a"), F.col("node").alias("b")).distinct()
    both = pairs.join(signs.toDF("a", "_sa"), "a").join(signs.toDF("b", "_sb"), "b")
    near = _survivors(both.select("a", "b", "_sa", "_sb"), percent, miss)
    known = stored(components(_verified(near, sets, percent)), "components")

    here = members.join(known, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    open_bands = here.groupBy("band").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high"),
        F.count(F.lit(1)).alias("_n"))
    # a band of two nodes has nothing left to compare
    open_bands = open_bands.filter("_low < _high and _n > 2").select("band")
    here = stored(here.join(open_bands, "band", "left_semi"), "bands-open")
    edges = stored(_blocked(here, signs.join(sets, "node"), percent, miss), "links")
    return stored(_merged(known, edges), "components")


def _merged(known: DataFrame, edges: DataFrame) -> DataFrame:
    """The components after more edges: those edges join whole components."""
    def named(df: DataFrame, name: str) -> DataFrame:
        of = known.select(F.col("node").alias(name), F.col("component").alias(f"_{name}"))
        return df.join(of, name, "left").withColumn(name, F.coalesce(f"_{name}", name)).drop(f"_{name}")

    joined = components(named(named(edges, "u"), "v"))
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("_new"))
    old = known.join(moved, "component", "left").select(
        "node", F.coalesce("_new", "component").alias("component"))
    fresh = joined.join(known.select("node"), "node", "left_anti")
    return old.unionByName(fresh)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT, miss: float = MISS, row_col: str | None = None,
) -> DataFrame:
    """Per row of ``docs``: _row, _id, n_shingles, component_id, first.

    Documents are linked if ``100 * intersection >= percent * union`` of their shingle sets, and
    ``component_id`` is the smallest id that links reach. Null, empty and word-less texts have no
    shingle and are linked with nothing. Repeated rows and rows with equal ids are rows of their
    own; a null id is never the smallest, and a component of null ids only has a null
    ``component_id``. ``first`` marks one row per component: that of the smallest id and then
    of the smallest ``row_col`` (needed for it to be one row where ids repeat).
    """
    row = F.col(row_col) if row_col else F.lit(None)
    rows = stored(signed(docs, row, F.col(id_col), F.col(text), shingle_words), "signatures")
    words = rows.filter("n_shingles > 0")
    nodes = stored(
        words.groupBy("set_hash").agg(F.min("_id").alias("_id"), F.first("signature").alias("signature"),
                                      F.first("n_shingles").alias("n_shingles"))
        # sets are told apart by 128 bits; the node's number by 64 of them
        .withColumn("node", F.xxhash64("set_hash")), "nodes")
    bands = nodes.select("node", "n_shingles", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        # the lowest bits of a band are its number
        lambda b: F.xxhash64(b, F.substring("signature", b * (4 * ROWS) + 1, F.lit(4 * ROWS)))
        .bitwiseAND(F.lit(-BANDS).cast("long")).bitwiseOR(b.cast("long")))).alias("band"))
    shared = bands.groupBy("band").agg(F.min("node").alias("_low"), F.max("node").alias("_high")
                                       ).filter("_low < _high").select("band")
    members = stored(bands.join(shared, "band", "left_semi"), "bands")
    met = stored(nodes.join(members.select("node").distinct(), "node", "left_semi"), "nodes-met")
    sets = stored(
        _sets(docs, F.col(id_col), F.col(text), shingle_words, met)
        .join(met.select("set_hash", "node"), "set_hash")
        # by the key of the join, which needs no further shuffle
        .groupBy("set_hash").agg(F.first("node").alias("node"), F.first("shingles").alias("shingles"))
        .drop("set_hash"), "sets")
    linked = _link(met, members, sets, percent, miss)
    owner = nodes.select("set_hash", "node", "_id").join(linked, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = owner.groupBy("component").agg(F.min("_id").alias("component_id"))
    named = owner.join(least, "component").select("set_hash", "component", "component_id")
    out = rows.drop("signature").join(named, "set_hash", "left")
    own = F.col("component").isNull()
    out = out.withColumn("component_id", F.when(own, F.col("_id")).otherwise(F.col("component_id")))
    if row_col is None:
        return out.select("_row", "_id", "n_shingles", "component_id",
                          (own | F.col("_id").eqNullSafe(F.col("component_id"))).alias("first"))
    out = stored(out, "rows-grouped")
    chosen = out.filter(~own).groupBy("component").agg(
        F.min(F.struct(F.col("_id").isNull().alias("n"), "_id", "_row"))["_row"].alias("_first"))
    return out.join(chosen, "component", "left").select(
        "_row", "_id", "n_shingles", "component_id",
        (F.col("_first").isNull() | (F.col("_first") == F.col("_row"))).alias("first"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of each group of near duplicates, with the columns of ``docs``."""
    rows = stored(docs.select(F.struct(*docs.columns).alias("_doc"))
                  .withColumn("_n", F.monotonically_increasing_id()), "dedup-rows")
    flat = rows.select("_n", F.col(f"_doc.{id_col}").alias("_i"), F.col(f"_doc.{text}").alias("_t"))
    kept = near_duplicates(flat, "_i", "_t", row_col="_n", **how).filter("first")
    chosen = kept.select(F.col("_row").alias("_n")).hint("shuffle_hash")
    return rows.join(chosen, "_n", "left_semi").select("_doc.*")
