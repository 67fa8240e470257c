"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample of about ``SAMPLE`` distinct vectors by k-means with
a charge for full clusters. Every vector goes to its nearest list and, near a boundary, to
further ones within ``(1 + SPREAD)`` of the nearest distance, unless a chosen centroid is
nearer to that one than the vector is. A query finds the nearest centroids by best-first search in
their neighbour graph, which sits in memory (at most ``MAX_LISTS`` centroids), and follows its links
to all lists within a distance ratio of the nearest ones. Distances to the vectors of a list are exact.

The ratio is measured, not fixed: for ``TRIALS`` sampled vectors the true neighbours among all vectors are
found by brute force, and the smallest ratio is taken at which their lists hold ``TARGET`` of these.
So recall holds at any size and shape; data without clusters cost more lists instead.

Lists near each other form a group of at most ``GROUP``; a query is sent once to each group in which
it has lists. Equal vectors are one posting with its smallest ids, as many as an answer can use, so any
number of copies costs one comparison. Large groups are cut into chunks and the queries of a group into
blocks; each chunk meets each block in a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphfeed.lineage import stored
from graphfeed.llm.common import hash_sample

SAMPLE = 20_000
MAX_LISTS = 4096
LIST_SIZE = 64
REPLICAS = 8
SPREAD = 0.15
LEAST_LISTS = 8
WIDTH = 32
TRIALS = 256
TARGET = 0.97
GROUP = 64
NEIGHBOURS = 16
CHUNK = 4096
BLOCK = 1024
ROUNDS = 8


def usable(vector: Column) -> Column:
    """Not null, not zero, without null or non-finite components."""
    v = vector.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
    # differences of overflowing squares are far away, not undefined
    return np.maximum(np.where(np.isnan(d), np.inf, d), 0)


def balanced_centroids(sample: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """k-means in which a cluster costs more the fuller it is."""
    random = np.random.default_rng(seed)
    centroids = sample[random.permutation(len(sample))[:k]].copy()
    fair = len(sample) / k
    for turn in range(rounds):
        charge = None
        sums, counts = np.zeros_like(centroids), np.zeros(k)
        for part in np.array_split(random.permutation(len(sample)), max(1, len(sample) // 512)):
            d = _squares(sample[part], centroids)
            if charge is None:
                charge = 0.2 * np.median(d.min(1)) * min(turn, 3) / 3
            nearest = np.argmin(d + charge * np.maximum(counts / fair - 0.5, 0), axis=1)
            np.add.at(sums, nearest, sample[part])
            counts += np.bincount(nearest, minlength=k)
        full = counts > 0
        centroids[full] = sums[full] / counts[full, None]
    return centroids


def neighbour_graph(centroids: np.ndarray, degree: int = NEIGHBOURS) -> np.ndarray:
    """For each centroid its nearest others, and a long link that keeps the graph in one piece."""
    k = len(centroids)
    degree = min(degree, k - 1)
    if degree <= 0:
        return np.zeros((k, 1), np.int64)
    near = []
    for i in range(0, k, 512):
        d = _squares(centroids[i:i + 512], centroids)
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        near.append(np.argsort(d, axis=1)[:, :degree])
    return np.hstack([np.vstack(near), ((np.arange(k) + max(1, k // 2)) % k)[:, None],
                      ((np.arange(k) + 1) % k)[:, None]])


def graph_search(queries: np.ndarray, centroids: np.ndarray, graph: np.ndarray, width: int
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, distances) of the ``width`` nearest found for each query, nearest first.

    Best-first search of all queries side by side, from a few entry points; a query ends when
    each of its ``width`` best has been expanded.
    """
    n, k = len(queries), len(centroids)
    width = min(width, k)
    rows = np.arange(n)
    entries = np.unique(np.linspace(0, k - 1, min(k, max(width, 32))).astype(int))
    d0 = np.sqrt(_squares(queries, centroids[entries]))
    seen = np.zeros((n, k), bool)
    seen[:, entries] = True
    order = np.argsort(d0, axis=1)[:, :width]
    best, dist = entries[order], np.take_along_axis(d0, order, 1)
    if best.shape[1] < width:
        pad = width - best.shape[1]
        best = np.pad(best, ((0, 0), (0, pad)))
        dist = np.pad(dist, ((0, 0), (0, pad)), constant_values=np.inf)
    done = np.isinf(dist)
    while len(rows):
        open_at = np.where(done[rows], np.inf, dist[rows])
        at = open_at.argmin(1)
        live = np.isfinite(open_at[np.arange(len(rows)), at])
        rows, at = rows[live], at[live]
        if not len(rows):
            break
        done[rows, at] = True
        nexts = graph[best[rows, at]]
        d = np.sqrt(((centroids[nexts] - queries[rows][:, None, :]) ** 2).sum(2))
        d[seen[rows[:, None], nexts]] = np.inf
        seen[rows[:, None], nexts] = True
        # links may repeat within a row of the graph
        sort = np.argsort(nexts, axis=1, kind="stable")
        same = np.take_along_axis(nexts, sort, 1)
        repeat = np.zeros_like(d, bool)
        np.put_along_axis(repeat, sort, np.pad(same[:, 1:] == same[:, :-1], ((0, 0), (1, 0))), 1)
        d[repeat] = np.inf
        all_best = np.hstack([best[rows], nexts])
        all_dist = np.hstack([dist[rows], d])
        all_done = np.hstack([done[rows], np.isinf(d)])
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :width]
        best[rows] = np.take_along_axis(all_best, order, 1)
        dist[rows] = np.take_along_axis(all_dist, order, 1)
        done[rows] = np.take_along_axis(all_done, order, 1)
    return best, dist


def replicated(vectors: np.ndarray, centroids: np.ndarray, graph: np.ndarray) -> list[list[int]]:
    """The lists of each vector: the nearest, and others near a boundary."""
    found, dist = graph_search(vectors, centroids, graph, WIDTH)
    between = [None] * len(vectors)
    for i, (near, d) in enumerate(zip(found, dist, strict=True)):
        chosen = [near[0]]
        for c, far in zip(near[1:], d[1:], strict=True):
            if far > (1 + SPREAD) * d[0] or len(chosen) == REPLICAS:
                break
            if (((centroids[chosen] - centroids[c]) ** 2).sum(1) > far * far).all():
                chosen.append(c)
        between[i] = [int(c) for c in chosen]
    return between


def _within(vector: np.ndarray, start: np.ndarray, centroids: np.ndarray, graph: np.ndarray,
            limit: float) -> np.ndarray:
    """The centroids up to ``limit`` away that links lead to from ``start``, over others such."""
    seen = np.zeros(len(centroids), bool)
    seen[start] = True
    inside, border = [start], start
    while len(border):
        nexts = np.unique(graph[border])
        nexts = nexts[~seen[nexts]]
        seen[nexts] = True
        border = nexts[np.sqrt(((centroids[nexts] - vector) ** 2).sum(1)) <= limit]
        inside.append(border)
    return np.concatenate(inside)


class Probe:
    """Which lists a query reads: the ``LEAST_LISTS`` nearest and all within the distance ratio."""

    def __init__(self, centroids: np.ndarray, graph: np.ndarray, ratio: float = 0.0, floor: float = 0.0):
        self.centroids, self.graph, self.ratio, self.floor = centroids, graph, ratio, floor

    def __call__(self, vectors: np.ndarray) -> list[np.ndarray]:
        found, dist = graph_search(vectors, self.centroids, self.graph, WIDTH)
        least = min(LEAST_LISTS, found.shape[1])
        out = []
        for vector, near, d in zip(vectors, found, dist, strict=True):
            limit = (1 + self.ratio) * max(d[least - 1], self.floor)
            real = near[np.isfinite(d) & ((d <= limit) | (np.arange(len(d)) < least))]
            out.append(_within(vector, real, self.centroids, self.graph, limit))
        return out

    def measured(self, trials: np.ndarray, truth: list[tuple[int, list[int]]]) -> Probe:
        """With the smallest ratio that finds ``TARGET`` of ``truth``: (trial, lists of a neighbour)."""
        d = np.sqrt(_squares(trials, self.centroids))
        least = min(LEAST_LISTS, d.shape[1])
        reach = np.partition(d, least - 1, axis=1)[:, least - 1]
        self.floor = float(np.median(reach)) * 1e-3
        reach = np.maximum(reach, self.floor)
        need = np.sort([d[t, lists].min() / (reach[t] or 1.0) for t, lists in truth])
        need = np.where(np.isfinite(need), need, 1.0)
        self.ratio = max(0.0, float(need[int(np.ceil(TARGET * len(need))) - 1]) - 1 + 1e-9)
        while True:  # links may miss a list within the ratio: take a wider one then
            read = [set(lists.tolist()) for lists in self(trials)]
            hits = sum(not read[t].isdisjoint(lists) for t, lists in truth)
            if hits >= (TARGET - 0.01) * len(truth) or min(map(len, read)) == len(self.centroids):
                return self
            if self.ratio > 1e6:  # nothing more to reach
                return self
            self.ratio = 1.05 * (1 + self.ratio) - 1


def grouped(centroids: np.ndarray, size: int = GROUP) -> np.ndarray:
    """A group for each list: halves along the widest direction until ``size`` are left."""
    group, parts, n = np.zeros(len(centroids), np.int32), [np.arange(len(centroids))], 0
    while parts:
        part = parts.pop()
        if len(part) <= size:
            group[part] = n
            n += 1
            continue
        spread = centroids[part] - centroids[part].mean(0)
        along = spread @ np.linalg.svd(spread, full_matrices=False)[2][0] if np.isfinite(
            spread).all() else part
        parts += np.array_split(part[np.argsort(along, kind="stable")], 2)
    return group


def _placed(df: DataFrame, lists, group: np.ndarray, ddl: str) -> DataFrame:
    """``df`` (with ``vector``) once per group, with those of its ``lists`` that are in it."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in range(0, len(frame), 256):
                part = frame.iloc[i:i + 256]
                at, groups, inside = [], [], []
                for row, found in enumerate(lists(np.stack(part["vector"].to_numpy()))):
                    found = np.sort(np.asarray(found, np.int32))
                    for g in np.unique(group[found]):
                        at.append(row)
                        groups.append(g)
                        inside.append(found[group[found] == g])
                yield part.iloc[at].assign(grp=np.array(groups, np.int32), lists=inside)

    return df.mapInPandas(run, f"{ddl}, grp int, lists array<int>")


def _true_lists(postings: DataFrame, trials: list, place, n: int) -> list[tuple[int, list[int]]]:
    """(trial, lists) of the ``n`` nearest other vectors of each trial, by brute force over all."""
    keys = np.array([t["key"] for t in trials])
    points = np.array([t["vector"] for t in trials])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in range(0, len(frame), 4096):
                part = frame.iloc[i:i + 4096]
                d = _squares(points, np.stack(part["vector"].to_numpy()))
                d[keys[:, None] == part["key"].to_numpy()[None, :]] = np.inf
                near = np.argsort(d, axis=1, kind="stable")[:, :n]
                trial = np.repeat(np.arange(len(points)), near.shape[1])
                best = part.iloc[near.ravel()]
                yield best.assign(trial=trial.astype(np.int32), d=d[trial, near.ravel()])[
                    ["trial", "d", "key", "vector"]]

    each = postings.select("key", "vector").mapInPandas(
        run, "trial int, d double, key long, vector array<double>").filter(F.col("d") < float("inf"))
    place_of = F.row_number().over(Window.partitionBy("trial").orderBy("d", "key"))
    # at most n rows a trial
    rows = each.withColumn("_p", place_of).filter(F.col("_p") <= n).select("trial", "vector").collect()
    if not rows:
        return []
    return list(zip([r["trial"] for r in rows], place(np.array([r["vector"] for r in rows])), strict=True))


def _cut(df: DataFrame, size: int, name: str, key: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with a piece number per group, pieces of about ``size`` rows; and (grp, pieces)."""
    pieces = stored(df.groupBy("grp").agg(
        F.ceil(F.count(F.lit(1)) / size).cast("int").alias(f"_{name}s")), f"ann-{name}s")
    # one row per group, fewer than MAX_LISTS
    cut = df.join(F.broadcast(pieces), "grp").withColumn(
        name, F.pmod(F.xxhash64(key), F.col(f"_{name}s")).cast("int")).drop(f"_{name}s")
    return cut, pieces


def nearest(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    n: int = 10,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``n`` nearest found of each query, itself left out.

    Score is the Euclidean distance in double precision; ties go to the smaller id. Vectors that
    are not ``usable``, that have a null id, or that differ in length from the most frequent length
    take no part. Of rows with equal id and vector one counts. A query for which the lists
    give fewer than ``n`` reads all lists.
    """
    rows = vectors.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), is_query.alias("_query"),
        F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vector"))
    rows = stored(rows.distinct(), "ann-vectors")
    shape = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("c")).orderBy(
        F.desc("c"), F.desc("d")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if shape is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.filter(F.size("vector") == shape["d"])
    first = Window.partitionBy("vector").orderBy("id")
    postings = stored(
        rows.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= n + 1)
        .groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("key", F.element_at("ids", 1)), "ann-postings")
    count = postings.count()
    rows_of_sample = sorted(hash_sample(postings, "key", SAMPLE, count).select("key", "vector").collect())
    sample = np.array([r["vector"] for r in rows_of_sample])
    lists = int(np.clip(count // LIST_SIZE, 1, min(MAX_LISTS, max(1, len(sample) // 4))))
    centroids = balanced_centroids(sample, lists)
    graph, group = neighbour_graph(centroids), grouped(centroids)

    def place(found: np.ndarray) -> list[list[int]]:
        return replicated(found, centroids, graph)

    probe = Probe(centroids, graph)
    trials = rows_of_sample[::max(1, len(sample) // TRIALS)][:TRIALS]
    truth = _true_lists(postings, trials, place, n) if lists > LEAST_LISTS else []
    if truth:
        probe.measured(np.array([t["vector"] for t in trials]), truth)

    index = stored(_placed(postings, place, group, "vector array<double>, ids array<long>, key long"),
                   "ann-lists")
    queries = rows.filter("_query").select(F.col("id").alias("query_id"), "vector")
    ddl = "query_id long, vector array<double>"
    found = stored(_searched(index, stored(_placed(queries, probe, group, ddl), "ann-queries"), n),
                   "ann-found")
    short = stored(queries.join(found.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"))
                                .filter(F.col("_n") >= n), "query_id", "left_anti"), "ann-short")
    if short.isEmpty():
        return found
    every = _placed(short, lambda part: [np.arange(lists)] * len(part), group, ddl)
    return found.join(short, "query_id", "left_anti").unionByName(
        _searched(index, stored(every, "ann-every"), n))


def _marked(lists: pd.Series, width: int) -> np.ndarray:
    """A row of ones and zeros for each row's lists."""
    marks = np.zeros((len(lists), width), np.float32)
    marks[np.repeat(np.arange(len(lists)), lists.map(len)), np.concatenate(lists.to_numpy())] = 1
    return marks


def _searched(index: DataFrame, asked: DataFrame, n: int) -> DataFrame:
    chunked, chunks = _cut(index, CHUNK, "chunk", "key")
    blocked, blocks = _cut(asked, BLOCK, "block", "query_id")
    # every chunk of a group meets every block of its queries
    left = blocked.join(F.broadcast(chunks), "grp").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop("_chunks")
    right = chunked.join(F.broadcast(blocks), "grp").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")

    def scan(questions: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        if not len(questions) or not len(members):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        base = np.stack(members["vector"].to_numpy())
        keys, ids = members["key"].to_numpy(), members["ids"].to_numpy()
        width = 1 + max(max(map(max, part["lists"])) for part in (questions, members))
        holds = _marked(members["lists"], width)
        size = (base * base).sum(1).max()
        out = []
        for i in range(0, len(questions), 128):
            part = questions.iloc[i:i + 128]
            asked_of = np.stack(part["vector"].to_numpy())
            squares = _squares(asked_of, base)
            squares[_marked(part["lists"], width) @ holds.T == 0] = np.inf
            for query, vector, near in zip(part["query_id"], asked_of, squares, strict=True):
                last = np.partition(near, n)[n] if len(near) > n else np.inf
                # the quick distances are off by rounding: exact ones for all that may be among them
                slack = 1e-10 * (size + (vector * vector).sum())
                at = np.flatnonzero((near <= last + slack) & (near < np.inf))
                distance = np.sqrt(((base[at] - vector) ** 2).sum(1))
                # an id among the n + 1 first has a vector whose smallest id is among them
                for j in np.lexsort((keys[at], distance))[:n + 1]:
                    out += [(query, v, distance[j]) for v in ids[at[j]] if v != query]
        frame = pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
        frame = frame.sort_values(["query_id", "score", "vec_id"])
        return frame.groupby("query_id").head(n)

    keys = ["grp", "chunk", "block"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        scan, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.distinct().withColumn("rank", rank).filter(F.col("rank") <= n).select(
        "query_id", "rank", "vec_id", "score")
