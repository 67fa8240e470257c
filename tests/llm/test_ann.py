import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from graphfeed.llm import ann as A


def brute(rows, n=10):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 8
            and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in good:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in good if i != q)
            out[q] = near[:n]
    return out


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(2)
    middles = random.standard_normal((30, 8)) * 3
    rows = [(i, (middles[i % 30] + random.standard_normal(8)).round(3).tolist()) for i in range(3000)]
    same = rows[0][1]
    rows += [(5000 + i, same) for i in range(1500)]  # one vector in a third of all rows
    return rows + [(7000, None), (7100, [0.0] * 8), (7200, [None] + [1.0] * 7), (7300, [float("nan")] * 8),
                   (7400, [float("inf")] + [1.0] * 7), (None, same), (7500, [1.0] * 3), (7600, [])]


def search(spark, rows, **how):
    df = spark.createDataFrame([(i, v, "c", 0) for i, v in rows],
                               "vec_id long, embedding array<double>, ids string, list int")
    found = {}
    for r in A.nearest(df, F.col("vec_id") % 100 == 0, **how).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.score, r.vec_id)
    return {q: [v[k] for k in sorted(v)] for q, v in found.items()}


def test_recall_scores_and_copies(spark, vectors):
    want, got = brute(vectors), search(spark, vectors)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    points = {i: np.array(v) for i, v in vectors if i in got or i is not None and v}
    for q, near in got.items():
        assert near == sorted(near) and q not in {i for _, i in near}
        for score, i in near:
            assert score == pytest.approx(np.sqrt(((points[q] - points[i]) ** 2).sum()), abs=1e-12)
    assert got[0] == want[0] and got[5000] == want[5000]  # ties go to the smaller id


def test_few_candidates_are_all_found(spark):
    rows = [(i, [float(i + 1)] + [0.5] * 7) for i in range(99, 104)] * 2
    got = search(spark, rows)
    assert [i for _, i in got[100]] == [i for _, i in brute(rows[:5])[100]]
    assert search(spark, [(100, [1.0] * 8)]) == {} and search(spark, [(1, None)]) == {}


def test_chunks_and_blocks_change_nothing(spark, vectors, monkeypatch):
    want = search(spark, vectors[:1500])
    monkeypatch.setattr(A, "CHUNK", 20)
    monkeypatch.setattr(A, "BLOCK", 2)
    assert search(spark, vectors[:1500]) == want


def test_graph_search_finds_the_nearest():
    random = np.random.default_rng(1)
    points, queries = random.standard_normal((400, 6)), random.standard_normal((50, 6))
    found, dist = A.graph_search(queries, points, A.neighbour_graph(points), 40)
    for q, f, d in zip(queries, found, dist, strict=True):
        assert len(set(f)) == 40 and (np.diff(d) >= 0).all()
        near = np.argsort(((points - q) ** 2).sum(1))[:10]
        assert len(set(near) & set(f)) >= 9


@pytest.mark.parametrize("clusters", [None, 40])
def test_recall_with_many_lists(spark, tmp_path, clusters):
    """64 dimensions, hundreds of lists, with and without clusters."""
    random = np.random.default_rng(5)
    x = random.standard_normal((20_000, 64))
    if clusters:
        x += 2 * random.standard_normal((clusters, 64))[random.integers(0, clusters, len(x))]
    rows = pa.table({"vec_id": np.arange(len(x)), "embedding": list(x)})
    pq.write_table(rows, tmp_path / "v.parquet", row_group_size=4000)
    got = {}
    for r in A.nearest(spark.read.parquet(str(tmp_path / "v.parquet")), F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, len(x), 100):
        distance = ((x - x[q]) ** 2).sum(1)
        distance[q] = np.inf
        hits += len(got[q] & set(np.argsort(distance)[:10].tolist()))
    assert len(got) == 200 and hits >= 0.93 * 10 * len(got)


def test_groups_hold_every_list_once():
    points = np.random.default_rng(3).standard_normal((1000, 5))
    group = A.grouped(points, 64)
    assert np.bincount(group).max() <= 64 and np.bincount(group).min() > 0
    assert A.grouped(np.zeros((200, 3)), 64).max() >= 3
