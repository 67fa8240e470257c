"""Moving in cells against the steps that write every contribution out."""

import random

import numpy as np
import pytest

from graphfeed.lineage import stored
from graphfeed.operators import cells
from graphfeed.operators import edges as E
from graphfeed.operators import ranking as R


@pytest.fixture(scope="module")
def circle(spark):
    """Users with friends close by, two categories that all of them share, and likes."""
    draw = random.Random(7)
    users = range(60)
    pairs = {(f"u{a}", f"u{(a + draw.randrange(1, 9)) % 60}") for a in users for _ in range(4)}
    interests = [(f"u{a}", f"c{a % 2}") for a in users] + [(f"u{a}", "c0") for a in range(1, 60, 6)]
    edges = E.all_edges(
        E.article_category_edges(spark.createDataFrame(
            [(i, f"c{i % 2}") for i in range(30)], "id long, category string")),
        E.interest_edges(spark.createDataFrame(interests, "usr string, category string")),
        E.like_edges(spark.createDataFrame(
            sorted({(f"u{a}", draw.randrange(30)) for a in users for _ in range(2)}),
            "usr string, article_id long")),
        E.friend_edges(spark.createDataFrame(
            sorted(pairs | {(b, a) for a, b in pairs}), "src string, dst string")))
    seeds = E.seeds(spark.createDataFrame(interests, "usr string, category string"))
    return stored(E.weighted_edges(edges), "weights"), stored(seeds, "seeds")


def by_steps(weights, seeds, limit, passes):
    ranks = seeds
    for _ in range(passes):
        step = R.normalise_by_label(R.sum_labels(R.propagate(weights, ranks)))
        ranks = stored(R.prune(R.reseed(R.drop_self(step), seeds), limit), "steps")
    return {(r.node_type + r.node, r.label): r.value for r in ranks.collect()}


# one cell; many; many, with the categories' own edges as rows, as a cell cannot hold them
@pytest.mark.parametrize("cell_edges, cell_rows", [(10**6, 10**6), (100, 500), (30, 500)])
@pytest.mark.parametrize("limit", [0.002, 0.01])
def test_cells_of_any_size(circle, monkeypatch, cell_edges, cell_rows, limit):
    weights, seeds = circle
    monkeypatch.setattr(cells, "CELL_ROWS", cell_rows)
    graph = R._number_nodes(weights, seeds, 20, 10, cell_edges)
    assert (graph.crowded is not None) == (cell_edges == 30)
    assert (graph.blocks > 1) == (cell_edges < 10**6)
    ranks, _ = R.run_passes(weights, seeds, R.Variant(limit, 0.001, False), 3, wide=20, block_edges=10,
                            cell_edges=cell_edges)
    assert {(r.node_type + r.node, r.label): r.value for r in ranks.collect()} == pytest.approx(
        by_steps(weights, seeds, limit, 3))


def test_only_rows_that_stay_leave_a_cell(circle):
    """No contribution is a row: nothing is joined with an edge and no sum is shuffled."""
    weights, seeds = circle
    graph = R._number_nodes(weights, seeds, 20, 10)
    ranks = stored(R._scaled(R._one_pass(graph.seeds, graph, R.CLUSTER), graph), "scaled")
    limit = 0.05  # more than light edges alone can add
    moved = R._moved(ranks, graph, limit)
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "SortMergeJoin" not in plan, plan
    values = [r.value for r in moved.collect()]
    assert values and min(values) > limit


def test_few_nodes_are_summed_as_many():
    draw = np.random.default_rng(3)
    nodes, values = draw.integers(0, 50, 200).astype("<i4"), draw.random(200)
    dense, sparse = (cells._sums(nodes, values, n, 1.5) for n in (50, 10**6))
    assert dense[0].tolist() == sparse[0].tolist() and 0 < len(dense[0]) < 50
    assert dense[1] == pytest.approx(sparse[1])
    assert [len(a) for a in cells._sums(nodes[:0], values[:0], 50, 0.0)] == [0, 0]
