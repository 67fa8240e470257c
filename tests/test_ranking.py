"""The ranking against hand-computed and brute-force passes."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from graphfeed.lineage import stored
from graphfeed.operators import edges as E
from graphfeed.operators import ranking as R
from graphfeed.operators import recommend


@pytest.fixture(scope="module")
def small(spark):
    """Two users and three articles in two categories."""
    news = spark.createDataFrame([(0, "X"), (1, "x"), (2, "y")], "id long, category string")
    interests = spark.createDataFrame([("p", "x"), ("p", "y"), ("q", "X")],
                                      "usr string, category string")
    likes = spark.createDataFrame([("p", 0), ("q", 2)], "usr string, article_id long")
    friends = spark.createDataFrame([("p", "q"), ("q", "p")], "src string, dst string")
    edges = E.all_edges(E.article_category_edges(news), E.interest_edges(interests),
                        E.like_edges(likes), E.friend_edges(friends))
    return edges, E.seeds(interests)


def weights_of(edges):
    return {(r.src_type + r.src, r.dst_type + r.dst): r.weight
            for r in E.weighted_edges(edges).collect()}


def test_weights_by_hand(small):
    w = weights_of(small[0])
    assert w[("up", "uq")] == pytest.approx(0.3)
    assert w[("up", "a0")] == pytest.approx(0.4)
    assert w[("up", "cx")] == pytest.approx(0.15)
    assert w[("uq", "cx")] == pytest.approx(0.3)
    assert w[("cx", "a0")] == pytest.approx(1 / 4)  # articles 0 and 1, users p and q
    assert w[("a0", "cx")] == w[("a0", "up")] == pytest.approx(1 / 2)
    assert w[("a1", "cx")] == pytest.approx(1.0)


def test_out_weights_sum_to_one(small):
    sums = E.weighted_edges(small[0]).filter("src_type <> 'u'").groupBy("src_type", "src").agg(
        F.sum("weight").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in sums)


def test_first_pass_by_hand(small):
    """From the seeds, label p: 0.3 to q, 0.4 to article 0, 0.15 to each category."""
    edges, seeds = small
    step = R.normalise_by_label(R.sum_labels(R.propagate(E.weighted_edges(edges), seeds)))
    got = {(r.node_type + r.node, r.label): r.value for r in step.collect()}
    assert got[("a0", "p")] == pytest.approx(0.4)
    assert got[("cx", "p")] == got[("cy", "p")] == pytest.approx(0.15)
    assert got[("cx", "q")] == got[("up", "q")] == pytest.approx(0.3)
    for label in "pq":
        assert sum(v for (_, l), v in got.items() if l == label) == pytest.approx(1.0)


def brute(edges, seeds, variant, passes):
    weights = weights_of(edges)
    start = {(r.node_type + r.node, r.label): r.value for r in seeds.collect()}
    ranks = dict(start)
    for _ in range(passes):
        moved = defaultdict(float)
        for (src, dst), w in weights.items():
            for (node, label), value in ranks.items():
                if node == src:
                    moved[(dst, label)] += value * w
        if variant.prune_first:
            moved = {k: v for k, v in moved.items() if v > variant.min_weight}
        totals = defaultdict(float)
        for (_, label), value in moved.items():
            totals[label] += value
        ranks = {k: v / totals[k[1]] for k, v in moved.items() if k[0] != "u" + k[1]}
        ranks.update(start)
        if not variant.prune_first:
            ranks = {k: v for k, v in ranks.items() if v > variant.min_weight}
    return ranks


VARIANTS = {
    "cluster": R.CLUSTER,
    "local": R.LOCAL,
    "cluster, high limit": R.Variant(0.08, 0.001, False),
    "local, high limit": R.Variant(0.08, 0.001, True),
}


@pytest.fixture(params=["10MB", "-1"], ids=["broadcast", "shuffled"])
def joins(spark, request):
    """Both plans that Catalyst may choose."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield
    spark.conf.set(name, old)


# all nodes wide, some, none
@pytest.mark.parametrize("wide", [1, 4, 256])
@pytest.mark.parametrize("variant", VARIANTS.values(), ids=VARIANTS)
def test_loop_matches_brute_force(small, variant, wide):
    edges, seeds = small
    ranks, _ = R.run_passes(E.weighted_edges(edges), seeds, variant, 3, wide=wide, block_edges=2)
    got = {(r.node_type + r.node, r.label): r.value for r in ranks.collect()}
    assert got == pytest.approx(brute(edges, seeds, variant, 3))


def by_steps(weights, seeds, limit, passes):
    ranks = seeds
    for _ in range(passes):
        step = R.normalise_by_label(R.sum_labels(R.propagate(weights, ranks)))
        ranks = stored(R.prune(R.reseed(R.drop_self(step), seeds), limit), "steps")
    return {(r.node_type + r.node, r.label): r.value for r in ranks.collect()}


# from limits that the wide nodes before most nodes can pass to one that none can
@pytest.mark.parametrize("limit", [0.0001, 0.02, 0.05])
def test_looking_wide_nodes_up_loses_nothing(tables, limit, joins):
    from graphfeed.plans.ranking import graph_weights

    weights = stored(graph_weights(tables), "weights")
    seeds = stored(E.seeds(tables.interests()), "seeds")
    want = by_steps(weights, seeds, limit, 2)
    ranks, _ = R.run_passes(weights, seeds, R.Variant(limit, 0.001, False), 2, wide=40, block_edges=4)
    got = {(r.node_type + r.node, r.label): r.value for r in ranks.collect()}
    assert got == pytest.approx(want)


def test_limit_between_the_reaches(tables):
    """Some pairs are moved to along light edges and others looked up."""
    from graphfeed.plans.ranking import graph_weights

    weights = stored(graph_weights(tables), "weights")
    seeds = stored(E.seeds(tables.interests()), "seeds")
    graph = R._number_nodes(weights, seeds, 40, 4)
    ranks = R._scaled(R._one_pass(graph.seeds, graph, R.CLUSTER), graph)
    bounds = R._wide_bounds(ranks.filter(R._is_wide("node")).join(graph.out_mass, "node"))
    counts = [r.n_wide for r in graph.n_wide.collect()]
    reaches = [min(b.one * n, b["all"]) for b in bounds.collect() for n in counts]
    limit = (min(reaches) + max(reaches)) / 2
    assert min(reaches) < limit < max(reaches)
    got, _ = R.run_passes(weights, seeds, R.Variant(limit, 0.001, False), 2, wide=40, block_edges=4)
    assert {(r.node_type + r.node, r.label): r.value for r in got.collect()} == pytest.approx(
        by_steps(weights, seeds, limit, 2))


@pytest.fixture(scope="module")
def hubs(spark):
    """A user with 400 friends and a category of 300 articles, next to small circles."""
    friends = [("hub", f"f{i}") for i in range(400)] + [(f"f{i}", f"f{i + 1}") for i in range(0, 400, 4)]
    friends = spark.createDataFrame(friends + [(b, a) for a, b in friends], "src string, dst string")
    news = spark.createDataFrame([(i, "big" if i < 300 else f"c{i % 9}") for i in range(340)],
                                 "id long, category string")
    interests = spark.createDataFrame(
        [("hub", "big")] + [(f"f{i}", "big" if i % 20 == 0 else f"c{i % 9}") for i in range(0, 400, 5)],
        "usr string, category string")
    likes = spark.createDataFrame([(f"f{i}", i * 7 % 340) for i in range(0, 400, 3)],
                                  "usr string, article_id long")
    edges = E.all_edges(E.article_category_edges(news), E.interest_edges(interests),
                        E.like_edges(likes), E.friend_edges(friends))
    return stored(E.weighted_edges(edges), "weights"), stored(E.seeds(interests), "seeds")


def test_two_hubs(hubs, joins):
    """The hubs' edges lie in blocks, and what they pass on in slivers is not moved."""
    weights, seeds = hubs
    limit = 0.01
    want = by_steps(weights, seeds, limit, 3)
    ranks, _ = R.run_passes(weights, seeds, R.Variant(limit, 0.001, False), 3, block_edges=50)
    assert {(r.node_type + r.node, r.label): r.value for r in ranks.collect()} == pytest.approx(want)

    graph = R._number_nodes(weights, seeds, R.WIDE, 50)
    wide = {r.name for r in graph.nodes.filter(R._is_wide("id")).collect()}
    assert wide == {"hub", "big"}
    blocks = graph.far.groupBy("src", "block").count().collect()
    assert len(blocks) >= 12 and max(r["count"] for r in blocks) < 100
    assert graph.near.groupBy("src").count().agg(F.max("count")).first()[0] < R.WIDE
    ranks = graph.seeds
    for _ in range(2):
        ranks = R._one_pass(ranks, graph, R.Variant(limit, 0.001, False))
    scaled = stored(R._scaled(ranks, graph), "scaled")
    edges = graph.near.unionByName(graph.far.drop("n_wide", "block"))
    every = scaled.join(edges.select(F.col("src").alias("node"), "dst"), "node").select("label", "dst").distinct()
    assert R._moved(scaled, graph, limit).count() < every.count() / 5


def test_bucketed_edges_are_not_moved(hubs, spark):
    weights, seeds = hubs
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        graph = R._number_nodes(weights, seeds, R.WIDE, 50)
        held = graph.seeds.withColumn("block", F.col("label").cast("int"))
        plans = [R._spread(graph.seeds, graph.near, ["src"]),
                 R._spread(held, graph.far, ["src", "block"])]
        plans = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # rows by label, rows by source, sums; the edges have no exchange of their own
    for plan in plans:
        assert plan.count("Exchange hashpartitioning") == 3, plan


def test_converges(tables):
    from graphfeed.plans.ranking import graph_weights

    _, history = R.run_passes(graph_weights(tables), E.seeds(tables.interests()))
    assert [number for number, _ in history] == [2, 3, 4]
    assert history[-1][1] <= R.CLUSTER.tolerance < history[-2][1]
    assert history[-1][1] == pytest.approx(0.000732, abs=1e-6)


def test_nothing_left_counts_as_converged(small):
    edges, seeds = small
    _, history = R.run_passes(E.weighted_edges(edges), seeds, R.Variant(0.99, 0.001, False))
    assert history == [(2, 0.0)]


def test_at_most_fifteen_and_known_articles_only(spark):
    ranks = spark.createDataFrame(
        [("u", a, float(a)) for a in range(40)], "label string, article_id long, article_rank double"
    )
    news = spark.createDataFrame([(a,) for a in range(0, 40, 2)], "id long")
    best = recommend.top_recs(ranks, news).orderBy("position").collect()
    assert [r.article_id for r in best] == list(range(38, 8, -2))
    low = recommend.top_recs(ranks, news, order="asc").orderBy("position").collect()
    assert [r.article_id for r in low] == list(range(0, 30, 2))


def test_shifted_date(spark):
    news = spark.createDataFrame([(1, "2017-12-24"), (2, "2018-12-24")], "id long, date string")
    assert [r.id for r in recommend.on_shifted_date(news, "2021-12-24").collect()] == [1]
