"""Operators give the same rows whether groups are cut into pieces or not."""

import random

import pytest
from pyspark.sql import functions as F

from graphfeed.operators import feeds, skew


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(60)}"
        out.append((key, rng.randrange(50), i, rng.randrange(5)))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, ts long, id long, v long").repartition(5)


def brute_positions(rows):
    groups = {}
    for key, ts, i, _ in rows:
        groups.setdefault(key, []).append((-ts, i))
    return {i: n for g in groups.values() for n, (_, i) in enumerate(sorted(g), 1)}


@pytest.mark.parametrize("hot_rows", [None, 100, 30])
def test_number_within(frame, rows, hot_rows):
    order = [F.col("ts").desc(), F.col("id").asc()]
    got = skew.number_within(frame, ["key"], order, hot_rows=hot_rows).collect()
    assert {r.id: r.position for r in got} == brute_positions(rows)


def test_number_whole_table(frame, rows):
    got = skew.number_within(frame, [], [F.col("ts").asc(), F.col("id").asc()]).collect()
    want = {i: n for n, (_, i) in enumerate(sorted((r[1], r[2]) for r in rows), 1)}
    assert {r.id: r.position for r in got} == want


def test_sums_before(frame, rows):
    """Sums of all rows before, over many ranges in two levels."""
    got = skew.sums_before(frame, [F.col("ts").desc(), F.col("id")], "v", "before").collect()
    want, so_far = {}, 0
    for _, _, i, v in sorted(rows, key=lambda r: (-r[1], r[2])):
        want[i], so_far = so_far, so_far + v
    assert {r.id: r.before for r in got} == want
    parts = frame.select(F.col("id").alias("_part"), F.col("v").alias("_n"))
    got = skew._sums_before(parts, fan=50).collect()
    assert {r._part: r._before for r in got} == {
        i: sum(r[3] for r in rows[:i]) for i in range(len(rows))}


def test_dense_index_of_sparse_ids(spark):
    """Every id in a block of its own; no window without partitions in the plan."""
    ids = [(i * 7919 % 1009) * (1 << 40) for i in range(500)]
    got = skew.dense_index(spark.createDataFrame([(i,) for i in ids], "id long"), "id")
    assert {r.id: r.rn for r in got.collect()} == {i: n for n, i in enumerate(sorted(ids))}
    windows = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines()
               if "Window [" in line]
    assert windows and all("_group" in w or "_part" in w or "_block" in w for w in windows)


@pytest.mark.parametrize("hot_rows", [None, 100])
def test_previous_within(frame, rows, hot_rows):
    order = [F.col("ts").asc(), F.col("id").asc()]
    got = skew.previous_within(frame, ["key"], order, "id", hot_rows=hot_rows).collect()
    want, last = {}, {}
    for key, _, i, _ in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        want[i] = last.get(key)
        last[key] = i
    assert {r.id: r.previous for r in got} == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, frame, how):
    small = spark.createDataFrame(
        [("hot", "a"), ("hot", "b"), ("k1", "c"), ("k2", "d"), ("absent", "e")],
        "key string, w string",
    )
    plain = frame.join(small, ["key"], how)
    cut = skew.skew_join(frame, small, ["key"], how, hot_rows=50)
    assert cut.columns == plain.columns
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))


def test_skew_join_splits_the_hot_key(frame):
    sizes = frame.groupBy("key").agg(F.count("*").alias("n"))
    hot = {r.key: r._pieces for r in skew.hot_keys(sizes, ["key"], 200).collect()}
    assert list(hot) == ["hot"] and hot["hot"] >= 5


@pytest.mark.parametrize("bits", [3, 20])
def test_dense_index(spark, bits):
    ids = random.Random(1).sample(range(5000), 700)
    frame = spark.createDataFrame([(i,) for i in ids], "id long").repartition(3)
    got = {r.id: r.rn for r in skew.dense_index(frame, "id", bits=bits).collect()}
    assert got == {i: n for n, i in enumerate(sorted(ids))}


def test_newest(frame, rows):
    got = {r.key: r.id for r in skew.newest(frame, ["key"], ["ts", "id"]).collect()}
    want = {}
    for key, ts, i, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        want[key] = i
    assert got == want


def test_feeds_with_cut_groups(tables):
    posts, friends, comments = tables.posts(), tables.friends(), tables.comments()
    plain = feeds.home_feed(posts, friends, comments).select("reader", "position", "post_id")
    cut = feeds.home_feed(posts, friends, comments, hot_rows=20).select(
        "reader", "position", "post_id"
    )
    assert sorted(plain.collect()) == sorted(cut.collect())
    plain = feeds.attach_comments(posts, comments)
    cut = feeds.attach_comments(posts, comments, hot_rows=2)
    key = ["post_id", "comment_position", "comment_id"]
    assert sorted(map(str, plain.select(key).collect())) == sorted(
        map(str, cut.select(key).collect())
    )


def test_top_k_is_cut_before_the_shuffle(tables):
    feed = feeds.home_feed(tables.posts(), tables.friends(), tables.comments(), n=5)
    plan = feed._jdf.queryExecution().executedPlan().toString()
    # before and after the shuffle, for the newest posts of an author and of a reader
    assert plan.count("WindowGroupLimit") == 4
