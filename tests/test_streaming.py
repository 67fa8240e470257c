"""Streams over several files and batches end where the batch jobs end."""

import pytest
from pyspark.sql import functions as F

from graphfeed.operators import changelog, feeds, social
from graphfeed.streaming import jobs
from graphfeed.streaming.tables import KeyedTable


@pytest.fixture(scope="module")
def event_files(tables, tmp_path_factory):
    """The event log as eight files in no order of time."""
    folder = tmp_path_factory.mktemp("stream")
    tables.raw("events").repartition(8, F.xxhash64("event_id")).write.parquet(
        str(folder / "events.parquet"))
    return str(folder)


def stream(spark, event_files):
    return jobs.table_stream(spark, event_files, "events", files_per_batch=2)


def test_like_counts(spark, tables, event_files):
    live = jobs.count_likes(tables.shape_like_log(
        tables.shape_events(stream(spark, event_files))))
    batch = feeds.like_counts(tables.like_log())
    assert sorted(live.collect()) == sorted(batch.collect())


def test_presence(spark, tables, event_files):
    live = jobs.follow_presence(tables.shape_presence(
        tables.shape_events(stream(spark, event_files))))
    batch = social.presence_now(tables.presence_log())
    assert sorted(map(str, live.collect())) == sorted(map(str, batch.collect()))


def test_changes(spark, tables, event_files):
    live = jobs.apply_changes(tables.shape_post_log(
        tables.shape_events(stream(spark, event_files))))
    batch = changelog.fold_edits(tables.post_log(), "post_id")
    columns = ["post_id", "op_ts", "op", "text"]
    assert sorted(live.select(columns).collect()) == sorted(batch.select(columns).collect())


def test_a_hot_chat_is_spread(spark, tmp_path):
    talk = [("hot", i, f"u{i % 9}") for i in range(300)] + [("calm", i, "u1") for i in range(5)] + [
        ("empty", 1, "u1")]
    rows = spark.createDataFrame(talk, "chat_id string, turn long, sender string")
    rows.repartition(3).write.parquet(str(tmp_path / "talk"))
    membership = spark.createDataFrame(
        [("hot", f"u{i}") for i in range(7)] + [("calm", "u1"), ("calm", "u2")], "chat_id string, member string")
    opened = spark.createDataFrame([("hot", f"u{i}") for i in range(2, 9)] + [("calm", "u2"), ("empty", "u1")],
                                   "chat_id string, usr string")
    inside, viewing = set(map(tuple, membership.collect())), set(map(tuple, opened.collect()))
    want = sorted((c, t, s, r, (c, s) in inside) for c, t, s in talk for chat, r in inside & viewing if chat == c)
    live = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "talk"))
    got = jobs.deliver(live, membership, opened, hot_rows=50)
    assert sorted(map(tuple, got.collect())) == want
    # as one table: no task of the join holds most of the hot chat
    recipients = jobs.recipients_of(membership, opened)
    readers = recipients.groupBy("chat_id").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = jobs.delivered_messages(rows, membership, recipients, readers, hot_rows=50)
        tasks = spread.groupBy(F.spark_partition_id()).count().collect()
        assert max(r[1] for r in tasks) < 0.6 * len(want) and sorted(map(tuple, spread.collect())) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_repeated_batch_counts_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k long, n long", ["k"], ["n"])
    first = spark.createDataFrame([(1, 1), (2, 1)], table.schema)
    second = spark.createDataFrame([(2, 2), (3, 1)], table.schema)
    table.merge(first, 0)
    table.merge(second, 1)
    table.merge(second, 1)
    assert sorted(map(tuple, table.read().collect())) == [(1, 1), (2, 2), (3, 1)]


def test_many_batches_leave_few_runs(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k long, n long", ["k"], ["n"], fan=3)
    want = {}
    for i in range(30):
        rows = [(i % 7, i), (i % 4, i)]
        want |= dict(rows)
        table.merge(spark.createDataFrame(rows, table.schema).coalesce(1), i)
        # read while the runs just merged are still there
        if i % 9 == 8:
            assert dict(map(tuple, table.read().collect())) == want
    assert sum(map(len, table.runs())) <= 3 * 4
    # an old batch comes again, to a writer that knows nothing of the one before
    again = KeyedTable(spark, table.path, table.schema, ["k"], ["n"], fan=3)
    again.merge(spark.createDataFrame([(1, 8), (0, 8)], table.schema), 8)
    assert dict(map(tuple, again.read().collect())) == want
    assert KeyedTable(spark, str(tmp_path / "none"), table.schema, ["k"], ["n"]).read().count() == 0
