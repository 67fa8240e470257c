"""The live parts: message delivery, like counters, presence and keyed changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from graphfeed.lineage import scratch_path, stored
from graphfeed.operators.skew import HOT_ROWS, skew_join
from graphfeed.streaming.tables import KeyedTable


# Files a micro-batch takes at most, so that a backlog is worked off in pieces.
FILES_PER_BATCH = 64


def table_stream(
    spark: SparkSession, sf_dir: str, name: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """The files of an input table as a stream; a table is one file or a folder of them."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet")


def drain(writer: DataStreamWriter, name: str, spark: SparkSession) -> None:
    """Run over everything that is there and stop."""
    query = (
        writer.trigger(availableNow=True)
        .option("checkpointLocation", scratch_path(spark, f"{name}-progress"))
        .start()
    )
    query.awaitTermination()


# -- S1 ---------------------------------------------------------------------------------


def recipients_of(membership: DataFrame, open_chats: DataFrame) -> DataFrame:
    """(chat_id, recipient): the members who have the chat open."""
    inside = membership.withColumnRenamed("member", "recipient")
    return open_chats.withColumnRenamed("usr", "recipient").join(
        inside, ["chat_id", "recipient"], "left_semi")


def delivered_messages(
    messages: DataFrame,
    membership: DataFrame,
    recipients: DataFrame,
    readers: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """A message goes to each member who has its chat open; it is stored only if the sender
    is a member.

    ``readers`` has the number of recipients per chat (chat_id, n). The messages of a chat that would
    give more than ``hot_rows`` rows are dealt to several tasks; the size of each chat is known before
    any message meets its recipients. ``messages`` is a table or a micro-batch.
    """
    senders = membership.select("chat_id", F.col("member").alias("sender"),
                                F.lit(True).alias("is_stored"))
    # judged once per message, not once per recipient
    judged = messages.join(senders, ["chat_id", "sender"], "left").select(
        "chat_id", "turn", "sender", F.coalesce("is_stored", F.lit(False)).alias("is_stored"))
    sizes = (
        messages.groupBy("chat_id").agg(F.count(F.lit(1)).alias("_messages"))
        .join(readers, ["chat_id"])
        .select("chat_id", (F.col("_messages") * F.col("n")).alias("n"))
    )
    reached = skew_join(judged, recipients, ["chat_id"], hot_rows=hot_rows, sizes=sizes)
    return reached.select("chat_id", "turn", "sender", "recipient", "is_stored")


def deliver(
    messages: DataFrame, membership: DataFrame, open_chats: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The deliveries of a stream of messages, a folder per micro-batch: one that is repeated
    replaces its own."""
    spark = messages.sparkSession
    recipients = stored(recipients_of(membership, open_chats), "recipients")
    readers = stored(recipients.groupBy("chat_id").agg(F.count(F.lit(1)).alias("n")), "readers")
    path = scratch_path(spark, "delivered")
    types = dict(messages.dtypes) | dict(recipients.dtypes)
    schema = (f"chat_id {types['chat_id']}, turn {types['turn']}, sender {types['sender']}, "
              f"recipient {types['recipient']}, is_stored boolean")
    spark.createDataFrame([], schema).write.parquet(f"{path}/batch=-1")

    def send(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # sized, judged and sent
        delivered_messages(batch, membership, recipients, readers, hot_rows).write.mode(
            "overwrite").parquet(f"{path}/batch={batch_id}")
        batch.unpersist()

    drain(messages.writeStream.foreachBatch(send), "delivered", spark)
    return spark.read.schema(schema).parquet(path).drop("batch")


# -- S2, S3 -----------------------------------------------------------------------------


def count_likes(likes: DataFrame) -> DataFrame:
    """Running counters per post. Counters only grow, so the highest is the newest."""
    spark = likes.sparkSession
    table = KeyedTable(
        spark, scratch_path(spark, "like-counts"), "post_id long, n_likes long",
        ["post_id"], ["n_likes"],
    )
    counts = likes.groupBy("post_id").agg(F.count(F.lit(1)).alias("n_likes"))
    drain(counts.writeStream.outputMode("update").foreachBatch(table.merge), "like-counts", spark)
    return table.read()


def follow_presence(log: DataFrame) -> DataFrame:
    """Latest status per user; late rows never replace newer ones."""
    spark = log.sparkSession
    table = KeyedTable(
        spark, scratch_path(spark, "presence"),
        "id string, ts long, op_id long, is_online boolean, last_seen long",
        ["id"], ["ts", "op_id"],
    )
    latest = (
        log.groupBy("id")
        .agg(F.max_by(F.struct("ts", "op_id", "is_online", "last_seen"),
                      F.struct("ts", "op_id")).alias("_row"))
        .select("id", "_row.*")
    )
    drain(latest.writeStream.outputMode("update").foreachBatch(table.merge), "presence", spark)
    return table.read().select("id", "is_online", "last_seen")


# -- S4 ---------------------------------------------------------------------------------


def apply_changes(log: DataFrame) -> DataFrame:
    """Keyed puts and deletes as they arrive.

    A delete stays in the table as a mark, so that an older put coming later does not bring
    the row back; readers leave marks out.
    """
    spark = log.sparkSession
    table = KeyedTable(
        spark, scratch_path(spark, "changes"),
        "post_id long, op_ts long, op_id long, op string, text string",
        ["post_id"], ["op_ts", "op_id"],
    )
    drain(log.writeStream.foreachBatch(table.merge), "changes", spark)
    return table.read().filter(F.col("op") != "delete")
