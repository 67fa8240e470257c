"""The logical views (users, friends, posts, ...) over the input tables.

The input is a star schema with an event log, a document set and conversations. Each view
below is a projection of one of them, so its size grows with the table it comes from. Times
are whole microseconds since the epoch.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphfeed.operators.skew import dense_index

_EPOCH_MICROS = (
    "cast(cast(ts - timestamp_ntz'1970-01-01 00:00:00' as interval second)"
    " as decimal(20,6)) * 1000000"
)


def text_id(column) -> F.Column:
    """User ids are text, as they are user names in a social network."""
    return (F.col(column) if isinstance(column, str) else column).cast("string")


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- table sizes used as moduli by the views; each is one number -----------------

    @cached_property
    def n_users(self) -> int:
        return self.raw("events").agg(F.countDistinct("user_id")).first()[0]

    @cached_property
    def n_docs(self) -> int:
        return self.raw("documents").count()

    @cached_property
    def n_sources(self) -> int:
        return self.raw("documents").agg(F.countDistinct("source")).first()[0]

    @cached_property
    def n_posts(self) -> int:
        return self.events("purchase").count()

    @cached_property
    def n_chats(self) -> int:
        return self.raw("conversations").agg(F.countDistinct("conv_id")).first()[0]

    # -- views -----------------------------------------------------------------------

    def shape_events(self, events: DataFrame) -> DataFrame:
        """Also used on the streaming copy of the event log."""
        return events.select(
            "event_id",
            F.expr(_EPOCH_MICROS).cast("long").alias("ts"),
            "user_id",
            "event_type",
            "value",
            F.get_json_object("props", "$.k").cast("long").alias("k"),
        )

    def events(self, *types: str) -> DataFrame:
        events = self.raw("events")
        if types:
            events = events.filter(F.col("event_type").isin(*types))
        return self.shape_events(events)

    def news(self) -> DataFrame:
        return self.raw("documents").select(
            F.col("doc_id").alias("id"),
            F.lower("source").alias("category"),
            F.substring_index("text", "\n", 1).alias("headline"),
            F.concat(F.lit("author"), (F.col("doc_id") % 50).cast("string")).alias("authors"),
            F.concat(F.lit("http://example.com/"), F.col("doc_id").cast("string")).alias("link"),
            F.col("text").alias("description"),
            F.date_add(F.lit("2017-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
            .cast("string").alias("date"),
        )

    def users(self) -> DataFrame:
        return self.raw("events").select(text_id("user_id").alias("id")).distinct()

    def interests(self) -> DataFrame:
        """One row per user and interest."""
        return (
            self.events("signup")
            .select(
                text_id("user_id").alias("usr"),
                F.concat(F.lit("src"), (F.col("k") % self.n_sources).cast("string"))
                .alias("category"),
            )
            .distinct()
        )

    def likes(self) -> DataFrame:
        article = (F.col("user_id") * 31 + F.col("k") * 7) % self.n_docs
        return (
            self.events("click")
            .select(text_id("user_id").alias("usr"), article.alias("article_id"))
            .distinct()
        )

    def friend_pairs(self) -> DataFrame:
        """One direction of each friendship as it was accepted."""
        other = (F.col("user_id") + F.col("k")) % self.n_users
        return (
            self.events("view")
            .select(text_id("user_id").alias("src"), text_id(other).alias("dst"), "ts")
            .filter(F.col("src") != F.col("dst"))
        )

    def friends(self) -> DataFrame:
        back = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
        both = F.explode(F.array(F.struct("src", "dst"), back)).alias("_pair")
        pairs = self.friend_pairs().select(both, "ts").select("_pair.*", "ts")
        return pairs.groupBy("src", "dst").agg(F.min("ts").alias("ts"))

    def opened(self) -> DataFrame:
        """(viewer, friend) rows: nodes opened in the graph view, from clicks."""
        other = (F.col("user_id") + F.col("k")) % self.n_users
        return (
            self.events("click")
            .select(text_id("user_id").alias("viewer"), text_id(other).alias("friend"))
            .distinct()
        )

    def signup_forms(self) -> DataFrame:
        k, usr = F.col("k"), text_id("user_id")
        tag = [F.concat(F.lit("src"), ((k + i) % self.n_sources).cast("string")) for i in (0, 1)]
        return self.events("signup").select(
            F.col("event_id").alias("form_id"),
            F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("user"), usr)).alias("username"),
            F.when(k % 13 != 0, F.concat(F.lit("pw"), k.cast("string"))).alias("password"),
            F.concat(F.lit("first"), usr).alias("firstname"),
            F.concat(F.lit("last"), usr).alias("surname"),
            F.when(k % 5 == 0, "").otherwise(F.concat(usr, F.lit("@x.org"))).alias("email"),
            (k % 28 + 1).cast("string").alias("day"),
            (k % 12 + 1).cast("string").alias("month"),
            F.when(k % 17 != 0, F.lit("1990")).alias("year"),
            F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("aff"), usr)).alias("affiliation"),
            F.when(k % 3 == 0, F.array(tag[0])).when(k % 3 == 1, F.array(*tag))
            .alias("interests"),
        )

    def update_forms(self) -> DataFrame:
        k, usr = F.col("k"), text_id("user_id")
        return self.events("view").select(
            F.col("event_id").alias("form_id"),
            usr.alias("username"),
            F.when(k % 10 == 0, "").otherwise(F.concat(usr, F.lit("@x.org"))).alias("email"),
            F.when(k % 9 != 0, F.concat(F.lit("aff"), usr)).alias("affiliation"),
            F.when(k % 4 < 2, "old").otherwise("").alias("old_password"),
            F.when(k % 4 % 2 == 0, "new").otherwise("").alias("new_password"),
            F.when(k % 3 == 1, F.array(F.lit("src1")))
            .when(k % 3 == 2, F.array(F.lit("src1"), F.lit("src2"))).alias("interests"),
        )

    def search_queries(self) -> DataFrame:
        """What users write in conversations, as search texts."""
        return (
            self.raw("conversations")
            .filter(F.col("role") == "user")
            .select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text")
        )

    def chat_attempts(self) -> DataFrame:
        """(op_id, usr, friend): attempts to open a private chat, from clicks."""
        other = (F.col("user_id") + F.col("k")) % self.n_users
        return self.events("click").select(
            F.col("event_id").alias("op_id"),
            text_id("user_id").alias("usr"),
            text_id(other).alias("friend"),
        )

    def leavers(self) -> DataFrame:
        """(chat_id, member) rows of users who leave a chat, from errors."""
        return self.events("error").select(
            (F.col("k") % self.n_chats).alias("chat_id"), text_id("user_id").alias("member")
        ).distinct()

    def open_chats(self) -> DataFrame:
        """(usr, chat_id): the chat each user has open, from the last view."""
        return (
            self.events("view")
            .groupBy(text_id("user_id").alias("usr"))
            .agg(F.max_by(F.col("k") % self.n_chats, F.struct("ts", "event_id")).alias("chat_id"))
        )

    def shape_live_messages(self, conversations: DataFrame) -> DataFrame:
        """(chat_id, turn, sender, text); some senders are not members."""
        sender = (F.col("conv_id") % 10 + F.col("turn") * 2) % self.n_users
        return conversations.select(
            F.col("conv_id").alias("chat_id"), "turn", text_id(sender).alias("sender"), "text"
        )

    def new_messages(self) -> DataFrame:
        """(chat_id, sender, op_id, text) from clicks; some senders are not members."""
        chat = F.col("k") % self.n_chats
        sender = (chat % 10 + F.col("event_id") % 8) % self.n_users
        return self.events("click").select(
            chat.alias("chat_id"),
            text_id(sender).alias("sender"),
            F.col("event_id").alias("op_id"),
            F.concat(F.lit("message "), F.col("event_id").cast("string")).alias("text"),
        )

    def search_terms(self) -> DataFrame:
        """Search texts for user ids: the distinct whole parts of event values."""
        return self.raw("events").select(
            F.floor("value").cast("long").cast("string").alias("term")
        ).distinct()

    def requests(self) -> DataFrame:
        target = (F.col("user_id") + F.col("k") * 3 + 1) % self.n_users
        return (
            self.events("view")
            .filter(F.col("k") % 5 == 0)
            .select(text_id("user_id").alias("src"), text_id(target).alias("dst"), "ts")
            .filter(F.col("src") != F.col("dst"))
            .groupBy("src", "dst")
            .agg(F.max("ts").alias("ts"))
        )

    def posts(self) -> DataFrame:
        wall = (F.col("user_id") + F.col("k")) % self.n_users
        tags = F.array(
            F.concat(F.lit("tag"), (F.col("k") % 10).cast("string")),
            F.concat(F.lit("tag"), (F.col("k") % 7).cast("string")),
        )
        return self.events("purchase").select(
            F.col("event_id").alias("post_id"),
            text_id("user_id").alias("author"),
            "ts",
            F.when(F.col("k") % 2 == 0, text_id(wall)).alias("wall"),
            F.floor("value").cast("long").alias("likes"),
            F.array_distinct(tags).alias("hashtags"),
        )

    def posts_with_text(self) -> DataFrame:
        headlines = self.news().select(F.col("id").alias("_doc"), F.col("headline").alias("text"))
        posts = self.posts().withColumn("_doc", F.col("post_id") % self.n_docs)
        return posts.join(headlines, ["_doc"]).drop("_doc")

    def numbered_posts(self) -> DataFrame:
        """(post_id, rn): posts counted from 0 by id, the target of comments and likes."""
        ids = self.events("purchase").select(F.col("event_id").alias("post_id"))
        return dense_index(ids, "post_id", "rn")

    def _at_post(self, events: DataFrame, rn: F.Column) -> DataFrame:
        """Events with the post they are about; one post may get very many."""
        return events.withColumn("rn", rn % self.n_posts).join(self.numbered_posts(), ["rn"])

    def _at_comment(self, events: DataFrame, rn: F.Column) -> DataFrame:
        ids = self.events("error").select(F.col("event_id").alias("comment_id"))
        placed = events.withColumn("rn", rn % ids.count())
        return placed.join(dense_index(ids, "comment_id", "rn"), ["rn"])

    def comments(self) -> DataFrame:
        """Comment text is 'c' and the id; likes follow from the id."""
        placed = self._at_post(self.events("error"), F.col("event_id") * 17 + F.col("k"))
        return placed.select(
            F.col("event_id").alias("comment_id"),
            "post_id",
            text_id("user_id").alias("commenter"),
            "ts",
            F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("text"),
            F.floor("value").cast("long").alias("likes"),
        )

    def shape_presence(self, events: DataFrame) -> DataFrame:
        online = F.col("k") % 2 == 0
        return events.filter(F.col("event_type").isin("signup", "error")).select(
            text_id("user_id").alias("id"),
            "ts",
            F.col("event_id").alias("op_id"),
            online.alias("is_online"),
            F.when(~online, F.col("ts")).alias("last_seen"),
        )

    def presence_log(self) -> DataFrame:
        return self.shape_presence(self.events("signup", "error"))

    def shape_like_log(self, events: DataFrame) -> DataFrame:
        clicks = events.filter(F.col("event_type") == "click")
        placed = self._at_post(clicks, F.col("event_id") * 13 + F.col("k"))
        return placed.select("post_id", F.col("event_id").alias("op_id"), "ts")

    def like_log(self) -> DataFrame:
        return self.shape_like_log(self.events("click"))

    def comment_like_log(self) -> DataFrame:
        """Each click also likes the comment with the same position among comments."""
        placed = self._at_comment(self.events("click"), F.col("event_id") * 13 + F.col("k"))
        return placed.select("comment_id", F.col("event_id").alias("op_id"), "ts")

    def shape_post_log(self, events: DataFrame) -> DataFrame:
        """(post_id, op_ts, op_id, op, text): create, edit and delete."""
        kind = F.col("event_type")
        changes = events.filter((kind == "view") | ((kind == "error") & (F.col("k") < 10)))
        creates = events.filter(kind == "purchase").select(
            F.col("event_id").alias("post_id"),
            F.col("ts").alias("op_ts"),
            F.col("event_id").alias("op_id"),
            F.lit("create").alias("op"),
            F.concat(F.lit("post "), F.col("event_id").cast("string")).alias("text"),
        )
        later = self._at_post(changes, F.col("event_id")).select(
            "post_id",
            F.col("ts").alias("op_ts"),
            F.col("event_id").alias("op_id"),
            F.when(kind == "view", "edit").otherwise("delete").alias("op"),
            F.when(kind == "view", F.concat(F.lit("edit "), F.col("event_id").cast("string")))
            .alias("text"),
        )
        return creates.unionByName(later)

    def post_log(self) -> DataFrame:
        return self.shape_post_log(self.events("purchase", "view", "error"))

    def comment_log(self) -> DataFrame:
        """The same for comments: errors create, signups edit, clicks with k < 10 delete."""
        kind = F.col("event_type")
        creates = self.events("error").select(
            F.col("event_id").alias("comment_id"),
            F.col("ts").alias("op_ts"),
            F.col("event_id").alias("op_id"),
            F.lit("create").alias("op"),
            F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("text"),
        )
        changes = self.events("signup", "click").filter((kind == "signup") | (F.col("k") < 10))
        later = self._at_comment(changes, F.col("event_id")).select(
            "comment_id",
            F.col("ts").alias("op_ts"),
            F.col("event_id").alias("op_id"),
            F.when(kind == "signup", "edit").otherwise("delete").alias("op"),
            F.when(kind == "signup", F.concat(F.lit("edit "), F.col("event_id").cast("string")))
            .alias("text"),
        )
        return creates.unionByName(later)

    def profile_log(self) -> DataFrame:
        k = F.col("k")
        return self.events("signup").select(
            text_id("user_id").alias("id"),
            F.col("ts").alias("op_ts"),
            F.col("event_id").alias("op_id"),
            F.when(k % 5 != 0, F.concat(F.lit("u"), text_id("user_id"), F.lit("@"),
                                        (k % 3).cast("string"), F.lit(".org"))).alias("email"),
            F.when(k % 3 != 0, F.concat(F.lit("aff"), (k % 4).cast("string")))
            .alias("affiliation"),
            F.when(k % 4 == 0, F.concat(F.lit("pw"), k.cast("string"))).alias("password"),
            F.when(k % 7 == 0, F.concat(F.lit("src"), (k % self.n_sources).cast("string")))
            .alias("interest"),
        )

    def membership(self) -> DataFrame:
        """One row per chat and member."""
        member = (F.col("conv_id") % 10 + F.col("turn")) % self.n_users
        return (
            self.raw("conversations")
            .select(F.col("conv_id").alias("chat_id"), text_id(member).alias("member"))
            .distinct()
        )

    def messages(self) -> DataFrame:
        return self.raw("conversations").select(
            F.col("conv_id").alias("chat_id"), "turn", "role", "text"
        )

    def invites(self) -> DataFrame:
        """Private invites have no chat."""
        k = F.col("k")
        inviter = (F.col("user_id") + k + 1) % self.n_users
        return (
            self.events("click")
            .filter(k < 20)
            .select(
                text_id("user_id").alias("invitee"),
                text_id(inviter).alias("inviter"),
                F.when(k < 10, k % self.n_chats).alias("chat_id"),
            )
            .filter(F.col("invitee") != F.col("inviter"))
            .distinct()
        )
