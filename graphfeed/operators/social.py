"""Users, friendships, requests and presence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphfeed.operators.skew import newest, number_within

# Letters of the longest parts by which user ids are looked up.
GRAM = 3


def lookup(users: DataFrame, wanted: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Profiles of the wanted ids; all columns or only ``cols``."""
    found = users.join(wanted.select("id").distinct(), ["id"], "left_semi")
    return found.select("id", *cols) if cols else found


def _grams(rows: DataFrame, column: str, sizes: Sequence[int]) -> DataFrame:
    """``column`` and its distinct substrings of the given sizes, as ``gram``."""
    cut = F.array(*[F.lit(size) for size in sizes])
    starts = F.when(F.length(column) >= F.col("_len"),
                    F.sequence(F.lit(1), F.length(column) - F.col("_len") + 1))
    return (
        rows.select(column, F.explode(cut).alias("_len"))
        .select(column, "_len", F.explode(starts).alias("_at"))
        .select(column, F.substring(column, F.col("_at"), F.col("_len")).alias("gram"))
        .distinct()
    )


def match_users(users: DataFrame, terms: DataFrame, n: int | None = None) -> DataFrame:
    """(term, id) for each user id that contains a term; empty terms match nothing.

    Ids are indexed by their substrings of up to ``GRAM`` letters. A term that short is one of
    these; a longer one is looked up by its rarest part, and the ids found are compared with it. With
    ``n`` the first ``n`` ids of each term are kept, and no list of a short term is longer
    from the start.
    """
    asked = terms.select("term").filter(F.length("term") > 0).distinct()
    short = asked.filter(F.length("term") <= GRAM).select("term", F.col("term").alias("gram"))
    long = asked.filter(F.length("term") > GRAM)
    index = _grams(users.select("id").distinct(), "id", range(1, GRAM + 1))
    parts = index.filter(F.length("gram") == GRAM)
    counts = parts.groupBy("gram").agg(F.count(F.lit(1)).alias("_ids"))
    # a part that no id has is the rarest
    rarest = (
        _grams(long, "term", [GRAM]).join(counts, ["gram"], "left")
        .groupBy("term")
        .agg(F.min_by("gram", F.struct(F.coalesce("_ids", F.lit(0)), "gram")).alias("gram"))
    )
    heads = index if n is None else _first(index, "gram", n)
    found = short.join(heads, ["gram"]).unionByName(
        rarest.join(parts, ["gram"]).filter(F.contains("id", "term"))
    ).select("term", "id")
    return found if n is None else _first(found, "term", n)


def _first(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` smallest ids per key; cut in every task before they are moved."""
    place = F.row_number().over(Window.partitionBy(key).orderBy("id"))
    return rows.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def presence_now(log: DataFrame) -> DataFrame:
    """Latest status per user: online, or the time last seen."""
    return newest(log, ["id"], ["ts", "op_id"]).select("id", "is_online", "last_seen")


def friends_with_presence(friends: DataFrame, presence: DataFrame) -> DataFrame:
    """Each friendship with the friend's status; unknown users keep null."""
    status = presence.select(F.col("id").alias("dst"), "is_online", "last_seen")
    return friends.join(status, ["dst"], "left")


def friends_of(friends: DataFrame, hot_rows: int | None = None) -> DataFrame:
    order = [F.col("ts").desc(), F.col("dst").asc()]
    return number_within(friends, ["src"], order, hot_rows=hot_rows)


def requests_of(
    requests: DataFrame, direction: str = "sent", hot_rows: int | None = None
) -> DataFrame:
    """Requests per sender, or per receiver with ``direction="received"``; newest first."""
    owner, other = ("src", "dst") if direction == "sent" else ("dst", "src")
    return number_within(
        requests, [owner], [F.col("ts").desc(), F.col(other).asc()], hot_rows=hot_rows
    )


def symmetric(pairs: DataFrame) -> DataFrame:
    """Both directions of each friendship, once; nobody is the own friend."""
    back = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
    both = F.explode(F.array(F.struct("src", "dst"), back)).alias("_pair")
    return (
        pairs.filter(F.col("src") != F.col("dst")).select(both).select("_pair.*").distinct()
    )


def remove_friends(friends: DataFrame, removals: DataFrame) -> DataFrame:
    """Removing deletes both directions."""
    return friends.join(symmetric(removals), ["src", "dst"], "left_anti")


def expand_friends(friends: DataFrame, opened: DataFrame) -> DataFrame:
    """The friend lists of the friends each viewer has opened in the graph view.

    ``opened`` holds (viewer, friend) rows. A list is fetched only for an opened friend, so
    the result is as large as the lists that were asked for.
    """
    asked = opened.distinct().join(friends.select(F.col("src").alias("viewer"), F.col("dst").alias("friend")), ["viewer", "friend"], "left_semi")
    lists = friends.select(F.col("src").alias("friend"), F.col("dst").alias("found"))
    return lists.join(asked, ["friend"]).filter(F.col("found") != F.col("viewer"))


def two_hop(friends: DataFrame, opened: DataFrame) -> DataFrame:
    """Per viewer: users in the graph view, the fewest hops (1 or 2) and how many of the
    opened friends lead to them."""
    near = friends.select(
        F.col("src").alias("viewer"), F.col("dst").alias("usr"), F.lit(1).alias("hop"),
        F.lit(0).alias("via"),
    )
    far = expand_friends(friends, opened).select(
        "viewer", F.col("found").alias("usr"), F.lit(2).alias("hop"), F.lit(1).alias("via")
    )
    return (
        near.unionByName(far)
        .groupBy("viewer", "usr")
        .agg(F.min("hop").cast("long").alias("hop"), F.sum("via").alias("mutual"))
    )


def friends_page(users: DataFrame, friends: DataFrame, requests: DataFrame) -> DataFrame:
    """The counts of friends and of sent requests per user."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias(name))

    joined = (
        users.select("id")
        .join(counted(friends, "n_friends"), "id", "left")
        .join(counted(requests, "n_requests"), "id", "left")
    )
    return joined.select(
        "id",
        F.coalesce("n_friends", F.lit(0)).cast("long").alias("n_friends"),
        F.coalesce("n_requests", F.lit(0)).cast("long").alias("n_requests"),
    )
