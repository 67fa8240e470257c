"""The keyed item log that holds all entities, and its split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Sort-key marks of the stored entities (fixed values).
PROFILE = "user"
PREFIXES = {
    "friend": "FRIEND#",
    "request": "REQUEST#",
    "post": "POST#",
    "comment": "COMMENT#",
    "articlelike": "articlelike",
    "invite": "INVITE#",
    "group_invite": "GROUP#",
}


def _items(df: DataFrame, kind: str, key: str | Column, relation: Column) -> DataFrame:
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.cast("string").alias("id"), relation.alias("user_relation"),
                     F.lit(kind).alias("kind"))


def _marked(kind: str, rest: str) -> Column:
    return F.concat(F.lit(PREFIXES[kind]), F.col(rest).cast("string"))


def item_log(
    users: DataFrame,
    friends: DataFrame,
    requests: DataFrame,
    posts: DataFrame,
    comments: DataFrame,
    likes: DataFrame,
    invites: DataFrame,
) -> DataFrame:
    """(id, user_relation, kind). The kind of a part is a literal, so a filter on it leaves out
    the parts, and their scans, that cannot match."""
    private = invites.filter(F.col("chat_id").isNull())
    group = invites.filter(F.col("chat_id").isNotNull())
    parts = [
        _items(users, "user", "id", F.lit(PROFILE)),
        _items(friends, "friend", "src", _marked("friend", "dst")),
        _items(requests, "request", "src", _marked("request", "dst")),
        _items(posts, "post", "author", _marked("post", "post_id")),
        _items(comments, "comment", _marked("post", "post_id"), _marked("comment", "comment_id")),
        _items(likes, "articlelike", "usr", _marked("articlelike", "article_id")),
        _items(private, "invite", "invitee", _marked("invite", "inviter")),
        _items(group, "group_invite", "invitee", F.concat(_marked("group_invite", "inviter"), F.lit(","),
                                          F.col("chat_id").cast("string"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def by_prefix(items: DataFrame, prefix: str, ids: DataFrame | None = None) -> DataFrame:
    """Items whose sort key begins with ``prefix``, of all ids or of those in ``ids``."""
    found = items.filter(F.col("user_relation").startswith(prefix))
    if ids is not None:
        found = found.join(ids.select("id").distinct(), ["id"], "left_semi")
    return found


def marked_of(items: DataFrame, users: DataFrame) -> DataFrame:
    """The marked items of the users (``id``), with the comments under their posts, which are
    kept under the post: one pass for the posts' keys and one for the items."""
    keys = users.select("id").distinct()
    posts = items.filter(F.col("kind") == "post").join(keys, "id", "left_semi")
    owners = keys.unionByName(posts.select(F.col("user_relation").alias("id")).distinct())
    return items.filter(F.col("kind") != "user").join(owners, "id", "left_semi")


def split_entities(items: DataFrame) -> dict[str, DataFrame]:
    """One DataFrame per entity, the mark stripped from the sort key."""
    if "kind" not in items.columns:
        items = items.withColumn("kind", entity_kind(F.col("user_relation")))
    parts = {"user": items.filter(F.col("kind") == "user").select("id")}
    for kind, prefix in PREFIXES.items():
        rest = F.substring("user_relation", F.lit(len(prefix) + 1), F.length("user_relation"))
        parts[kind] = items.filter(F.col("kind") == kind).select("id", rest.alias("key"))
    return parts


def entity_kind(relation: Column) -> Column:
    kind = F.when(relation == PROFILE, F.lit("user"))
    for name, prefix in PREFIXES.items():
        kind = kind.when(relation.startswith(prefix), F.lit(name))
    return kind


def count_entities(items: DataFrame) -> DataFrame:
    """Items per entity in one read."""
    return (
        items.select(entity_kind(F.col("user_relation")).alias("kind"))
        .filter(F.col("kind").isNotNull())
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("n"))
    )
