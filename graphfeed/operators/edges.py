"""The typed user-category-article graph and its transfer weights."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


USER, ARTICLE, CATEGORY = "u", "a", "c"
EDGE_COLUMNS = ["src_type", "src", "dst_type", "dst"]

# Shares of a user's mass sent to friends, liked articles and interests (fixed values).
USER_SHARES = {USER: 0.3, ARTICLE: 0.4, CATEGORY: 0.3}


def _edges(df: DataFrame, src_type: str, src: Column, dst_type: str, dst: Column) -> DataFrame:
    return df.select(
        F.lit(src_type).alias("src_type"),
        src.cast("string").alias("src"),
        F.lit(dst_type).alias("dst_type"),
        dst.cast("string").alias("dst"),
    )


def with_reverse(edges: DataFrame) -> DataFrame:
    """Each edge and its reverse, from one read of the input."""
    ahead = F.struct(*EDGE_COLUMNS)
    back = F.struct(
        F.col("dst_type").alias("src_type"),
        F.col("dst").alias("src"),
        F.col("src_type").alias("dst_type"),
        F.col("src").alias("dst"),
    )
    return edges.select(F.explode(F.array(ahead, back)).alias("_edge")).select("_edge.*")


def article_category_edges(news: DataFrame) -> DataFrame:
    return with_reverse(
        _edges(news, ARTICLE, F.col("id"), CATEGORY, F.lower("category"))
    )


def interest_edges(interests: DataFrame) -> DataFrame:
    """``interests`` has one row per user and interest; see ``explode_interests``."""
    return with_reverse(
        _edges(interests, USER, F.col("usr"), CATEGORY, F.lower("category"))
    )


def explode_interests(users: DataFrame) -> DataFrame:
    """(usr, category) rows from profiles that hold interests as an array."""
    return users.select(F.col("id").alias("usr"), F.explode("interests").alias("category"))


def like_edges(likes: DataFrame) -> DataFrame:
    return with_reverse(_edges(likes, USER, F.col("usr"), ARTICLE, F.col("article_id")))


def friend_edges(friends: DataFrame) -> DataFrame:
    """Friendships are stored in both directions, so each row is one edge."""
    return _edges(friends, USER, F.col("src"), USER, F.col("dst"))


def all_edges(*edge_sets: DataFrame) -> DataFrame:
    """Bag union: repeated edges count."""
    return reduce(DataFrame.unionByName, edge_sets)


def _with_class(edges: DataFrame) -> DataFrame:
    """A user's edges are weighted per kind of target, all others together."""
    return edges.withColumn(
        "edge_class",
        F.when(F.col("src_type") == USER, F.col("dst_type")).otherwise(F.lit("any")),
    )


def node_degrees(edges: DataFrame) -> DataFrame:
    return (
        _with_class(edges)
        .groupBy("src_type", "src", "edge_class")
        .agg(F.count(F.lit(1)).alias("degree"))
    )


def weighted_edges(edges: DataFrame, shares: dict[str, float] = USER_SHARES) -> DataFrame:
    """Share of the class over the number of edges in it.

    Degrees come from a combining aggregate and are joined back with hot sources split, as
    a category may own a large part of all edges.
    """
    keys = ["src_type", "src", "edge_class"]
    degrees = node_degrees(edges)
    joined = _with_class(edges).join(degrees, keys)
    share = F.lit(1.0)
    for dst_type, value in shares.items():
        share = F.when(
            (F.col("src_type") == USER) & (F.col("dst_type") == dst_type), F.lit(value)
        ).otherwise(share)
    return joined.select(*EDGE_COLUMNS, (share / F.col("degree")).alias("weight"))


def seeds(interests: DataFrame) -> DataFrame:
    """Every user with an interest starts with 1.0 of the own label."""
    return interests.select(
        F.lit(USER).alias("node_type"),
        F.col("usr").alias("node"),
        F.col("usr").alias("label"),
        F.lit(1.0).alias("value"),
    ).distinct()
