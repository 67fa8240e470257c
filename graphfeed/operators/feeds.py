"""Posts, comments and the home, wall and profile feeds of all users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphfeed.operators.skew import number_within


def newest_first(id_col: str, ts: str = "ts") -> list[Column]:
    return [F.col(ts).desc(), F.col(id_col).asc()]


def like_counts(likes: DataFrame, key: str = "post_id") -> DataFrame:
    """Each like is one increment."""
    return likes.groupBy(key).agg(F.count(F.lit(1)).alias("n_likes"))


def comment_counts(posts: DataFrame, comments: DataFrame) -> DataFrame:
    counts = comments.groupBy("post_id").agg(F.count(F.lit(1)).alias("n_comments"))
    return posts.select("post_id").join(counts, "post_id", "left").select(
        "post_id", F.coalesce("n_comments", F.lit(0)).cast("long").alias("n_comments")
    )


def comment_summary(comments: DataFrame) -> DataFrame:
    """Per post: number of comments, first and last one. A fixed-size row, however many."""
    at = F.struct("ts", "comment_id")
    return comments.groupBy("post_id").agg(
        F.count(F.lit(1)).alias("n_comments"),
        F.min_by("comment_id", at).alias("first_comment"),
        F.max_by("comment_id", at).alias("last_comment"),
    )


def with_comment_summary(posts: DataFrame, comments: DataFrame) -> DataFrame:
    joined = posts.join(comment_summary(comments), ["post_id"], "left")
    return joined.withColumn("n_comments", F.coalesce("n_comments", F.lit(0)).cast("long"))


def attach_comments(
    posts: DataFrame, comments: DataFrame, hot_rows: int | None = None
) -> DataFrame:
    """One row per post and comment in time order; a post without comments keeps one row.

    The list of comments stays rows, so that a post with very many of them is spread out.
    """
    numbered = number_within(
        comments,
        ["post_id"],
        [F.col("ts").asc(), F.col("comment_id").asc()],
        "comment_position",
        hot_rows,
    )
    shown = numbered.select(
        "post_id",
        "comment_position",
        "comment_id",
        F.struct(
            F.col("text").alias("text"), F.col("likes").alias("likes"), "commenter"
        ).alias("comment"),
    )
    left = shown.join(posts, ["post_id"])
    silent = posts.join(comments.select("post_id").distinct(), "post_id", "left_anti")
    return left.unionByName(silent, allowMissingColumns=True)


def posts_of(posts: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Posts per author, newest first."""
    return number_within(posts, ["author"], newest_first("post_id"), hot_rows=hot_rows)


def posts_by_hashtag(posts: DataFrame, tag: str | None = None) -> DataFrame:
    """Posts of one tag, or of every tag, newest first."""
    if tag is not None:
        posts = posts.filter(F.array_contains("hashtags", tag))
    tagged = posts.select(
        F.explode("hashtags").alias("hashtag"), "post_id", "author", "ts"
    )
    if tag is not None:
        tagged = tagged.filter(F.col("hashtag") == tag)
    return number_within(tagged, ["hashtag"], newest_first("post_id"))


def trending(posts: DataFrame, n: int | None = None) -> DataFrame:
    """Posts by likes. With ``n`` only the best are kept; without, all are numbered."""
    order = [F.col("likes").desc(), F.col("post_id").asc()]
    if n is not None:
        best = posts.orderBy(*order).limit(n)
        # at most n rows are left to number
        return best.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("long"))
    return number_within(posts, [], order)


def readers(friends: DataFrame, posts: DataFrame) -> DataFrame:
    """(reader, author): everybody reads the own posts and those of friends."""
    own = posts.select(F.col("author").alias("reader"), "author").distinct()
    return friends.select(F.col("src").alias("reader"), F.col("dst").alias("author")).unionByName(
        own
    )


def _feed(
    pairs: DataFrame, posts: DataFrame, rows: DataFrame, n: int | None, hot_rows: int | None
) -> DataFrame:
    """Join readers to posts and number each reader's feed.

    With ``n`` only an author's newest ``n`` posts can be in a feed, so the others are left out
    before any reader meets them. Without it, how long a feed gets is known from post counts.
    """
    newest = newest_first("post_id")
    if n is not None:
        recent = F.row_number().over(Window.partitionBy("author").orderBy(*newest))
        rows = rows.withColumn("_recent", recent).filter(F.col("_recent") <= n).drop("_recent")
        position = F.row_number().over(Window.partitionBy("reader").orderBy(*newest))
        return (rows.join(pairs, ["author"])
                .withColumn("position", position.cast("long")).filter(F.col("position") <= n))
    per_author = posts.groupBy("author").agg(F.count(F.lit(1)).alias("n"))
    lengths = pairs.join(per_author, ["author"]).groupBy("reader").agg(F.sum("n").alias("n"))
    return number_within(
        rows.join(pairs, ["author"]), ["reader"], newest, hot_rows=hot_rows, sizes=lengths)


def home_feed(
    posts: DataFrame,
    friends: DataFrame,
    comments: DataFrame,
    n: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Own posts and those of all friends, newest first, with the comment summary."""
    rows = with_comment_summary(posts, comments)
    return _feed(readers(friends, posts), posts, rows, n, hot_rows)


def wall_feed(
    posts: DataFrame,
    friends: DataFrame,
    comments: DataFrame,
    hot_rows: int | None = None,
) -> DataFrame:
    """Own posts and friends' posts written on the user's wall."""
    own = posts.withColumn("reader", F.col("author"))
    # author and wall owner must be friends: one row per post, so nothing fans out
    pairs = friends.select(F.col("src").alias("reader"), F.col("dst").alias("author"))
    on_walls = posts.filter(F.col("wall").isNotNull()).withColumn("reader", F.col("wall"))
    by_friends = on_walls.join(pairs, ["reader", "author"], "left_semi")
    rows = own.unionByName(by_friends)
    rows = with_comment_summary(rows, comments)
    return number_within(rows, ["reader"], newest_first("post_id"), hot_rows=hot_rows)


def profile_feed(posts: DataFrame, comments: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """A user's own posts with comments, as anybody sees them."""
    return posts_of(with_comment_summary(posts, comments), hot_rows)


def numbered_comments(comments: DataFrame) -> DataFrame:
    """Comments with their place under their post, in time order."""
    return number_within(
        comments,
        ["post_id"],
        [F.col("ts").asc(), F.col("comment_id").asc()],
        "comment_position",
    ).select("post_id", "comment_position", "comment_id", "commenter", "text")


def feed_comments(feed: DataFrame, comments: DataFrame) -> DataFrame:
    """The comments under each feed row, in time order."""
    return feed.select("reader", "position", "post_id").join(
        numbered_comments(comments), ["post_id"])


def shown_comments(feed: DataFrame, comments: DataFrame) -> DataFrame:
    """The comments under the posts of a feed, once per post however many readers it has."""
    shown = feed.select("post_id").distinct()
    return numbered_comments(comments.join(shown, ["post_id"], "left_semi"))
