"""Per-user article recommendations from the rank table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphfeed.functions.scalars import rounded


def top_recs(ranks: DataFrame, news: DataFrame, n: int = 15, order: str = "desc") -> DataFrame:
    """First ``n`` ranked articles per user that exist in the news table.

    Articles without a news row are skipped before the cut. The cut runs on each map side
    first (window group limit), so a hot user brings at most ``n`` rows per task.
    """
    rank = rounded(F.col("article_rank"), 12)
    first = rank.desc() if order == "desc" else rank.asc()
    known = ranks.join(news.select(F.col("id").alias("article_id")), ["article_id"], "left_semi")
    position = F.row_number().over(Window.partitionBy("label").orderBy(first, "article_id"))
    return known.withColumn("position", position.cast("long")).filter(F.col("position") <= n)


def with_article(recs: DataFrame, news: DataFrame) -> DataFrame:
    """Join the article columns that a recommendation shows."""
    shown = news.select(F.col("id").alias("article_id"), "category", "headline", "link")
    return recs.join(shown, ["article_id"])


def on_shifted_date(news: DataFrame, today: str, year: int = 2017) -> DataFrame:
    """Articles of the same month and day in ``year``; ``today`` is yyyy-MM-dd."""
    return news.filter(F.col("date") == F.lit(f"{year:04d}{today[4:]}"))


def user_rec_sets(recs: DataFrame, n: int = 15) -> DataFrame:
    """One row per user with the recommendation list; at most ``n`` entries each."""
    listed = F.sort_array(F.collect_list(F.struct("position", "article_id")))
    return recs.filter(F.col("position") <= n).groupBy("label").agg(
        F.transform(listed, lambda r: r["article_id"]).alias("recs")
    )


def recs_of(user_recs: DataFrame, users: DataFrame) -> DataFrame:
    """The stored list of the asked users, one row per entry."""
    asked = user_recs.join(users.select(F.col("id").alias("label")).distinct(),
                           "label", "left_semi")
    return asked.select("label", F.posexplode("recs").alias("_pos", "article_id")).select(
        "label", (F.col("_pos") + 1).cast("long").alias("position"), "article_id"
    )
