"""Source, sink and entity queries (section A of the survey)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphfeed.functions.scalars import rounded
from graphfeed.lineage import scratch_path
from graphfeed.operators import recommend
from graphfeed.plans.ranking import REC_VIEW, converged_sql, rec_ranks, recs_sql
from graphfeed.plans.views_sql import rounded_sql, with_views
from graphfeed.sources import articles, items, ranks
from graphfeed.sources.tables import Tables


def _article_lines(t: Tables) -> str:
    """Write the news as JSON lines in id order and return the path."""
    path = scratch_path(t.spark, "articles")
    lines = t.news().select(
        "id", "category", "headline", "authors", "link",
        F.col("description").alias("short_description"), "date",
    )
    articles.write_article_lines(lines, path, "id")
    return path


def articles_from_jsonl(t: Tables) -> DataFrame:
    good, _ = articles.read_articles(t.spark, _article_lines(t))
    return good


def article_ids(t: Tables) -> DataFrame:
    return articles.read_with_line_ids(t.spark, _article_lines(t)).select("id", "link")


def news_table(t: Tables) -> DataFrame:
    read = articles.read_with_line_ids(t.spark, _article_lines(t))
    return articles.write_news(articles.build_news(read), scratch_path(t.spark, "news"))


def item_log(t: Tables) -> DataFrame:
    """All entities in one keyed table, told apart by the sort key."""
    return items.item_log(
        users=t.users(), friends=t.friends(), requests=t.requests(), posts=t.posts(),
        comments=t.comments(), likes=t.likes(), invites=t.invites(),
    )


def entity_split(t: Tables) -> DataFrame:
    return items.count_entities(item_log(t))


def _out(df: DataFrame) -> DataFrame:
    return df.select(
        "label", "article_id", rounded(F.col("article_rank"), 8).alias("article_rank")
    )


def recs_sink_replace(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "recs")
    new = rec_ranks(t)
    ranks.write_recs(new.withColumn("article_id", F.col("article_id") + 1), path)
    return _out(ranks.write_recs(new, path))


def recs_sink_upsert(t: Tables) -> DataFrame:
    """Old table: ranks of even articles, doubled. New rows: articles divisible by three."""
    all_ranks = rec_ranks(t)
    old = all_ranks.filter(F.col("article_id") % 2 == 0).withColumn(
        "article_rank", F.col("article_rank") * 2
    )
    new = all_ranks.filter(F.col("article_id") % 3 == 0)
    path = scratch_path(t.spark, "recs")
    ranks.write_recs(old, path)
    return _out(ranks.write_recs(new, path, mode="upsert"))


def user_recs_sink(t: Tables) -> DataFrame:
    recs = recommend.user_rec_sets(recommend.top_recs(rec_ranks(t), t.news()))
    stored = ranks.write_user_recs(recs, scratch_path(t.spark, "user-recs"))
    return stored.select(
        "label",
        F.array_join(F.col("recs").cast("array<string>"), ",").alias("recs"),
        F.size("recs").cast("long").alias("n_recs"),
    )


def recs_lookup(t: Tables) -> DataFrame:
    recs = recommend.user_rec_sets(recommend.top_recs(rec_ranks(t), t.news()))
    return recommend.recs_of(recs, t.users())


_ARTICLE = ("category, headline, authors, link, description as short_description, date")

QUERIES = {
    "articles_from_jsonl": articles_from_jsonl,
    "article_ids": article_ids,
    "news_table": news_table,
    "entity_split": entity_split,
    "recs_sink_replace": recs_sink_replace,
    "recs_sink_upsert": recs_sink_upsert,
    "user_recs_sink": user_recs_sink,
    "recs_lookup": recs_lookup,
}

_RANK = f"{rounded_sql('article_rank', 8)} as article_rank"

ORACLES = {
    "articles_from_jsonl": with_views(f"select {_ARTICLE} from v_news"),
    "article_ids": with_views(
        "select row_number() over (order by id) - 1 as id, link from v_news"),
    "news_table": with_views(
        "select id, category, headline, authors, link, description, date from v_news"),
    "entity_split": with_views("""
        select 'user' as kind, count(*) as n from v_users
        union all select 'friend', count(*) from v_friends
        union all select 'request', count(*) from v_requests
        union all select 'post', count(*) from v_posts
        union all select 'comment', count(*) from v_comments
        union all select 'articlelike', count(*) from v_likes
        union all select 'invite', count(*) from (
          select distinct invitee, inviter from v_invites where chat_id is null)
        union all select 'group_invite', count(*) from (
          select distinct invitee, inviter, chat_id from v_invites where chat_id is not null)"""),
    "recs_sink_replace": converged_sql(
        f"select label, article_id, {_RANK} from {REC_VIEW}"),
    "recs_sink_upsert": converged_sql(
        f"""select label, article_id, {_RANK} from (
              select label, article_id, article_rank * 2 as article_rank from {REC_VIEW}
              where article_id % 2 = 0 and article_id % 3 <> 0
              union all select * from {REC_VIEW} where article_id % 3 = 0)"""),
    "user_recs_sink": recs_sql(
        "desc", """label, string_agg(cast(article_id as varchar), ',' order by position) as recs,
                   count(*) as n_recs""").replace(
        "where position <= 15", "where position <= 15 group by label"),
    "recs_lookup": recs_sql("desc", "label, position, article_id"),
}
