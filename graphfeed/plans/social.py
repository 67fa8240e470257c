"""User, friend and feed queries (sections B, C, D, F and K of the survey)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphfeed.operators import feeds, recommend, social
from graphfeed.operators import validation as V
from graphfeed.operators.changelog import partial_update
from graphfeed.plans.sources import item_log
from graphfeed.plans.views_sql import with_views
from graphfeed.sources import items
from graphfeed.sources.tables import Tables

FEED = ["position", "post_id", "author", "ts", "likes",
        "n_comments", "first_comment", "last_comment"]


def _presence(t: Tables) -> DataFrame:
    return social.presence_now(t.presence_log())


def _profiles(t: Tables) -> DataFrame:
    """Profile rows: the latest given email and affiliation of each user."""
    return partial_update(t.profile_log(), "id", ["email", "affiliation"])


def profile_lookup(t: Tables) -> DataFrame:
    wanted = t.requests().select(F.col("dst").alias("id"))
    return social.lookup(_profiles(t), wanted, ["email", "affiliation"])


def prefix_filter(t: Tables) -> DataFrame:
    """All marked items of the users who have sent a request, and comments under their posts."""
    return items.marked_of(item_log(t), t.requests().select(F.col("src").alias("id")))


def hashtag_posts(t: Tables) -> DataFrame:
    return feeds.posts_by_hashtag(t.posts()).select("hashtag", "position", "post_id", "author")


def posts_with_comments(t: Tables) -> DataFrame:
    rows = feeds.attach_comments(t.posts().select("post_id", "author"), t.comments())
    return rows.select(
        "post_id", "author", "comment_position", "comment_id",
        F.col("comment.text").alias("text"),
        F.col("comment.likes").alias("likes"),
        F.col("comment.commenter").alias("commenter"),
    )


def posts_by_recency(t: Tables) -> DataFrame:
    return feeds.posts_of(t.posts_with_text()).select(
        "author", "position", "post_id", "ts", "text"
    )


def home_feed(t: Tables) -> DataFrame:
    return feeds.home_feed(t.posts(), t.friends(), t.comments()).select("reader", *FEED)


def home_feed_comments(t: Tables) -> DataFrame:
    comments = t.comments()
    return feeds.feed_comments(feeds.home_feed(t.posts(), t.friends(), comments), comments)


def home_feed_top20_comments(t: Tables) -> DataFrame:
    comments = t.comments()
    return feeds.shown_comments(feeds.home_feed(t.posts(), t.friends(), comments, n=20), comments)


def wall_feed(t: Tables) -> DataFrame:
    return feeds.wall_feed(t.posts(), t.friends(), t.comments()).select("reader", *FEED)


def profile_feed(t: Tables) -> DataFrame:
    return feeds.profile_feed(t.posts(), t.comments()).select(*FEED)


def removals(t: Tables) -> DataFrame:
    """Friendships ended again: those of the request log."""
    return t.requests().select("src", "dst")


QUERIES = {
    "user_list": lambda t: items.split_entities(item_log(t))["user"],
    "profile_lookup": profile_lookup,
    "prefix_filter": prefix_filter,
    "hashtag_posts": hashtag_posts,
    "user_autocomplete": lambda t: social.match_users(t.users(), t.search_terms()),
    "user_autocomplete_top10": lambda t: social.match_users(t.users(), t.search_terms(), n=10),
    "signup_validation": lambda t: V.checked_signups(t.signup_forms()).select(
        "form_id", "username", "reason"),
    "account_update_validation": lambda t: V.checked_account_updates(t.update_forms()).select(
        "form_id", "username", "reason"),
    "article_date_filter": lambda t: recommend.on_shifted_date(t.news(), "2024-02-29").unionByName(
        recommend.on_shifted_date(t.news(), "2024-06-11")).select("id", "date", "headline"),
    "friend_presence": lambda t: social.friends_with_presence(
        t.friends(), _presence(t)).select("src", "dst", "is_online", "last_seen"),
    "posts_with_comments": posts_with_comments,
    "like_counts": lambda t: feeds.like_counts(t.like_log()),
    "comment_like_counts": lambda t: feeds.like_counts(t.comment_like_log(), "comment_id"),
    "comment_counts": lambda t: feeds.comment_counts(t.posts(), t.comments()),
    "trending_posts": lambda t: feeds.trending(t.posts()).select("position", "post_id", "likes"),
    "trending_top100": lambda t: feeds.trending(t.posts(), 100).select(
        "position", "post_id", "likes"),
    "posts_by_recency": posts_by_recency,
    "friends_by_recency": lambda t: social.friends_of(t.friends()),
    "requests_by_recency": lambda t: social.requests_of(t.requests(), "sent").withColumn(
        "direction", F.lit("sent")).unionByName(
        social.requests_of(t.requests(), "received").withColumn("direction", F.lit("received"))),
    "home_feed": home_feed,
    "home_feed_comments": home_feed_comments,
    "home_feed_top20": lambda t: feeds.home_feed(
        t.posts(), t.friends(), t.comments(), n=20).select("reader", *FEED),
    "home_feed_top20_comments": home_feed_top20_comments,
    "wall_feed": wall_feed,
    "profile_feed": profile_feed,
    "friend_symmetry": lambda t: social.symmetric(t.friend_pairs()),
    "friend_removal": lambda t: social.remove_friends(t.friends(), removals(t)).select(
        "src", "dst"),
    "extended_friends": lambda t: social.two_hop(t.friends(), t.opened()),
    "friends_page": lambda t: social.friends_page(t.users(), t.friends(), t.requests()),
}

_FEED = ", ".join(FEED)

_SIGNUP_SQL = """
    case when username = '' then 'username' when coalesce(password, '') = '' then 'password'
         when email = '' then 'email' when coalesce(year, '') = '' then 'year'
         when affiliation = '' then 'affiliation' when n_interests < 2 then 'interests' end"""
_UPDATE_SQL = """
    case when email = '' or coalesce(affiliation, '') = '' then 'email or affiliation'
         when (old_password = '') <> (new_password = '') then 'passwords'
         when n_interests < 2 then 'interests' end"""
_FRIENDLY = """(select src as reader, dst as author from v_friends)"""

ORACLES = {
    "user_list": with_views("select id from v_users"),
    "profile_lookup": with_views("""
        select id, arg_max(email, op_ts) filter (email is not null) as email,
               arg_max(affiliation, op_ts) filter (affiliation is not null) as affiliation
        from v_profile_log where id in (select dst from v_requests) group by id"""),
    "prefix_filter": with_views("""
        select m.* from (
          select 'friend' as kind, src as id, 'FRIEND#' || dst as user_relation from v_friends
          union all select 'request', src, 'REQUEST#' || dst from v_requests
          union all select 'post', author, 'POST#' || post_id from v_posts
          union all select 'articlelike', usr, 'articlelike' || article_id from v_likes
          union all select 'invite', invitee, 'INVITE#' || inviter from v_invites
                    where chat_id is null
          union all select 'group_invite', invitee, 'GROUP#' || inviter || ',' || chat_id
                    from v_invites where chat_id is not null) m
        where id in (select src from v_requests)
        union all select 'comment', 'POST#' || c.post_id, 'COMMENT#' || c.comment_id
        from v_comments c join v_posts p using (post_id)
        where p.author in (select src from v_requests)"""),
    "hashtag_posts": with_views("""
        select hashtag, post_id, author,
               row_number() over (partition by hashtag order by ts desc, post_id) as position
        from (select tag1 as hashtag, post_id, author, ts from v_posts
              union select tag2, post_id, author, ts from v_posts)"""),
    "user_autocomplete": with_views(
        "select term, id from v_terms join v_users on contains(id, term)"),
    "user_autocomplete_top10": with_views("""
        select term, id from v_terms join v_users on contains(id, term)
        qualify row_number() over (partition by term order by id) <= 10"""),
    "article_date_filter": with_views("""
        select id, date, headline from v_news where date in ('2017-02-29', '2017-06-11')"""),
    "signup_validation": with_views(f"""
        select form_id, username, {_SIGNUP_SQL} as reason from v_signup_forms"""),
    "account_update_validation": with_views(f"""
        select form_id, username, {_UPDATE_SQL} as reason from v_update_forms"""),
    "friend_presence": with_views("""
        select src, dst, is_online, last_seen
        from v_friends left join v_presence_now on id = dst"""),
    "posts_with_comments": with_views("""
        select p.post_id, p.author, c.comment_position, c.comment_id, c.text, c.likes, c.commenter
        from v_posts p left join v_numbered_comments c using (post_id)"""),
    "like_counts": with_views(
        "select post_id, count(*) as n_likes from v_like_log group by post_id"),
    "comment_like_counts": with_views(
        "select comment_id, count(*) as n_likes from v_comment_like_log group by comment_id"),
    "comment_counts": with_views("select post_id, n_comments from v_feed_posts"),
    "trending_posts": with_views("""
        select post_id, likes, row_number() over (order by likes desc, post_id) as position
        from v_posts"""),
    "trending_top100": with_views("""
        select post_id, likes, row_number() over (order by likes desc, post_id) as position
        from v_posts order by position limit 100"""),
    "posts_by_recency": with_views("""
        select author, p.post_id, p.ts, n.headline as text,
               row_number() over (partition by author order by ts desc, post_id) as position
        from v_posts p join v_news n on n.id = p.post_id % (select nd from v_n)"""),
    "friends_by_recency": with_views("""
        select *, row_number() over (partition by src order by ts desc, dst) as position
        from v_friends"""),
    "requests_by_recency": with_views("""
        select *, 'sent' as direction,
               row_number() over (partition by src order by ts desc, dst) as position
        from v_requests
        union all
        select *, 'received',
               row_number() over (partition by dst order by ts desc, src)
        from v_requests"""),
    "home_feed": with_views(f"select reader, {_FEED} from v_home"),
    "home_feed_comments": with_views("""
        select reader, position, post_id, comment_position, comment_id, commenter, text
        from (select reader, position, post_id from v_home)
        join v_numbered_comments using (post_id)"""),
    "home_feed_top20": with_views(f"select reader, {_FEED} from v_home where position <= 20"),
    "home_feed_top20_comments": with_views("""
        select post_id, comment_position, comment_id, commenter, text from v_numbered_comments
        where post_id in (select post_id from v_home where position <= 20)"""),
    "wall_feed": with_views(f"""
        select reader, {_FEED} from (
          select *, row_number() over (partition by reader order by ts desc, post_id) as position
          from (select author as reader, * from v_feed_posts
                union all
                select wall as reader, f.* from v_feed_posts f
                join {_FRIENDLY} r on r.reader = f.wall and r.author = f.author))"""),
    "profile_feed": with_views(f"""
        select {_FEED} from (
          select *, row_number() over (partition by author order by ts desc, post_id) as position
          from v_feed_posts)"""),
    "friend_symmetry": with_views("""
        select src, dst from v_friend_pairs union select dst, src from v_friend_pairs"""),
    "friend_removal": with_views("""
        select src, dst from v_friends
        except (select src, dst from v_requests union select dst, src from v_requests)"""),
    "extended_friends": with_views("""
        select viewer, usr, min(hop) as hop, cast(sum(via) as bigint) as mutual from (
          select src as viewer, dst as usr, 1 as hop, 0 as via from v_friends
          union all
          select o.viewer, f.dst, 2, 1
          from v_opened o join v_friends mine on mine.src = o.viewer and mine.dst = o.friend
          join v_friends f on f.src = o.friend where f.dst <> o.viewer)
        group by viewer, usr"""),
    "friends_page": with_views("""
        select id, (select count(*) from v_friends where src = id) as n_friends,
               (select count(*) from v_requests where src = id) as n_requests
        from v_users"""),
}
