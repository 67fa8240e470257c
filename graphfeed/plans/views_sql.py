"""SQL twins of ``sources.tables``, put in front of the checking queries as CTEs."""

from __future__ import annotations

import re

_POST_REF = "join v_rn r on r.rn = "

VIEWS = {
    "v_n": """
        select (select count(distinct user_id) from events) as nu,
               (select count(*) from documents) as nd,
               (select count(distinct source) from documents) as nc,
               (select count(*) from events where event_type = 'purchase') as np,
               (select count(*) from events where event_type = 'error') as ne,
               (select count(distinct conv_id) from conversations) as nchats""",
    "v_ev": """
        select event_id, epoch_us(ts) as ts, user_id, event_type, value,
               cast(json_extract_string(props, '$.k') as bigint) as k
        from events""",
    "v_news": """
        select doc_id as id, lower(source) as category,
               split_part(text, chr(10), 1) as headline,
               'author' || (doc_id % 50) as authors,
               'http://example.com/' || doc_id as link, text as description,
               cast(date '2017-01-01' + cast(doc_id % 365 as integer) as varchar) as date
        from documents""",
    "v_users": "select distinct cast(user_id as varchar) as id from events",
    "v_interests": """
        select distinct cast(user_id as varchar) as usr,
               'src' || (k % (select nc from v_n)) as category
        from v_ev where event_type = 'signup'""",
    "v_likes": """
        select distinct cast(user_id as varchar) as usr,
               (user_id * 31 + k * 7) % (select nd from v_n) as article_id
        from v_ev where event_type = 'click'""",
    "v_friend_pairs": """
        select * from (
          select cast(user_id as varchar) as src,
                 cast((user_id + k) % (select nu from v_n) as varchar) as dst, ts
          from v_ev where event_type = 'view') where src <> dst""",
    "v_friends": """
        select src, dst, min(ts) as ts from (
          select src, dst, ts from v_friend_pairs
          union all select dst, src, ts from v_friend_pairs) group by src, dst""",
    "v_opened": """
        select distinct cast(user_id as varchar) as viewer,
               cast((user_id + k) % (select nu from v_n) as varchar) as friend
        from v_ev where event_type = 'click'""",
    "v_signup_forms": """
        select event_id as form_id, case when k % 11 = 0 then '' else 'user' || user_id end
                 as username,
               case when k % 13 <> 0 then 'pw' || k end as password,
               case when k % 5 = 0 then '' else user_id || '@x.org' end as email,
               case when k % 17 <> 0 then '1990' end as year,
               case when k % 7 = 0 then '' else 'aff' || user_id end as affiliation,
               case k % 3 when 0 then 1 when 1 then 2 else 0 end as n_interests
        from v_ev where event_type = 'signup'""",
    "v_update_forms": """
        select event_id as form_id, cast(user_id as varchar) as username,
               case when k % 10 = 0 then '' else user_id || '@x.org' end as email,
               case when k % 9 <> 0 then 'aff' || user_id end as affiliation,
               case when k % 4 < 2 then 'old' else '' end as old_password,
               case when k % 4 in (0, 2) then 'new' else '' end as new_password,
               case k % 3 when 1 then 1 when 2 then 2 end as n_interests
        from v_ev where event_type = 'view'""",
    "v_attempts": """
        select event_id as op_id, cast(user_id as varchar) as usr,
               cast((user_id + k) % (select nu from v_n) as varchar) as friend
        from v_ev where event_type = 'click'""",
    "v_leavers": """
        select distinct k % (select nchats from v_n) as chat_id,
               cast(user_id as varchar) as member
        from v_ev where event_type = 'error'""",
    "v_open_chats": """
        select cast(user_id as varchar) as usr,
               arg_max(k % (select nchats from v_n), ts) as chat_id
        from v_ev where event_type = 'view' group by user_id""",
    "v_live": """
        select conv_id as chat_id, turn,
               cast((conv_id % 10 + turn * 2) % (select nu from v_n) as varchar) as sender, text
        from conversations""",
    "v_new_messages": """
        select chat_id, cast((chat_id % 10 + event_id % 8) % (select nu from v_n) as varchar)
                 as sender, event_id as op_id, 'message ' || event_id as text
        from (select *, k % (select nchats from v_n) as chat_id from v_ev
              where event_type = 'click')""",
    "v_queries": """
        select conv_id * 1000 + turn as query_id, text from conversations where role = 'user'""",
    "v_terms": "select distinct cast(cast(floor(value) as bigint) as varchar) as term from events",
    "v_presence_now": """
        select id, is_online, last_seen from (
          select *, row_number() over (partition by id order by ts desc, op_id desc) as latest
          from v_presence) where latest = 1""",
    "v_comment_summary": """
        select post_id, count(*) as n_comments, arg_min(comment_id, ts) as first_comment,
               arg_max(comment_id, ts) as last_comment
        from v_comments group by post_id""",
    "v_feed_posts": """
        select p.post_id, p.author, p.ts, p.wall, p.likes,
               coalesce(c.n_comments, 0) as n_comments, c.first_comment, c.last_comment
        from v_posts p left join v_comment_summary c using (post_id)""",
    "v_home": """
        select *, row_number() over (partition by reader order by ts desc, post_id) as position
        from (select src as reader, dst as author from v_friends
              union all select distinct author, author from v_posts) r
        join v_feed_posts using (author)""",
    "v_numbered_comments": """
        select *, row_number() over (partition by post_id order by ts, comment_id)
                 as comment_position
        from v_comments""",
    "v_requests": """
        select src, dst, max(ts) as ts from (
          select cast(user_id as varchar) as src,
                 cast((user_id + k * 3 + 1) % (select nu from v_n) as varchar) as dst, ts
          from v_ev where event_type = 'view' and k % 5 = 0) where src <> dst
        group by src, dst""",
    "v_posts": """
        select event_id as post_id, cast(user_id as varchar) as author, ts,
               case when k % 2 = 0 then cast((user_id + k) % (select nu from v_n) as varchar) end
                 as wall,
               cast(floor(value) as bigint) as likes,
               'tag' || (k % 10) as tag1, 'tag' || (k % 7) as tag2
        from v_ev where event_type = 'purchase'""",
    "v_rn": """
        select event_id as post_id, row_number() over (order by event_id) - 1 as rn
        from events where event_type = 'purchase'""",
    "v_crn": """
        select event_id as comment_id, row_number() over (order by event_id) - 1 as rn
        from events where event_type = 'error'""",
    "v_comments": f"""
        select event_id as comment_id, r.post_id, cast(user_id as varchar) as commenter, ts,
               'c' || event_id as text, cast(floor(value) as bigint) as likes
        from v_ev {_POST_REF} (event_id * 17 + k) % (select np from v_n)
        where event_type = 'error'""",
    "v_presence": """
        select cast(user_id as varchar) as id, ts, event_id as op_id, k % 2 = 0 as is_online,
               case when k % 2 <> 0 then ts end as last_seen
        from v_ev where event_type in ('signup', 'error')""",
    "v_like_log": f"""
        select r.post_id, event_id as op_id, ts
        from v_ev {_POST_REF} (event_id * 13 + k) % (select np from v_n)
        where event_type = 'click'""",
    "v_comment_like_log": """
        select r.comment_id, event_id as op_id, ts
        from v_ev join v_crn r on r.rn = (event_id * 13 + k) % (select ne from v_n)
        where event_type = 'click'""",
    "v_post_log": f"""
        select event_id as post_id, ts as op_ts, event_id as op_id, 'create' as op,
               'post ' || event_id as text
        from v_ev where event_type = 'purchase'
        union all
        select r.post_id, ts, event_id, case when event_type = 'view' then 'edit' else 'delete' end,
               case when event_type = 'view' then 'edit ' || event_id end
        from v_ev {_POST_REF} event_id % (select np from v_n)
        where event_type = 'view' or (event_type = 'error' and k < 10)""",
    "v_comment_log": """
        select event_id as comment_id, ts as op_ts, event_id as op_id, 'create' as op,
               'c' || event_id as text
        from v_ev where event_type = 'error'
        union all
        select r.comment_id, ts, event_id,
               case when event_type = 'signup' then 'edit' else 'delete' end,
               case when event_type = 'signup' then 'edit ' || event_id end
        from v_ev join v_crn r on r.rn = event_id % (select ne from v_n)
        where event_type = 'signup' or (event_type = 'click' and k < 10)""",
    "v_profile_log": """
        select cast(user_id as varchar) as id, ts as op_ts, event_id as op_id,
               case when k % 5 <> 0 then 'u' || user_id || '@' || (k % 3) || '.org' end as email,
               case when k % 3 <> 0 then 'aff' || (k % 4) end as affiliation,
               case when k % 4 = 0 then 'pw' || k end as password,
               case when k % 7 = 0 then 'src' || (k % (select nc from v_n)) end as interest
        from v_ev where event_type = 'signup'""",
    "v_membership": """
        select distinct conv_id as chat_id,
               cast((conv_id % 10 + turn) % (select nu from v_n) as varchar) as member
        from conversations""",
    "v_messages": "select conv_id as chat_id, turn, role, text from conversations",
    "v_chat_keys": """
        select chat_id, string_agg(member, ',' order by member) as members, count(*) as n_members
        from v_membership group by chat_id""",
    "v_invites": """
        select distinct * from (
          select cast(user_id as varchar) as invitee,
                 cast((user_id + k + 1) % (select nu from v_n) as varchar) as inviter,
                 case when k < 10 then k % (select nchats from v_n) end as chat_id
          from v_ev where event_type = 'click' and k < 20) where invitee <> inviter""",
    "v_edges": """
        select 'a' as src_type, cast(id as varchar) as src, 'c' as dst_type, category as dst
        from v_news
        union all select 'c', category, 'a', cast(id as varchar) from v_news
        union all select 'u', usr, 'c', category from v_interests
        union all select 'c', category, 'u', usr from v_interests
        union all select 'u', usr, 'a', cast(article_id as varchar) from v_likes
        union all select 'a', cast(article_id as varchar), 'u', usr from v_likes
        union all select 'u', src, 'u', dst from v_friends""",
    "v_edge_class": """
        select *, case when src_type = 'u' then dst_type else 'any' end as edge_class
        from v_edges""",
    "v_weighted": """
        select src_type, src, dst_type, dst,
               (case when src_type <> 'u' then 1.0 when dst_type = 'a' then 0.4 else 0.3 end)::double
                 / count(*) over (partition by src_type, src, edge_class) as weight
        from v_edge_class""",
    "v_seeds": """
        select distinct 'u' as node_type, usr as node, usr as label, 1.0::double as value
        from v_interests""",
}



def rounded_sql(value: str, digits: int) -> str:
    """Twin of ``functions.scalars.rounded``."""
    return f"(floor(({value}) * 1e{digits} + 0.5001) / 1e{digits})"


_NAME = re.compile(r"\bv_[a-z_]+\b")


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the views it names, each after those it needs itself."""
    available = {**VIEWS, **(extra or {})}
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in _NAME.findall(text):
            if name in available and name not in ordered:
                need(available[name])
                ordered.append(name)

    need(body)
    if not ordered:
        return body
    ctes = ",\n".join(f"{name} as materialized ({available[name]})" for name in ordered)
    return f"with {ctes}\n{body}"
