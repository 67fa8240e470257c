"""Chat, change-log and streaming queries (sections C, G, L, M and S of the survey)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphfeed.operators import changelog as M
from graphfeed.operators import chat as L
from graphfeed.operators import social
from graphfeed.plans.views_sql import with_views
from graphfeed.sources.tables import Tables, text_id
from graphfeed.streaming import jobs as S


def _presence(t: Tables) -> DataFrame:
    return social.presence_now(t.presence_log())


def chat_invite_gate(t: Tables) -> DataFrame:
    return L.valid_invites(t.chat_attempts(), t.friends(), _presence(t))


def batch_get_chats(t: Tables) -> DataFrame:
    return L.chats_by_ids(t.membership(), t.invites())


def same_member_set(t: Tables) -> DataFrame:
    """Candidates: the two of each private invite, and the members of a group invite's chat."""
    invites, membership = t.invites(), t.membership()
    both = F.explode(F.array("invitee", "inviter")).alias("member")
    name = F.concat_ws(">", "invitee", "inviter", F.col("chat_id").cast("string")).alias("set_id")
    people = invites.filter(F.col("chat_id").isNull()).select(name, both)
    inside = L.group_invite_inbox(invites).join(membership, ["chat_id"]).select(
        name, "member"
    )
    return L.find_matching_chats(membership, people.unionByName(inside))


def append_message(t: Tables) -> DataFrame:
    return L.append_messages(t.messages(), t.new_messages(), t.membership())


def accept_invite_open(t: Tables) -> DataFrame:
    """The invites left when everybody accepts the one of the smallest inviter."""
    invites = t.invites()
    chosen = L.invite_inbox(invites).groupBy("invitee").agg(F.min("inviter").alias("inviter"))
    taken = chosen.withColumn("chat_id", F.lit(None).cast("long"))
    return L.open_invites(invites, L.accept_invites(taken, t.membership()))


def accept_group_invite(t: Tables) -> DataFrame:
    return L.accept_group_invites(t.invites(), t.membership()).select(
        "invitee", "inviter", "chat_id", "entered_chat", "is_new", "n_members"
    )


def accept_group_invite_members(t: Tables) -> DataFrame:
    membership = t.membership()
    return L.new_group_members(L.accept_group_invites(t.invites(), membership), membership)


def accept_group_invite_versions(t: Tables) -> DataFrame:
    return L.chat_versions(L.accept_group_invites(t.invites(), t.membership()))


def accepted_chat_members(t: Tables) -> DataFrame:
    """The members of the first new chat of each invitee, read through the versions."""
    membership = t.membership()
    accepted = L.accept_group_invites(t.invites(), membership)
    asked = accepted.filter("is_new").groupBy("invitee").agg(F.min("entered_chat").alias("chat"))
    return L.members_of(asked, L.chat_versions(accepted), membership)


def insert_if_absent(t: Tables) -> DataFrame:
    signups = t.profile_log()
    return M.insert_if_absent(signups, "id").select("id", "op_id", "email", "affiliation")


def partial_update(t: Tables) -> DataFrame:
    return M.partial_update(
        t.profile_log(), "id", ["email", "affiliation", "password", "interest"]
    )


def idempotent_put(t: Tables) -> DataFrame:
    """Likes, requests and invites as they were clicked, each key once."""
    clicks = t.events("click")
    likes = clicks.select(
        F.lit("like").alias("kind"), text_id("user_id").alias("id"),
        text_id((F.col("user_id") * 31 + F.col("k") * 7) % t.n_docs).alias("key"),
    )
    asks = t.events("view").select(
        F.lit("request").alias("kind"), text_id("user_id").alias("id"),
        text_id((F.col("user_id") + F.col("k") * 3 + 1) % t.n_users).alias("key"),
    )
    invites = clicks.select(
        F.lit("invite").alias("kind"), text_id("user_id").alias("id"),
        text_id((F.col("user_id") + F.col("k") + 1) % t.n_users).alias("key"),
    )
    return M.idempotent_put(likes.unionByName(asks).unionByName(invites), ["kind", "id", "key"])


def delete_returning(t: Tables) -> DataFrame:
    """Invites between friends are removed and returned, the others stay."""
    friends = t.friends().select(F.col("src").alias("invitee"), F.col("dst").alias("inviter"))
    gone, kept = M.delete_returning(t.invites(), friends, ["invitee", "inviter"])
    columns = ["invitee", "inviter", "chat_id"]
    return gone.select(*columns, F.lit(True).alias("is_deleted")).unionByName(
        kept.select(*columns, F.lit(False).alias("is_deleted"))
    )


def stream_chat_delivery(t: Tables) -> DataFrame:
    live = t.shape_live_messages(S.table_stream(t.spark, t.sf_dir, "conversations"))
    return S.deliver(live, t.membership(), t.open_chats())


def _event_stream(t: Tables) -> DataFrame:
    return t.shape_events(S.table_stream(t.spark, t.sf_dir, "events"))


QUERIES = {
    "chat_invite_gate": chat_invite_gate,
    "batch_get_chats": batch_get_chats,
    "same_member_set": same_member_set,
    "duplicate_chats": lambda t: L.duplicate_chats(t.membership()),
    "chats_of_user": lambda t: L.user_chats(t.membership()),
    "chat_members": lambda t: L.chat_members(t.membership()),
    "chat_history": lambda t: L.chat_history(t.messages()).select(
        "chat_id", "position", "role", "text"),
    "append_message": append_message,
    "invite_inbox": lambda t: L.invite_inbox(t.invites()),
    "group_invite_inbox": lambda t: L.group_invite_inbox(t.invites()),
    "accept_invite": lambda t: L.accept_invites(t.invites(), t.membership()),
    "accept_invite_members": lambda t: L.new_chat_members(
        L.accept_invites(t.invites(), t.membership())),
    "accept_invite_open": accept_invite_open,
    "accept_group_invite": accept_group_invite,
    "accept_group_invite_members": accept_group_invite_members,
    "accept_group_invite_versions": accept_group_invite_versions,
    "accepted_chat_members": accepted_chat_members,
    "leave_chat": lambda t: L.leave(t.membership(), t.leavers()),
    "insert_if_absent": insert_if_absent,
    "partial_update": partial_update,
    "profile_change_posts": lambda t: M.profile_change_posts(t.profile_log()),
    "presence": _presence,
    "post_edits": lambda t: M.fold_edits(t.post_log(), "post_id").select(
        "post_id", "op_ts", "text"),
    "comment_edits": lambda t: M.fold_edits(t.comment_log(), "comment_id").select(
        "comment_id", "op_ts", "text"),
    "idempotent_put": idempotent_put,
    "delete_returning": delete_returning,
    "stream_chat_delivery": stream_chat_delivery,
    "stream_like_counts": lambda t: S.count_likes(t.shape_like_log(_event_stream(t))),
    "stream_presence": lambda t: S.follow_presence(t.shape_presence(_event_stream(t))),
    "stream_changelog": lambda t: S.apply_changes(t.shape_post_log(_event_stream(t))).select(
        "post_id", "op_ts", "text"),
}

_LAST_POST_OPS = """
    select post_id, op_ts, text from (
      select *, row_number() over (partition by post_id order by op_ts desc, op_id desc) as latest
      from v_post_log) where latest = 1 and op <> 'delete'"""

_EXTRA = {
    "v_first_chats": """
        select members, min(chat_id) as first_chat, count(*) as n_chats
        from v_chat_keys group by members""",
    "v_inbox": "select distinct invitee, inviter from v_invites where chat_id is null",
    "v_group_inbox": """
        select distinct invitee, inviter, chat_id from v_invites where chat_id is not null""",
    "v_joined": """
        select invitee, inviter, chat_id,
               string_agg(member, ',' order by member) as members, count(*) as n_members
        from (select i.invitee, i.inviter, i.chat_id, m.member
              from v_group_inbox i join v_membership m using (chat_id)
              union select invitee, inviter, chat_id, invitee from v_group_inbox
              where chat_id in (select chat_id from v_membership))
        group by all""",
    "v_origins": """
        select members, min((chat_id, invitee)) as origin from v_joined
        where members not in (select members from v_first_chats) group by members""",
    "v_entered": """
        select j.*, f.first_chat is null as is_new, o.origin,
               coalesce(cast(f.first_chat as varchar),
                        sha256(o.origin[1] || ':' || o.origin[2])) as entered_chat
        from v_joined j left join v_first_chats f using (members)
        left join v_origins o using (members)""",
}


def _sql(body: str) -> str:
    return with_views(body, _EXTRA)


_PAIR = "least(invitee, inviter) || ',' || greatest(invitee, inviter)"

ORACLES = {
    "chat_invite_gate": _sql("""
        select a.* from v_attempts a join v_friends f on f.src = a.usr and f.dst = a.friend
        join v_presence_now p on p.id = a.friend and p.is_online"""),
    "batch_get_chats": _sql("""
        select chat_id, member from v_membership
        where chat_id in (select chat_id from v_invites)"""),
    "same_member_set": _sql(f"""
        select set_id, first_chat, n_chats from (
          select set_id, string_agg(member, ',' order by member) as members from (
            select concat_ws('>', invitee, inviter) as set_id, invitee as member from v_inbox
            union select concat_ws('>', invitee, inviter), inviter from v_inbox
            union select concat_ws('>', invitee, inviter, chat_id), member
            from v_invites join v_membership using (chat_id)) group by set_id)
        join v_first_chats using (members)"""),
    "duplicate_chats": _sql("""
        select first_chat, chat_id, n_members, n_chats
        from v_chat_keys join v_first_chats using (members) where n_chats > 1"""),
    "chats_of_user": _sql("select member as usr, chat_id from v_membership"),
    "chat_members": _sql("""
        select chat_id, member, count(*) over (partition by chat_id) as n_members
        from v_membership"""),
    "chat_history": _sql("""
        select chat_id, role, text, row_number() over (partition by chat_id order by turn)
                 as position
        from v_messages"""),
    "append_message": _sql("""
        select chat_id, text,
               row_number() over (partition by chat_id order by is_new, seq) as position
        from (select chat_id, 0 as is_new, turn as seq, text from v_messages
              union all
              select n.chat_id, 1, op_id, text from v_new_messages n
              join v_membership m on m.chat_id = n.chat_id and m.member = n.sender)"""),
    "invite_inbox": _sql("select invitee, inviter from v_inbox"),
    "group_invite_inbox": _sql("select invitee, inviter, chat_id from v_group_inbox"),
    "accept_invite": _sql(f"""
        select invitee, inviter, coalesce(cast(first_chat as varchar), sha256({_PAIR})) as chat_id,
               first_chat is null as is_new
        from v_inbox left join v_first_chats on members = {_PAIR}"""),
    "accept_invite_members": _sql(f"""
        select distinct sha256({_PAIR}) as chat_id, unnest([invitee, inviter]) as member
        from v_inbox left join v_first_chats on members = {_PAIR} where first_chat is null"""),
    "accept_invite_open": _sql("""
        select invitee, inviter from v_inbox i where not exists (
          select 1 from (select invitee, min(inviter) as inviter from v_inbox group by invitee) c
          where (c.invitee = i.invitee and c.inviter = i.inviter)
             or (c.invitee = i.inviter and c.inviter = i.invitee))"""),
    "accept_group_invite": _sql("""
        select invitee, inviter, chat_id, entered_chat, is_new, n_members from v_entered"""),
    "accept_group_invite_members": _sql("""
        select distinct entered_chat, unnest(string_split(members, ',')) as member
        from v_entered where is_new"""),
    "accept_group_invite_versions": _sql("""
        select entered_chat as chat, cast(chat_id as varchar) as parent, invitee as added from v_entered
        where is_new
        qualify row_number() over (partition by entered_chat order by chat_id, invitee) = 1"""),
    "accepted_chat_members": _sql("""
        select distinct entered_chat as chat, unnest(string_split(members, ',')) as member
        from v_entered where is_new and entered_chat in (
          select min(entered_chat) from v_entered where is_new group by invitee)"""),
    "leave_chat": _sql("""
        select m.chat_id, m.member from v_membership m
        anti join v_leavers l on l.chat_id = m.chat_id and l.member = m.member
        union all
        select chat_id, null from v_membership m group by chat_id
        having count(*) = count(*) filter (
          (chat_id, member) in (select chat_id, member from v_leavers))"""),
    "insert_if_absent": _sql("""
        select id, op_id, email, affiliation from (
          select *, row_number() over (partition by id order by op_ts, op_id) as nth
          from v_profile_log) where nth = 1"""),
    "partial_update": _sql("""
        select id, arg_max(email, op_ts) filter (email is not null) as email,
               arg_max(affiliation, op_ts) filter (affiliation is not null) as affiliation,
               arg_max(password, op_ts) filter (password is not null) as password,
               arg_max(interest, op_ts) filter (interest is not null) as interest
        from v_profile_log group by id"""),
    "profile_change_posts": _sql("""
        select id as author, op_ts as ts, op_id,
               'My new ' || field || ' is ' || value || '!' as text
        from (select *, lag(value) over (partition by id, field order by op_ts, op_id) as previous
              from (select id, op_ts, op_id, 'email' as field, email as value from v_profile_log
                    union all
                    select id, op_ts, op_id, 'affiliation', affiliation from v_profile_log)
              where value is not null)
        where value <> previous"""),
    "presence": _sql("select id, is_online, last_seen from v_presence_now"),
    "post_edits": _sql(_LAST_POST_OPS),
    "comment_edits": _sql(
        _LAST_POST_OPS.replace("post_id", "comment_id").replace("v_post_log", "v_comment_log")),
    "idempotent_put": _sql("""
        select 'like' as kind, cast(user_id as varchar) as id,
               cast((user_id * 31 + k * 7) % (select nd from v_n) as varchar) as key
        from v_ev where event_type = 'click'
        union
        select 'request', cast(user_id as varchar),
               cast((user_id + k * 3 + 1) % (select nu from v_n) as varchar)
        from v_ev where event_type = 'view'
        union
        select 'invite', cast(user_id as varchar),
               cast((user_id + k + 1) % (select nu from v_n) as varchar)
        from v_ev where event_type = 'click'"""),
    "delete_returning": _sql("""
        select invitee, inviter, chat_id,
               (invitee, inviter) in (select src, dst from v_friends) as is_deleted
        from v_invites"""),
    "stream_chat_delivery": _sql("""
        select l.chat_id, l.turn, l.sender, o.usr as recipient,
               (l.chat_id, l.sender) in (select chat_id, member from v_membership) as is_stored
        from v_live l join v_open_chats o using (chat_id)
        join v_membership m on m.chat_id = o.chat_id and m.member = o.usr"""),
    "stream_like_counts": _sql(
        "select post_id, count(*) as n_likes from v_like_log group by post_id"),
    "stream_presence": _sql("select id, is_online, last_seen from v_presence_now"),
    "stream_changelog": _sql(_LAST_POST_OPS),
}
