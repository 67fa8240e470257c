"""Chats, their members, messages and invitations.

Membership is one row per (chat, member). Two chats with the same members are found by a
fingerprint of the member set: the number of members and the exclusive-or of four 60-bit
pieces of each member's keyed SHA-256. It is summed per chat without collecting the members,
and adding one member to a set is one operation on the fingerprint. The key is drawn anew by
each process and never stored, so nobody can choose names whose fingerprints agree; unequal
sets agree by chance with probability 2^-240.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphfeed.lineage import stored
from graphfeed.operators.skew import number_within

_PIECES = range(4)
_KEY = secrets.token_hex(32)
SET_KEY = ["n_members", *[f"h{i}" for i in _PIECES]]


def _hash_piece(member: str, i: int) -> Column:
    digits = F.substring(F.sha2(F.concat(F.lit(_KEY), F.col(member)), 256), 15 * i + 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def members_of(chats: DataFrame) -> DataFrame:
    """(chat_id, member) rows of chats that hold their members as an array."""
    return chats.select("chat_id", F.explode("members").alias("member")).distinct()


def user_chats(membership: DataFrame) -> DataFrame:
    return membership.select(F.col("member").alias("usr"), "chat_id")


def chat_members(membership: DataFrame) -> DataFrame:
    """Members per chat with the size of the chat."""
    sizes = membership.groupBy("chat_id").agg(F.count(F.lit(1)).alias("n_members"))
    return membership.join(sizes, ["chat_id"])


def chat_history(messages: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Messages in append order."""
    return number_within(messages, ["chat_id"], [F.col("turn").asc()], hot_rows=hot_rows)


def append_messages(
    messages: DataFrame, new: DataFrame, membership: DataFrame, hot_rows: int | None = None
) -> DataFrame:
    """New messages of members behind the old ones; others are not stored.

    ``new`` has (chat_id, sender, op_id, text); the order among new ones is op_id.
    """
    allowed = new.join(membership.withColumnRenamed("member", "sender"), ["chat_id", "sender"], "left_semi")
    old_rows = messages.select(
        "chat_id", F.lit(0).alias("_new"), F.col("turn").alias("_at"), "text"
    )
    new_rows = allowed.select(
        "chat_id", F.lit(1).alias("_new"), F.col("op_id").alias("_at"), "text"
    )
    order = [F.col("_new").asc(), F.col("_at").asc()]
    return number_within(
        old_rows.unionByName(new_rows), ["chat_id"], order, hot_rows=hot_rows
    ).select("chat_id", "position", "text")


def invite_inbox(invites: DataFrame) -> DataFrame:
    private = invites.filter(F.col("chat_id").isNull())
    return private.select("invitee", "inviter").distinct()


def group_invite_inbox(invites: DataFrame) -> DataFrame:
    return invites.filter(F.col("chat_id").isNotNull()).select(
        "invitee", "inviter", "chat_id"
    ).distinct()


def valid_invites(attempts: DataFrame, friends: DataFrame, presence: DataFrame) -> DataFrame:
    """Attempts (usr, friend) whose target is a friend and online."""
    pairs = friends.select(F.col("src").alias("usr"), F.col("dst").alias("friend"))
    online = presence.filter("is_online").select(F.col("id").alias("friend"))
    known = attempts.join(pairs, ["usr", "friend"], "left_semi")
    return known.join(online, ["friend"], "left_semi")


def chats_by_ids(membership: DataFrame, ids: DataFrame) -> DataFrame:
    wanted = ids.select("chat_id").filter(F.col("chat_id").isNotNull()).distinct()
    return membership.join(wanted, ["chat_id"], "left_semi")


# -- member sets ------------------------------------------------------------------------


def set_keys(membership: DataFrame, owner: str = "chat_id") -> DataFrame:
    """Fingerprint of the member set of each ``owner``."""
    return membership.groupBy(owner).agg(
        F.count(F.lit(1)).alias("n_members"),
        *[F.bit_xor(_hash_piece("member", i)).alias(f"h{i}") for i in _PIECES],
    )


def _representatives(keys: DataFrame) -> DataFrame:
    """The smallest chat id per member set and how many chats have the set."""
    return keys.groupBy(*SET_KEY).agg(
        F.min("chat_id").alias("first_chat"), F.count(F.lit(1)).alias("n_chats")
    )


def duplicate_chats(membership: DataFrame) -> DataFrame:
    """Chats that share their member set with others, with the first such chat."""
    keys = set_keys(membership)
    groups = _representatives(keys)
    joined = keys.join(groups.filter(F.col("n_chats") > 1), SET_KEY)
    return joined.select("first_chat", "chat_id", "n_members", "n_chats")


def find_matching_chats(membership: DataFrame, candidates: DataFrame) -> DataFrame:
    """For each candidate set (set_id, member): the first chat with it and their number."""
    wanted = set_keys(candidates.distinct(), "set_id")
    found = wanted.join(_representatives(set_keys(membership)), SET_KEY)
    return found.select("set_id", "first_chat", "n_chats")


def accept_invites(invites: DataFrame, membership: DataFrame) -> DataFrame:
    """Accept private invites: the chat of the two, or a new one named by its members."""
    inbox = invite_inbox(invites)
    pair = [F.least("invitee", "inviter"), F.greatest("invitee", "inviter")]
    asked = inbox.withColumn("n_members", F.lit(2).cast("long"))
    for i in _PIECES:
        asked = asked.withColumn(
            f"h{i}", _hash_piece("invitee", i).bitwiseXOR(_hash_piece("inviter", i))
        )
    known = _representatives(set_keys(membership)).filter(F.col("n_members") == 2)
    found = asked.join(known, SET_KEY, "left")
    new_id = F.sha2(F.concat_ws(",", *pair), 256)
    return found.select(
        "invitee",
        "inviter",
        F.coalesce(F.col("first_chat").cast("string"), new_id).alias("chat_id"),
        F.col("first_chat").isNull().alias("is_new"),
    )


def new_chat_members(accepted: DataFrame) -> DataFrame:
    """(chat_id, member) rows of the chats that ``accept_invites`` has to create."""
    both = F.explode(F.array("invitee", "inviter")).alias("member")
    return accepted.filter("is_new").select("chat_id", both).distinct()


def open_invites(invites: DataFrame, accepted: DataFrame) -> DataFrame:
    """Private invites that are still open: an accepted one goes, and so does its opposite."""
    done = accepted.select("invitee", "inviter")
    both_ways = done.unionByName(done.select(
        F.col("inviter").alias("invitee"), F.col("invitee").alias("inviter"))).distinct()
    return invite_inbox(invites).join(both_ways, ["invitee", "inviter"], "left_anti")


def accept_group_invites(invites: DataFrame, membership: DataFrame) -> DataFrame:
    """Accept group invites: the chat whose members are the old ones and the invitee.

    The fingerprint of the larger set follows from that of the chat. A new chat is named
    after the first (chat, invitee) that leads to its member set.
    """
    inbox = group_invite_inbox(invites)
    keys = set_keys(membership)
    inside = membership.select("chat_id", F.col("member").alias("invitee"), F.lit(True).alias("_in"))
    asked = inbox.join(keys, ["chat_id"])
    asked = asked.join(inside, ["chat_id", "invitee"], "left")
    is_in = F.col("_in").isNotNull()
    for i in _PIECES:
        larger = F.col(f"h{i}").bitwiseXOR(_hash_piece("invitee", i))
        asked = asked.withColumn(f"h{i}", F.when(is_in, F.col(f"h{i}")).otherwise(larger))
    asked = asked.withColumn(
        "n_members", F.col("n_members") + F.when(is_in, 0).otherwise(1)
    ).drop("_in")
    found = asked.join(_representatives(keys), SET_KEY, "left")
    origin = F.struct("chat_id", "invitee")
    named = found.filter(F.col("first_chat").isNull()).groupBy(*SET_KEY).agg(
        F.min(origin).alias("_origin")
    )
    found = found.join(named, SET_KEY, "left")
    new_id = F.sha2(F.concat_ws(":", F.col("_origin.chat_id").cast("string"),
                                F.col("_origin.invitee")), 256)
    return found.select(
        "invitee",
        "inviter",
        "chat_id",
        F.coalesce(F.col("first_chat").cast("string"), new_id).alias("entered_chat"),
        F.col("first_chat").isNull().alias("is_new"),
        "n_members",
        F.col("_origin.chat_id").alias("origin_chat"),
        F.col("_origin.invitee").alias("origin_invitee"),
    )


def new_group_members(accepted: DataFrame, membership: DataFrame) -> DataFrame:
    """Member rows of the chats that ``accept_group_invites`` has to create."""
    made = (
        accepted.filter("is_new")
        .select("entered_chat", F.col("origin_chat").alias("chat_id"), "origin_invitee")
        .distinct()
    )
    old = membership.join(made.select("chat_id", "entered_chat"), ["chat_id"]).select(
        "entered_chat", "member"
    )
    joining = made.select("entered_chat", F.col("origin_invitee").alias("member"))
    return old.unionByName(joining).distinct()


def chat_versions(accepted: DataFrame) -> DataFrame:
    """(chat, parent, added): a row for each chat that ``accept_group_invites`` has to create.

    Its members are those of ``parent`` and ``added``; they are not copied. A parent may be such a
    chat itself.
    """
    return (
        accepted.filter("is_new")
        .select(F.col("entered_chat").alias("chat"), F.col("origin_chat").cast("string").alias("parent"),
                F.col("origin_invitee").alias("added"))
        .distinct()
    )


def members_of(asked: DataFrame, versions: DataFrame, membership: DataFrame) -> DataFrame:
    """(chat, member) of the asked chats, resolved through their versions.

    A round goes one version back for all chats at once; a chat whose parent is a stored one
    has arrived. Only the asked chats' members are read.
    """
    steps = versions.select(F.col("chat").alias("_at"), "parent", "added")
    at = stored(asked.select("chat").distinct().withColumn("_at", F.col("chat")), "versions")
    roots, added = at, []
    while True:
        back = stored(at.join(steps, ["_at"]), "versions")
        if back.isEmpty():
            break
        added.append(back.select("chat", F.col("added").alias("member")))
        at = back.select("chat", F.col("parent").alias("_at"))
        roots = roots.unionByName(at)
    known = membership.select(F.col("chat_id").cast("string").alias("_at"), "member")
    found = roots.join(known, ["_at"]).select("chat", "member")
    for rows in added:
        found = found.unionByName(rows)
    return found.distinct()


def leave(membership: DataFrame, leavers: DataFrame) -> DataFrame:
    """Membership after leaving; a chat without members keeps one row with null."""
    gone = leavers.select("chat_id", "member").distinct()
    left = membership.join(gone, ["chat_id", "member"], "left_anti")
    chats = membership.select("chat_id").distinct()
    emptied = chats.join(left.select("chat_id").distinct(), "chat_id", "left_anti")
    return left.unionByName(emptied, allowMissingColumns=True)
