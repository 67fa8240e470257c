"""Secrets in texts, told from examples by how many owners share them.

Matches are found by regular expressions inside each row. Places follow from the pieces
between matches: ``split`` and ``regexp_extract_all`` walk the same matches. Candidates
(base matches and long mixed-character runs) are counted over the whole corpus by distinct
repositories and owners. A value that at most ``max_owners`` owners hold looks live; one that
many owners hold is a widely copied example. Runs that look live are added to the base spans.

Only DataFrame functions. Counting combines before each shuffle, first by (value, repository,
owner) and then by value, so a value that sits in a third of all rows is a small row early on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphfeed.lineage import stored

# The base patterns, the characters each match needs, and the pattern of added runs.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
          r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # a greedy run, so the same as any run of which shorter ones are dropped
MIXED = r"[A-Za-z0-9_-]{20,}"
KINDS = ["assign", "access", "hex"]
MAX_OWNERS = 2
MASK = "[secret]"


def _places(text: Column, pattern: str) -> Column:
    """(start, end, match) of all leftmost non-overlapping matches, in code points."""
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def step(acc: Column, pair: Column) -> Column:
        start = acc.at + F.length(pair.piece)
        end = start + F.length(pair.match)
        return F.struct(end.alias("at"), F.array_append(acc.found, F.struct(
            start.alias("start"), end.alias("end"), pair.match.alias("match"))).alias("found"))

    pairs = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.struct(
        p.alias("piece"), m.alias("match")))
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))
    return F.aggregate(pairs, start, step, lambda acc: acc.found)


def _kind(text: Column, kind: str, pattern: str, holds, value) -> Column:
    """Spans of one kind as (start, rank of the kind, kind, end, hash of the value)."""
    kept = F.filter(_places(text, pattern), lambda m: holds(m.match))
    order = (KINDS + ["owned"]).index(kind)
    return F.transform(kept, lambda m: F.struct(
        m.start.alias("start"), F.lit(order).alias("rank"), F.lit(kind).alias("kind"),
        m.end.alias("end"), F.sha2(value(m.match), 256).alias("value")))


NO_SPANS = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def spans_of(text: Column) -> Column:
    """All candidates of a text. Rows without any are told by one cheap pattern."""
    body = F.coalesce(text, F.lit(""))

    def secret(match: Column) -> Column:
        return F.regexp_extract(match, ASSIGN, 2)

    base = F.concat(
        _kind(body, "assign", ASSIGN, lambda m: F.length(secret(m)) >= 12, secret),
        _kind(body, "access", ACCESS, lambda m: F.length(m) >= 18, lambda m: m),
        _kind(body, "hex", HEX, lambda m: F.length(m) >= 16, lambda m: m),
        _kind(body, "owned", MIXED, lambda m: m.rlike("[0-9]") & m.rlike("[a-z]")
              & m.rlike("[A-Z]"), lambda m: m),
    )
    some = body.rlike(
        r"[Pp][Aa][Ss][Ss][Ww]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk]"
        r"|AKIA[A-Z0-9]{14}|[0-9a-f]{16}|[A-Za-z0-9_-]{20}")
    return F.when(some, F.sort_array(base)).otherwise(F.array().cast(NO_SPANS))


def ownership(found: DataFrame) -> DataFrame:
    """(value, n_rows, n_repos, n_owners) of every candidate, by the hash of its value.

    ``found`` has ``_repo``, ``_owner`` and ``_spans``. A null repository or owner is one of
    its own.
    """
    each = (
        found.select("_repo", "_owner", F.explode(F.array_distinct(
            F.transform("_spans", lambda s: s.value))).alias("value"))
        .groupBy("value", "_owner", "_repo").agg(F.count(F.lit(1)).alias("n_rows"))
    )
    by_owner = each.groupBy("value", "_owner").agg(
        F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_repos"))
    return by_owner.groupBy("value").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_repos").alias("n_repos"),
        F.count(F.lit(1)).alias("n_owners"))


def judged(found: DataFrame, max_owners: int = MAX_OWNERS) -> DataFrame:
    """(_row, spans) of the rows of ``found`` with a candidate; each span says if it looks live.

    Base spans always stay. An added run stays if it looks live and touches no base span.
    """
    each = found.select("_row", F.explode("_spans").alias("_span")).withColumn(
        "value", F.col("_span.value"))
    owned = F.filter("_all", lambda s: (s["rank"] < len(KINDS)) | (s.live & ~F.exists(
        F.filter("_all", lambda b: b["rank"] < len(KINDS)),
        lambda b: (b.start < s.end) & (s.start < b.end))))
    return (
        each.join(ownership(found), "value")
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list(F.struct(
            "_span.start", "_span.rank", "_span.kind", "_span.end",
            (F.col("n_owners") <= max_owners).alias("live")))).alias("_all"))
        .select("_row", owned.alias("spans"))
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans by start, then kind as listed, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def scan(docs: DataFrame, repo: Column, owner: Column, id_col: str = "doc_id",
         text: str = "text", max_owners: int = MAX_OWNERS) -> DataFrame:
    """Per row of ``docs``: id, ``_spans`` (candidates), ``spans`` (kept, with ``live``).

    Null and empty texts have none. Rows are told apart by place, so repeated rows and null
    ids each give a row of their own. Only ids, owners, places and hashes are stored.
    """
    found = stored(
        docs.select(F.col(id_col).alias("_id"), repo.alias("_repo"), owner.alias("_owner"),
                    spans_of(F.col(text)).alias("_spans"))
        .withColumn("_row", F.monotonically_increasing_id()), "secret-candidates")
    kept = judged(found.filter(F.size("_spans") > 0), max_owners)
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,live:boolean>>")
    return found.join(kept, "_row", "left").select(
        F.col("_id").alias(id_col), "_spans", F.coalesce("spans", none).alias("spans"))


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """``text`` with each run of touching spans replaced by ``mask``; spans by start."""
    def step(acc: Column, s: Column) -> Column:
        fresh = s.start >= acc.at
        piece = F.concat(F.substring(text, acc.at + 1, s.start - acc.at), F.lit(mask))
        return F.struct(
            F.when(fresh, F.concat(acc.out, piece)).otherwise(acc.out).alias("out"),
            F.greatest(acc.at, s.end).alias("at"))

    rest = F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step)
    return F.concat(rest.out, F.substring(text, rest.at + 1, F.length(text)))


def mask_live(docs: DataFrame, repo: Column, owner: Column, text: str = "text",
              max_owners: int = MAX_OWNERS, mask: str = MASK) -> DataFrame:
    """``docs`` with secrets that look live masked; rows without candidates pass as they are."""
    flagged = docs.select(F.struct(*docs.columns).alias("_doc"), repo.alias("_repo"),
                          owner.alias("_owner"), spans_of(F.col(text)).alias("_spans"))
    hits = stored(flagged.filter(F.size("_spans") > 0)
                  .withColumn("_row", F.monotonically_increasing_id()), "secret-rows")
    live = judged(hits, max_owners).select(
        "_row", F.filter("spans", lambda s: s.live).alias("spans"))
    new_text = masked(F.col(f"_doc.{text}"), F.col("spans"), mask)
    changed = hits.join(live, "_row").select(F.col("_doc").withField(text, new_text).alias("_doc"))
    same = flagged.filter(F.size("_spans") == 0).select("_doc")
    return same.unionAll(changed).select("_doc.*")
