"""Single operators on small inputs."""

import json

import pytest
from pyspark.sql import functions as F

from graphfeed.functions.scalars import chat_time, rounded
from graphfeed.functions.stemmer import with_stem
from graphfeed.operators import changelog, chat, search, social, validation
from graphfeed.sources import articles, items, ranks


def test_bad_lines_are_set_aside(spark, tmp_path):
    good = {"category": "A", "headline": "h", "authors": "", "link": "l",
            "short_description": "d", "date": "2018-01-01", "extra": 1}
    lines = [json.dumps(good), "{broken", json.dumps({**good, "category": "B"})]
    (tmp_path / "news.json").write_text("\n".join(lines) + "\n")
    read, bad = articles.read_articles(spark, str(tmp_path))
    assert sorted(r.category for r in read.collect()) == ["A", "B"]
    assert [r.line for r in bad.collect()] == ["{broken"]
    numbered = articles.read_with_line_ids(spark, str(tmp_path)).collect()
    assert {r.category: r.id for r in numbered} == {"A": 0, "B": 2}


def test_line_ids_over_many_blocks(spark, tmp_path):
    for f in range(3):
        body = "".join(json.dumps({"link": f"{f}-{i}"}) + "\n" for i in range(400))
        (tmp_path / f"part-{f}.json").write_text(body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = {r.link: r.id for r in articles.read_with_line_ids(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {f"{f}-{i}": f * 400 + i for f in range(3) for i in range(400)}


def test_split_entities_strips_the_whole_mark(spark):
    log = spark.createDataFrame(
        [("a", "user"), ("a", "FRIEND#b"), ("a", "articlelike1234"), ("a", "POST#9"),
         ("a", "GROUP#b,7"), ("a", "article_recs")], "id string, user_relation string")
    parts = items.split_entities(log)
    assert [tuple(r) for r in parts["friend"].collect()] == [("a", "b")]
    assert [tuple(r) for r in parts["articlelike"].collect()] == [("a", "1234")]
    assert [tuple(r) for r in parts["group_invite"].collect()] == [("a", "b,7")]
    assert [r.id for r in parts["user"].collect()] == ["a"]


def test_rank_table_versions(spark, tmp_path):
    path = str(tmp_path / "recs")

    def table(*rows):
        return spark.createDataFrame(list(rows), ranks.RECS)

    ranks.write_recs(table(("a", 1, 0.5), ("a", 2, 0.25)), path)
    got = ranks.write_recs(table(("a", 2, 0.75), ("b", 3, 1.0)), path, mode="upsert")
    assert sorted(map(tuple, got.collect())) == [("a", 1, 0.5), ("a", 2, 0.75), ("b", 3, 1.0)]
    got = ranks.write_recs(table(("c", 9, 1.0)), path)
    assert list(map(tuple, got.collect())) == [("c", 9, 1.0)]
    assert ranks.versions(spark, path) == [1, 2, 3]


def test_an_upsert_writes_only_the_buckets_it_touches(spark, tmp_path):
    path = str(tmp_path / "recs")
    old = spark.range(400).selectExpr("concat('u', id % 40) label", "id article_id", "1.0D article_rank")
    ranks.write_recs(old, path, rows_per_bucket=25)
    buckets, before = ranks.bucket_folders(spark, path)
    assert buckets == 16 and len(before) > 8
    # a key twice: the higher rank is put
    new = spark.createDataFrame([("u3", 3, 5.0), ("u3", 3, 7.0), ("u3", 900, 2.0)], ranks.RECS)
    got = ranks.write_recs(new, path, mode="upsert")
    _, after = ranks.bucket_folders(spark, path)
    assert sum(before[b] != after[b] for b in before) == 1
    want = {(r.label, r.article_id): 1.0 for r in old.collect()} | {("u3", 3): 7.0, ("u3", 900): 2.0}
    assert {(r.label, r.article_id): r.article_rank for r in got.collect()} == want and got.count() == 401
    ranks.drop_old(spark, path)
    assert ranks.read_recs(spark, path).count() == 401
    ranks.write_recs(new.limit(0), path)
    ranks.drop_old(spark, path)
    assert ranks.read_recs(spark, path).count() == 0 and ranks.versions(spark, path) == [3]
    assert ranks.write_recs(new, path, mode="upsert").count() == 2


# pairs from the published description of the algorithm
STEMS = dict(p.split(">") for p in """
    caresses>caress ponies>poni ties>ti cats>cat feed>feed agreed>agre plastered>plaster bled>bled
    motoring>motor sing>sing conflated>conflat troubled>troubl sized>size hopping>hop tanned>tan
    falling>fall hissing>hiss fizzed>fizz failing>fail filing>file happy>happi sky>sky
    relational>relat conditional>condit rational>ration valenci>valenc digitizer>digit
    operator>oper feudalism>feudal decisiveness>decis hopefulness>hope formaliti>formal
    triplicate>triplic formative>form formalize>formal electrical>electr hopeful>hope
    goodness>good revival>reviv allowance>allow inference>infer airliner>airlin adjustable>adjust
    defensible>defens irritant>irrit replacement>replac adjustment>adjust dependent>depend
    adoption>adopt communism>commun activate>activ effective>effect bowdlerize>bowdler
    probate>probat rate>rate cease>ceas controll>control roll>roll generalizations>gener
    oscillators>oscil yes>ye playing>plai is>is
""".split())


def test_stems(spark):
    frame = spark.createDataFrame([(w,) for w in STEMS], "token string")
    got = {r.token: r.stem for r in with_stem(frame, "token", "stem").collect()}
    assert got == STEMS


def test_search_cut_is_exact(spark):
    """A frequent first word, overlapping lists, and an article without a row."""
    index = [("big", a) for a in range(0, 200)] + [("rare", a) for a in (3, 500, 501)] + [
        ("low", a) for a in range(0, 20)]
    news = spark.createDataFrame([(a, f"h{a}", "", "") for a in range(600)],
                                 "id long, headline string, authors string, link string")
    texts = {1: "rare big", 2: "low rare", 3: "big low", 4: "nothing  rare", 5: "Rare"}
    queries = spark.createDataFrame(list(texts.items()), "query_id long, text string")
    got = {}
    frame = spark.createDataFrame(index, "keyword string, article_id long")
    for r in search.search(frame, news, queries, n=5, stem=False).collect():
        got.setdefault(r.query_id, {})[r.position] = r.article_id
    for query, text in texts.items():
        seen = {}
        for place, word in enumerate(text.lower().split(" ")):
            for keyword, article in index:
                if keyword == word:
                    seen.setdefault(article, place)
        best = sorted(seen, key=lambda a: (seen[a], a))[:5]
        assert [got[query][i] for i in sorted(got[query])] == best


def test_search_reads_an_index_that_grows_by_segments(spark, tmp_path):
    path = str(tmp_path / "index")
    texts = [f"alpha{i % 50} word{i} common" for i in range(300)]
    news = spark.createDataFrame([(i, text, "", "") for i, text in enumerate(texts)],
                                 "id long, headline string, authors string, link string")
    queries = spark.createDataFrame([(1, "alpha7 common"), (2, "word299"), (3, "absent")],
                                    "query_id long, text string")

    def files():
        return {str(f) for f in (tmp_path / "index").rglob("*.parquet")}

    def found(index):
        return sorted(map(tuple, search.search(index, news, queries, n=10, stem=False).select(
            "query_id", "position", "article_id").collect()))

    search.write_index(search.build_index(news.filter("id < 200"), stem=False), path, rows_per_bucket=100)
    first = files()
    buckets, _ = search.segments(spark, path)
    assert buckets > 2
    for low in range(200, 300, 20):  # the last 20 come once more with the next
        part = news.filter(f"id >= {low - 20} and id < {low + 20}")
        search.add_to_index(search.build_index(part, stem=False), path, fan=4)
        assert first <= files()
    assert len(search.segments(spark, path)[1]) <= 4
    whole = search.build_index(news, stem=False)
    assert found(path) == found(whole)
    asked = spark.createDataFrame([("word299",)], "keyword string")
    plan = search.postings_of(spark, path, asked)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert set(search.read_index(spark, path).drop("bucket").distinct().collect()) == set(whole.collect())


def test_autocomplete_by_rarest_part(spark):
    names = [f"user{i}x{i * 7 % 101}" for i in range(400)] + ["useruser", "a", "zz"]
    wanted = ["u", "er", "ser", "user", "user1", "x100", "userx", "zz", "zzz", "useruseruser", "r9x6"]
    users = spark.createDataFrame([(v,) for v in names * 2], "id string")
    terms = spark.createDataFrame([(v,) for v in wanted] + [(None,)], "term string")
    want = sorted((t, v) for t in wanted for v in names if t in v)
    assert sorted(map(tuple, social.match_users(users, terms).collect())) == want
    first = sorted((t, v) for t in wanted for v in sorted(v for v in names if t in v)[:5])
    got = social.match_users(users, terms, n=5).select("term", "id")
    assert sorted(map(tuple, got.collect())) == first


def test_autocomplete_is_case_sensitive_and_skips_empty(spark):
    users = spark.createDataFrame([("Anna",), ("anna",), ("nan",)], "id string")
    terms = spark.createDataFrame([("an",), ("",), ("nna",), ("far too long a term",)],
                                  "term string")
    got = sorted(map(tuple, social.match_users(users, terms).select("term", "id").collect()))
    assert got == [("an", "anna"), ("an", "nan"), ("nna", "Anna"), ("nna", "anna")]


def test_friend_symmetry_and_removal(spark):
    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "c"), ("a", "d")],
                                  "src string, dst string")
    both = social.symmetric(pairs)
    assert sorted(map(tuple, both.collect())) == [("a", "b"), ("a", "d"), ("b", "a"), ("d", "a")]
    gone = spark.createDataFrame([("d", "a")], "src string, dst string")
    assert sorted(map(tuple, social.remove_friends(both, gone).collect())) == [
        ("a", "b"), ("b", "a")]


def test_member_sets(spark):
    rows = [(1, "a"), (1, "b"), (2, "b"), (2, "a"), (3, "a"), (4, "a"), (4, "b"), (4, "c")]
    membership = spark.createDataFrame(rows, "chat_id long, member string")
    got = {r.chat_id: (r.first_chat, r.n_chats) for r in chat.duplicate_chats(membership).collect()}
    assert got == {1: (1, 2), 2: (1, 2)}
    invites = spark.createDataFrame(
        [("c", "a", 1), ("c", "a", 2), ("b", "a", 3), ("d", "a", 1), ("d", "b", 2), ("a", "b", 1)],
        "invitee string, inviter string, chat_id long")
    accepted = {(r.invitee, r.chat_id): r
                for r in chat.accept_group_invites(invites, membership).collect()}
    assert accepted[("c", 1)].entered_chat == accepted[("c", 2)].entered_chat == "4"
    assert accepted[("b", 3)].entered_chat == "1"
    assert accepted[("a", 1)].entered_chat == "1" and not accepted[("a", 1)].is_new
    new = accepted[("d", 1)]
    assert new.is_new and new.entered_chat == accepted[("d", 2)].entered_chat
    frame = chat.accept_group_invites(invites, membership)
    made = chat.new_group_members(frame, membership).collect()
    assert sorted(r.member for r in made) == ["a", "b", "d"]


def test_leaving_keeps_an_empty_chat(spark):
    membership = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b")],
                                       "chat_id long, member string")
    leavers = spark.createDataFrame([(1, "a"), (2, "b")], "chat_id long, member string")
    got = sorted(map(tuple, chat.leave(membership, leavers).collect()))
    assert got == [(1, None), (2, "a")]


def test_folds(spark):
    log = spark.createDataFrame(
        [("a", 1, 1, "x", None), ("a", 2, 2, None, "p"), ("a", 3, 3, "y", None),
         ("a", 4, 4, "y", None)],
        "id string, op_ts long, op_id long, email string, affiliation string")
    assert changelog.insert_if_absent(log, "id").first().email == "x"
    assert tuple(changelog.partial_update(log, "id", ["email", "affiliation"]).first()) == (
        "a", "y", "p")
    for hot_rows in (None, 1):
        posts = changelog.profile_change_posts(log, hot_rows).collect()
        assert [(r.ts, r.text) for r in posts] == [(3, "My new email is y!")]


def test_last_operation_wins(spark):
    log = spark.createDataFrame(
        [(1, 1, 1, "create", "a"), (1, 2, 2, "delete", None), (2, 1, 3, "create", "b"),
         (2, 5, 4, "edit", "c"), (2, 4, 5, "delete", None)],
        "post_id long, op_ts long, op_id long, op string, text string")
    assert [(r.post_id, r.text) for r in changelog.fold_edits(log, "post_id").collect()] == [
        (2, "c")]


def test_validation(spark):
    forms = spark.createDataFrame(
        [("u", "p", "f", "s", "e", "1", "2", "3", "a", ["x", "y"]),
         ("u", "p", "f", "s", "e", "1", "2", "3", "a", ["x"]),
         ("u", "", "f", "s", "e", "1", "2", "3", "", None)],
        ", ".join(f"{c} string" for c in validation.SIGNUP_FIELDS) + ", interests array<string>")
    good, bad = validation.validate_signups(forms)
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["interests", "password"]


def test_scalars(spark):
    row = spark.range(1).select(
        chat_time(F.lit(1_500_000_000_000)).alias("t"), chat_time(F.lit(86_399_999)).alias("u"),
        rounded(F.lit(0.000234375), 8).alias("r")).first()
    assert (row.t, row.u, row.r) == ("2:40:00", "23:59:59", 0.00023438)


def test_scan_is_pruned(tables):
    plan = tables.likes()._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,click)" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string,props:string>" in plan


def test_members_through_chains_of_versions(spark):
    membership = spark.createDataFrame([(1, "a"), (1, "b"), (2, "z")], "chat_id long, member string")
    versions = spark.createDataFrame(
        [("n1", "1", "c"), ("n2", "n1", "d"), ("n3", "n2", "e"), ("other", "2", "y"), ("n1b", "1", "f")],
        "chat string, parent string, added string")
    asked = spark.createDataFrame([("n3",), ("n1b",), ("2",), ("none",), ("n3",)], "chat string")
    got = {}
    for row in chat.members_of(asked, versions, membership).collect():
        got.setdefault(row.chat, []).append(row.member)
    assert {c: sorted(m) for c, m in got.items()} == {
        "n3": list("abcde"), "n1b": list("abf"), "2": ["z"]}
