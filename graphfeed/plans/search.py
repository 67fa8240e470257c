"""Search queries and the scalar functions (sections N and H of the survey)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphfeed.functions import stemmer as P
from graphfeed.functions.scalars import chat_time, rounded, shifted_year, split_shown_article
from graphfeed.lineage import scratch_path
from graphfeed.operators import search as N
from graphfeed.plans.views_sql import rounded_sql, with_views
from graphfeed.sources.tables import Tables


def inverted_index(t: Tables, stem: bool) -> DataFrame:
    stored = N.write_index(N.build_index(t.news(), stem=stem), scratch_path(t.spark, "index"))
    return stored.drop("bucket")


# Paths of the indexes this application has written, by application, input folder and stemming.
_INDEXES: dict[tuple[str, str, bool], str] = {}


def _index_path(t: Tables, stem: bool) -> str:
    """The index over all articles: written by the first search, read by the following ones."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, stem)
    if key not in _INDEXES:
        path = scratch_path(t.spark, "index")
        N.write_index(N.build_index(t.news(), stem=stem), path)
        _INDEXES[key] = path
    return _INDEXES[key]


def keyword_search(t: Tables, stem: bool) -> DataFrame:
    return N.search(_index_path(t, stem), t.news(), t.search_queries(), stem=stem)


def token_counts(t: Tables) -> DataFrame:
    return N.tokens(t.news()).groupBy("article_id", "token").agg(F.count(F.lit(1)).alias("n"))


def scalar_functions(t: Tables) -> DataFrame:
    """One column per function the reference applies, over the articles."""
    news = t.news()
    shown = F.concat_ws(",:", "category", "headline", F.col("id").cast("string"))
    words = F.split("headline", " ")
    ms = F.col("id") * 987_654 + 1_500_000_000_000
    first, second = F.get(words, 0), F.get(words, 1)
    pair = F.filter(F.array(first, second), lambda w: w.isNotNull())
    as_json = F.to_json(F.struct(F.col("id").alias("id"), F.col("link").alias("link")))
    return news.select(
        "id",
        F.lower("headline").alias("lowered"),
        F.size(words).cast("long").alias("n_words"),
        split_shown_article(shown, 1).alias("shown_category"),
        F.regexp_replace(F.concat(F.lit("FRIEND#"), "authors"), "^FRIEND#", "").alias("stripped"),
        F.concat_ws(",: ", "category", "authors").alias("joined"),
        F.col("link").contains("7").alias("has_seven"),
        F.col("authors").startswith("author1").alias("starts"),
        F.regexp_replace("authors", "^author", "").cast("int").alias("parsed"),
        rounded(F.abs((F.col("id") - 100) / 7.0) * 3.0, 6).alias("scaled"),
        F.least(F.col("id"), F.lit(15)).alias("at_most_15"),
        chat_time(ms).alias("clock"),
        shifted_year(F.to_date("date"), 2017).alias("shifted"),
        F.array_join(F.array_sort(F.array_distinct(pair)), "|").alias("sorted_pair"),
        F.array_join(F.array_append(pair, F.lit("end")), "|").alias("appended"),
        F.array_join(F.array_remove(F.concat(pair, pair), F.lit("The")), "|").alias("removed"),
        F.array_contains(pair, "The").alias("contains_the"),
        F.get_json_object(as_json, "$.link").alias("link_from_json"),
    )


QUERIES = {
    "tokens": token_counts,
    "stem_tokens": lambda t: N.stem_tokens(N.tokens(t.news())),
    "inverted_index": lambda t: inverted_index(t, False),
    "inverted_index_stemmed": lambda t: inverted_index(t, True),
    "keyword_search": lambda t: keyword_search(t, False),
    "keyword_search_stemmed": lambda t: keyword_search(t, True),
    "scalar_functions": scalar_functions,
}


# -- the stemmer in SQL, from the same tables of endings ----------------------------------


def _has(word: str, pattern: str) -> str:
    return f"regexp_matches({word}, '{pattern}')"


def _cut(word: str, n: str) -> str:
    return f"left({word}, length({word}) - {n})"


def _ending(source: str, pattern: str) -> str:
    found = f"regexp_extract(w, '{pattern}', 1)"
    return f"""select *, {_cut('w', f'length({found})')} as fr, {found} as en from ({source})"""


def _step_sql(source: str, step: P.Step) -> str:
    replaced = "case en " + " ".join(
        f"when '{old}' then '{new}'" for old, new in step.endings.items()) + " else '' end"
    fits = "en <> ''"
    if step.condition:
        fits += f" and {_has('fr', step.condition)}"
    if "ion" in step.endings:
        fits += f" and (en <> 'ion' or {_has('fr', '[st]$')})"
    return f"""select token, case when {fits} then fr || {replaced} else w end as w
               from ({_ending(source, step.pattern)})"""


def stem_sql(source: str) -> str:
    """(token, stem) of the tokens in ``source``."""
    q = f"select token, regexp_replace(token, '(^|[aeiou])y', '\\1Y', 'g') as w from ({source})"
    q = _step_sql(q, P.STEP_1A)
    cut = f"en in ('ed', 'ing') and {_has('fr', P.HAS_VOWEL)}"
    q = f"""select token, {cut} as is_cut,
                   case when en = 'eed' and {_has('fr', P.M_ABOVE_0)} then fr || 'ee'
                        when {cut} then fr else w end as w
            from ({_ending(q, '(eed|ed|ing)$')})"""
    q = f"""select token, case when not is_cut then w when {_has('w', '(at|bl|iz)$')} then w || 'e'
                   when {_has('w', P.DOUBLE_END)} then {_cut('w', '1')}
                   when {_has('w', P.M_IS_1)} and {_has('w', P.SHORT_END)} then w || 'e'
                   else w end as w from ({q})"""
    front = _cut("w", "1")
    q = f"""select token, case when {_has('w', '[yY]$')} and {_has(front, P.HAS_VOWEL)}
                   then {front} || 'i' else w end as w from ({q})"""
    for step in (P.STEP_2, P.STEP_3, P.STEP_4):
        q = _step_sql(q, step)
    last_e = (f"{_has('w', 'e$')} and ({_has(front, P.M_ABOVE_1)} or "
              f"({_has(front, P.M_IS_1)} and not {_has(front, P.SHORT_END)}))")
    q = f"select token, case when {last_e} then {front} else w end as w from ({q})"
    last_l = f"{_has('w', 'll$')} and {_has('w', P.M_ABOVE_1)}"
    q = f"select token, case when {last_l} then {front} else w end as w from ({q})"
    return f"select token, case when length(token) < 3 then token else lower(w) end as stem from ({q})"


_STOPS = ", ".join("'" + w + "'" for w in N.STOP_WORDS)

_EXTRA = {
    "v_all_tokens": f"""
        select id as article_id, unnest(regexp_extract_all(lower(headline), '{N.TOKEN.replace("'", "''")}'))
                 as token
        from v_news""",
    "v_tokens": f"select * from v_all_tokens where token not in ({_STOPS})",
    "v_index": "select distinct token as keyword, article_id from v_tokens",
    "v_stems": stem_sql("select distinct token from v_tokens"),
    "v_stem_index": """
        select distinct stem as keyword, article_id from v_tokens join v_stems using (token)""",
    "v_query_rows": """
        select query_id, unnest(words) as token, generate_subscripts(words, 1) as pos
        from (select query_id, regexp_extract_all(lower(text), '{token}') as words
              from v_queries)""".replace("{token}", N.TOKEN.replace("'", "''")),
    "v_query_words": """
        select query_id, token as keyword, min(pos) as pos from v_query_rows
        where token <> '' group by query_id, token""",
    "v_query_stems": stem_sql("select distinct token from v_query_rows where token <> ''"),
    "v_stem_query_words": """
        select query_id, stem as keyword, min(pos) as pos
        from v_query_rows join v_query_stems using (token) group by query_id, stem""",
}


def _search_sql(index: str, words: str) -> str:
    return with_views(f"""
        select h.query_id, h.position, h.article_id, n.headline, n.authors, n.link from (
          select *, row_number() over (partition by query_id order by pos, article_id) as position
          from (select query_id, article_id, min(pos) as pos
                from {words} join {index} using (keyword) group by query_id, article_id)) h
        join v_news n on n.id = h.article_id where position <= 15""", _EXTRA)


_PAIR = "list_filter([words[1], words[2]], lambda w: w is not null)"
_MS = "(id * 987654 + 1500000000000)"

ORACLES = {
    "tokens": with_views(
        "select article_id, token, count(*) as n from v_tokens group by all", _EXTRA),
    "stem_tokens": with_views("select token, stem from v_stems", _EXTRA),
    "inverted_index": with_views("select keyword, article_id from v_index", _EXTRA),
    "inverted_index_stemmed": with_views("select keyword, article_id from v_stem_index", _EXTRA),
    "keyword_search": _search_sql("v_index", "v_query_words"),
    "keyword_search_stemmed": _search_sql("v_stem_index", "v_stem_query_words"),
    "scalar_functions": with_views(f"""
        select id, lower(headline) as lowered, len(words) as n_words,
               split_part(category || ',:' || headline || ',:' || id, ',:', 1) as shown_category,
               authors as stripped, category || ',: ' || authors as joined,
               contains(link, '7') as has_seven, starts_with(authors, 'author1') as starts,
               cast(substr(authors, 7) as integer) as parsed,
               {rounded_sql("abs((id - 100)::double / 7.0::double) * 3.0::double", 6)} as scaled,
               least(id, 15) as at_most_15,
               ltrim(strftime(epoch_ms({_MS}), '%-H:%M:%S')) as clock,
               '2017' || substr(date, 5) as shifted,
               array_to_string(list_sort(list_distinct({_PAIR})), '|') as sorted_pair,
               array_to_string(list_append({_PAIR}, 'end'), '|') as appended,
               array_to_string(list_filter(list_concat({_PAIR}, {_PAIR}),
                                           lambda w: w <> 'The'), '|') as removed,
               list_contains({_PAIR}, 'The') as contains_the, link as link_from_json
        from (select *, string_split(headline, ' ') as words from v_news)"""),
}
