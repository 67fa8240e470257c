"""Graph, ranking and recommendation queries (sections E, F1-F2, D1 of the survey)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphfeed.functions.scalars import rounded
from graphfeed.lineage import stored
from graphfeed.operators import edges as E
from graphfeed.operators import mass as M
from graphfeed.operators import ranking as R
from graphfeed.operators import recommend
from graphfeed.plans.views_sql import rounded_sql, with_views
from graphfeed.sources.tables import Tables

# -- Spark side -------------------------------------------------------------------------


def graph_edges(t: Tables) -> DataFrame:
    return E.all_edges(
        E.article_category_edges(t.news()),
        E.interest_edges(t.interests()),
        E.like_edges(t.likes()),
        E.friend_edges(t.friends()),
    )


def graph_weights(t: Tables) -> DataFrame:
    return E.weighted_edges(stored(graph_edges(t), "edges"))


def _rounded(ranks: DataFrame, column: str = "value") -> DataFrame:
    return ranks.withColumn(column, rounded(F.col(column), 8))


def rec_ranks(t: Tables) -> DataFrame:
    """The written rank table that the recommendation queries start from."""
    return stored(R.adsorption(graph_weights(t), E.seeds(t.interests())), "rank-table")


def _first_pass(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Seeds, weighted edges and the ranks after pass 1."""
    seeds = stored(E.seeds(t.interests()), "seeds")
    weights = stored(graph_weights(t), "weights")
    return seeds, weights, stored(R.run_passes(weights, seeds, passes=1)[0], "ranks")


def _second_mass(t: Tables, upto: str) -> tuple[M.Mass, DataFrame]:
    """The named step of pass 2 on mass in two factors, from the ranks after pass 1, and the edges."""
    seeds, weights, first = _first_pass(t)
    mass = M.moved(weights, first)
    if upto != "sum_labels":
        mass = M.normalise_by_label(mass)
        if upto != "normalise_by_label":
            mass = M.drop_self(mass)
            if upto != "drop_self":
                mass = M.reseed(mass, seeds)
    return mass, weights


def _second_pass(t: Tables, upto: str) -> DataFrame:
    """The named intermediate of pass 2, written out."""
    if upto == "prune":
        return _rounded(M.prune(_second_mass(t, "reseed")[0], R.CLUSTER.min_weight))
    return _rounded(M.written(_second_mass(t, upto)[0]))


def _asked_mass(t: Tables, upto: str) -> DataFrame:
    """The same intermediates for each user's own neighbourhood."""
    mass, weights = _second_mass(t, upto)
    return _rounded(M.at(mass, M.own_neighbourhood(weights)))


def convergence(t: Tables) -> DataFrame:
    """The change of each pass from the second to the one that ends the loop."""
    _, history = R.run_passes(graph_weights(t), E.seeds(t.interests()))
    return _rounded(t.spark.createDataFrame(history, "pass long, max_change double"), "max_change")


def social_rank(t: Tables, variant: R.Variant = R.CLUSTER) -> DataFrame:
    ranks = R.adsorption(graph_weights(t), E.seeds(t.interests()), variant)
    return _rounded(ranks, "article_rank")


def _recs(t: Tables, order: str) -> DataFrame:
    news = t.news()
    recs = recommend.with_article(recommend.top_recs(rec_ranks(t), news, 15, order), news)
    return recs.select(
        "label", "position", "article_id", "category", "headline", "link",
        rounded(F.col("article_rank"), 8).alias("article_rank"),
    )


# -- SQL side ---------------------------------------------------------------------------

_TAGS = "abcdefghijklmno"

def _pass_views(number: int, start: str, variant: R.Variant) -> dict[str, str]:
    """CTEs of one pass; the last one is named v_r<letter> for pass 1 = a, 2 = b, ..."""
    tag = "abcdefghijklmno"[number - 1]
    keep = f"round(value, 12) > {variant.min_weight}"
    summed = f"""
        select e.dst_type as node_type, e.dst as node, r.label, sum(r.value * e.weight) as value
        from v_weighted e join {start} r on r.node_type = e.src_type and r.node = e.src
        group by all"""
    if variant.prune_first:
        summed = f"select * from ({summed}) where {keep}"
    after = "" if variant.prune_first else f"where {keep}"
    return {
        f"v_p_{tag}": summed,
        f"v_norm_{tag}": f"""
            select node_type, node, label, value / sum(value) over (partition by label) as value
            from v_p_{tag}""",
        f"v_noself_{tag}": f"""
            select * from v_norm_{tag} where not (node_type = 'u' and node = label)""",
        f"v_seeded_{tag}": f"""
            select * from v_noself_{tag}
            union all select node_type, node, label, value from v_seeds""",
        f"v_r_{tag}": f"select * from v_seeded_{tag} {after}",
    }


def passes_sql(body: str, passes: int, variant: R.Variant = R.CLUSTER) -> str:
    extra: dict[str, str] = {}
    start = "v_seeds"
    for number in range(1, passes + 1):
        extra.update(_pass_views(number, start, variant))
        start = f"v_r_{_TAGS[number - 1]}"
    return with_views(body, extra)


def _change_sql(number: int) -> str:
    """Pass and largest change over (article, label) against the pass before."""
    new, old = _TAGS[number - 1], _TAGS[number - 2]
    return f"""select {number} as pass,
          max(abs(coalesce(x.value, 0) - coalesce(y.value, 0))) as max_change
        from (select * from v_r_{new} where node_type = 'a') x
        full join (select * from v_r_{old} where node_type = 'a') y using (node, label)"""


def converged_sql(body: str, variant: R.Variant = R.CLUSTER) -> str:
    """``body`` over all passes; v_last has the ranks of the pass that ends the loop.

    That is the first one from the second on whose change is within the tolerance, or the
    last one allowed. SQL has no early end, so all passes are worked out.
    """
    numbers = range(1, variant.max_passes + 1)
    extra: dict[str, str] = {}
    start = "v_seeds"
    for number in numbers:
        extra.update(_pass_views(number, start, variant))
        start = f"v_r_{_TAGS[number - 1]}"
    extra["v_changes"] = "\nunion all ".join(_change_sql(n) for n in numbers if n > 1)
    extra["v_stop"] = f"""select coalesce(min(pass), {variant.max_passes}) as stop
                         from v_changes where max_change <= {variant.tolerance}"""
    extra["v_last"] = "\nunion all ".join(
        f"select * from v_r_{_TAGS[n - 1]} where {n} = (select stop from v_stop)" for n in numbers)
    return with_views(body, extra)


def _rank_rows(view: str) -> str:
    return f"select node_type, node, label, {rounded_sql('value', 8)} as value from {view}"


_EDGE = "select src_type, src, dst_type, dst from v_edges where "


def _asked_rows(view: str) -> str:
    """Rows of ``view`` for each user's label at the user and at whatever the user points to."""
    return f"""select node_type, node, label, {rounded_sql('value', 8)} as value from {view}
               join (select dst_type as node_type, dst as node, src as label from v_edges
                     where src_type = 'u'
                     union select 'u', src, src from v_edges where src_type = 'u')
               using (node_type, node, label)"""


REC_VIEW = """(select label, cast(node as bigint) as article_id, value as article_rank
               from v_last where node_type = 'a')"""


def recs_sql(order: str, columns: str) -> str:
    return converged_sql(
        f"""select {columns} from (
              select r.*, n.category, n.headline, n.link, row_number() over (
                partition by label order by {rounded_sql("article_rank", 12)} {order}, r.article_id)
                as position
              from {REC_VIEW} r join v_news n on n.id = r.article_id)
            where position <= 15""")


_CHANGES = f"""select pass, {rounded_sql("max_change", 8)} as max_change
               from v_changes where pass <= (select stop from v_stop)"""

_RANK_OUT = f"""select label, cast(node as bigint) as article_id,
                      {rounded_sql('value', 8)} as article_rank
               from v_last where node_type = 'a'"""

_REC_COLUMNS = ("label, position, article_id, category, headline, link, "
                f"{rounded_sql('article_rank', 8)} as article_rank")

# the steps of a pass and the views they make in pass 2
_STEPS = {"sum_labels": "v_p_b", "normalise_by_label": "v_norm_b", "drop_self": "v_noself_b",
          "reseed": "v_seeded_b"}

QUERIES = {
    "edges_article_category": lambda t: E.article_category_edges(t.news()),
    "edges_user_category": lambda t: E.interest_edges(t.interests()),
    "edges_user_article": lambda t: E.like_edges(t.likes()),
    "edges_user_user": lambda t: E.friend_edges(t.friends()),
    "edge_union": graph_edges,
    "node_degrees": lambda t: E.node_degrees(graph_edges(t)),
    "edge_weights": lambda t: _rounded(graph_weights(t), "weight"),
    "seeds": lambda t: E.seeds(t.interests()),
    "propagate": lambda t: _rounded(R.propagate(graph_weights(t), E.seeds(t.interests()))),
    "sum_labels": lambda t: _second_pass(t, "sum_labels"),
    "normalise_by_label": lambda t: _second_pass(t, "normalise_by_label"),
    "drop_self": lambda t: _second_pass(t, "drop_self"),
    "reseed": lambda t: _second_pass(t, "reseed"),
    "prune": lambda t: _second_pass(t, "prune"),
    **{f"{step}_asked": lambda t, step=step: _asked_mass(t, step) for step in _STEPS},
    "convergence": convergence,
    "social_rank": social_rank,
    "social_rank_local": lambda t: social_rank(t, R.LOCAL),
    "user_recs_top15": lambda t: _recs(t, "desc"),
    "user_recs_lowest15": lambda t: _recs(t, "asc"),
}

ORACLES = {
    "edges_article_category": with_views(
        _EDGE + "(src_type = 'a' and dst_type = 'c') or (src_type = 'c' and dst_type = 'a')"),
    "edges_user_category": with_views(
        _EDGE + "(src_type = 'u' and dst_type = 'c') or (src_type = 'c' and dst_type = 'u')"),
    "edges_user_article": with_views(
        _EDGE + "(src_type = 'u' and dst_type = 'a') or (src_type = 'a' and dst_type = 'u')"),
    "edges_user_user": with_views(_EDGE + "src_type = 'u' and dst_type = 'u'"),
    "edge_union": with_views("select src_type, src, dst_type, dst from v_edges"),
    "node_degrees": with_views(
        """select src_type, src, edge_class, count(*) as degree from v_edge_class
           group by src_type, src, edge_class"""),
    "edge_weights": with_views(
        f"""select src_type, src, dst_type, dst, {rounded_sql('weight', 8)} as weight
            from v_weighted"""),
    "seeds": with_views("select node_type, node, label, value from v_seeds"),
    "propagate": with_views(
        f"""select e.dst_type as node_type, e.dst as node, r.label,
                  {rounded_sql('r.value * e.weight', 8)} as value
           from v_weighted e join v_seeds r on r.node_type = e.src_type and r.node = e.src"""),
    "sum_labels": passes_sql(_rank_rows("v_p_b"), 2),
    "normalise_by_label": passes_sql(_rank_rows("v_norm_b"), 2),
    "drop_self": passes_sql(_rank_rows("v_noself_b"), 2),
    "reseed": passes_sql(_rank_rows("v_seeded_b"), 2),
    "prune": passes_sql(_rank_rows("v_r_b"), 2),
    **{f"{step}_asked": passes_sql(_asked_rows(view), 2) for step, view in _STEPS.items()},
    "convergence": converged_sql(_CHANGES),
    "social_rank": converged_sql(_RANK_OUT),
    "social_rank_local": converged_sql(_RANK_OUT, R.LOCAL),
    "user_recs_top15": recs_sql("desc", _REC_COLUMNS),
    "user_recs_lowest15": recs_sql("asc", _REC_COLUMNS),
}
