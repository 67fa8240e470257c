"""Label propagation (adsorption) over the typed graph.

One pass moves every (node, label, value) along the weighted out-edges, sums per (node,
label), divides by the label's total over all nodes, drops a user's label at the user,
puts the seeds back and prunes small values.

The single steps are functions of their own. ``adsorption`` runs the whole loop and uses
two facts about it:

* the total a label has after a pass is the sum of value x out-mass before it, so values can
  be divided before they are moved and pruned in the same stage that sums them;
* a normalised label keeps fewer than 1 / min_weight rows, but before pruning it reaches
  nearly every node, because a wide node (a category, a user with very many friends) passes a
  sliver on along each of its light edges. Where all that the light edges into a node can add is
  no more than the limit, the node can only stay if something else reaches it too, and the light
  part is looked up for such nodes alone (``_moved``). The bound holds whatever counts as light,
  so nothing is lost, and the work per label follows the rows kept, not the nodes.

Values move along edges in cells (``operators/cells.py``): the rows of some labels meet the packed
edges into some nodes, and are summed and cut there. Only rows that stay leave a cell, so what is
shuffled follows the rows kept and not the edges that they have.

Edges are also written as rows: the ordinary ones and the light ones in blocks of bounded size, bucketed
by source and by source and block, so moving along them (``_spread``) moves no edge and no hub falls
to one task. That way go what light edges alone may lift above the limit, and all that comes to a node
with more edges into it than a cell holds. Whether a join broadcasts a small table or merges buckets
is left to Catalyst.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphfeed.lineage import bucketed, stored
from graphfeed.operators import cells
from graphfeed.operators.edges import ARTICLE, CATEGORY, USER
from graphfeed.operators.skew import skew_join

RANK_COLUMNS = ["node_type", "node", "label", "value"]

# An edge that weighs less than one part in so many is light; a node with light edges is wide.
WIDE = 256
# Light edges of one node that a block should have.
BLOCK_EDGES = 100_000

# Node types are kept in the two lowest bits of a node number, and whether it is wide in the third.
_TYPE_CODES = {USER: 0, ARTICLE: 1, CATEGORY: 2}
_WIDE_BIT = 4

# Values are compared as if rounded to 12 digits, as sums differ in the last bits.
_ROUNDING = 0.5e-12


@dataclass(frozen=True)
class Variant:
    """``prune_first``: prune the sums before they are normalised."""

    min_weight: float
    tolerance: float
    prune_first: bool
    max_passes: int = 15


# Fixed values of the two jobs.
CLUSTER = Variant(min_weight=0.0001, tolerance=0.001, prune_first=False)
LOCAL = Variant(min_weight=0.005, tolerance=0.005, prune_first=True)


def above(value: Column, limit: float) -> Column:
    return value >= F.lit(limit + _ROUNDING)


# -- single steps -----------------------------------------------------------------------


def propagate(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """Unsummed contributions: value x weight for each out-edge of each ranked node."""
    moved = ranks.select(
        F.col("node_type").alias("src_type"), F.col("node").alias("src"), "label", "value"
    )
    joined = skew_join(edges, moved, ["src_type", "src"])
    return joined.select(
        F.col("dst_type").alias("node_type"),
        F.col("dst").alias("node"),
        "label",
        (F.col("value") * F.col("weight")).alias("value"),
    )


def sum_labels(contributions: DataFrame) -> DataFrame:
    return contributions.groupBy("node_type", "node", "label").agg(F.sum("value").alias("value"))


def label_totals(ranks: DataFrame) -> DataFrame:
    return ranks.groupBy("label").agg(F.sum("value").alias("total"))


def normalise_by_label(ranks: DataFrame) -> DataFrame:
    """Totals are per label over all nodes, not per node."""
    joined = ranks.join(label_totals(ranks), ["label"])
    return joined.withColumn("value", F.col("value") / F.col("total")).select(*RANK_COLUMNS)


def drop_self(ranks: DataFrame) -> DataFrame:
    return ranks.filter(~((F.col("node_type") == USER) & (F.col("node") == F.col("label"))))


def reseed(ranks: DataFrame, seeds: DataFrame) -> DataFrame:
    return ranks.unionByName(seeds.select(*RANK_COLUMNS))


def prune(ranks: DataFrame, min_weight: float) -> DataFrame:
    return ranks.filter(above(F.col("value"), min_weight))


# -- the whole loop ---------------------------------------------------------------------


@dataclass
class _Graph:
    """``far``: the light edges, with how many of them end where they do; ``near``: the others.

    ``packs``: both as arrays, in ``blocks`` blocks. ``crowded``: edges of either kind, in none of the
    above, into nodes with too many for a cell; None if there is no such node.
    """

    nodes: DataFrame
    near: DataFrame
    far: DataFrame
    packs: DataFrame
    blocks: int
    crowded: DataFrame | None
    out_mass: DataFrame
    n_wide: DataFrame
    most_wide: int
    seeds: DataFrame


def _number_nodes(
    edges: DataFrame, seeds: DataFrame, wide: int, block_edges: int, cell_edges: int = cells.CELL_EDGES
) -> _Graph:
    """Give nodes whole numbers, so that the loop joins and groups on longs."""
    edges = stored(edges, "edges")
    light = F.col("weight") < 1.0 / wide
    none = F.lit(0).cast("long").alias("n")
    names = (
        edges.select(F.col("src_type").alias("type"), F.col("src").alias("name"),
                     light.cast("long").alias("n"))
        .unionByName(edges.select(F.col("dst_type").alias("type"), F.col("dst").alias("name"), none))
        .unionByName(seeds.select(F.col("node_type").alias("type"), F.col("node").alias("name"), none))
        .groupBy("type", "name").agg(F.sum("n").alias("n"))
    )
    code = F.lit(None).cast("long")
    for node_type, value in _TYPE_CODES.items():
        code = F.when(F.col("type") == node_type, F.lit(value)).otherwise(code)
    number = (F.shiftleft(F.monotonically_increasing_id(), 3)
              + F.when(F.col("n") > 0, _WIDE_BIT).otherwise(0) + code)
    # the numbers must not change once given, hence written before they are used
    nodes = stored(names.select("type", "name", number.alias("id")), "nodes")

    def with_number(df: DataFrame, type_col: str, name_col: str, out: str) -> DataFrame:
        numbers = nodes.select(
            F.col("type").alias(type_col), F.col("name").alias(name_col), F.col("id").alias(out)
        )
        return df.join(numbers, [type_col, name_col])

    numbered = with_number(edges, "src_type", "src", "src_id")
    numbered = with_number(numbered, "dst_type", "dst", "dst_id")
    numbered = stored(
        numbered.select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"), "weight"),
        "numbered",
    )
    starts = with_number(seeds, "node_type", "node", "id").select(
        F.col("id").alias("node"), F.col("id").alias("label"), "value"
    )
    out_mass = stored(numbered.groupBy(F.col("src").alias("node")).agg(
        F.sum("weight").alias("mass"), F.max(F.when(light, F.col("weight"))).alias("widest"),
        F.ceil(F.count_if(light) / block_edges).cast("int").alias("blocks")), "out-mass")
    # at most (edges / cell_edges) rows
    busy = stored(numbered.groupBy("dst").count().filter(F.col("count") > cell_edges).select("dst"), "busy")
    crowded = None
    if not busy.isEmpty():
        crowded = bucketed(numbered.join(F.broadcast(busy), "dst", "left_semi"), ["src"], "crowded-edges")
        numbered = numbered.join(F.broadcast(busy), "dst", "left_anti")
    near = numbered.filter(~light)
    far = numbered.filter(light)
    n_wide = stored(far.groupBy(F.col("dst").alias("node")).agg(
        F.count(F.lit(1)).alias("n_wide")), "wide-before")
    # one row per wide node
    cut = out_mass.filter(_is_wide("node")).select(F.col("node").alias("src"), "blocks")
    far = (far.join(cut, "src").join(n_wide.withColumnRenamed("node", "dst"), "dst")
           .withColumn("block", F.pmod(F.xxhash64("dst"), F.col("blocks")).cast("int"))
           .drop("blocks"))
    near, far = bucketed(near, ["src"], "near-edges"), bucketed(far, ["src", "block"], "far-edges")
    return _Graph(
        nodes,
        near,
        far,
        *cells.packed(near, far, cell_edges),
        crowded,
        out_mass,
        n_wide,
        n_wide.agg(F.max("n_wide")).first()[0] or 0,
        stored(starts, "seeds"),
    )


def _is_wide(node: str) -> Column:
    return F.col(node).bitwiseAND(F.lit(_WIDE_BIT)) != 0


def _has_type(node: str, node_type: str) -> Column:
    return F.col(node).bitwiseAND(F.lit(3)) == _TYPE_CODES[node_type]


def _scaled(ranks: DataFrame, graph: _Graph) -> DataFrame:
    """Divide by the total that the label will have after moving."""
    totals = stored(
        ranks.join(graph.out_mass, "node")
        .groupBy("label")
        .agg(F.sum(F.col("value") * F.col("mass")).alias("total")),
        "totals",
    )
    return ranks.join(totals, "label").select(
        "node", "label", (F.col("value") / F.col("total")).alias("value")
    )


def _spread(
    ranks: DataFrame, edges: DataFrame, keys: list[str], where: Column | None = None
) -> DataFrame:
    """Move values along ``edges``, bucketed by ``keys``, and sum them per (label, node)."""
    joined = ranks.withColumnRenamed("node", "src").repartition("label").join(edges, keys)
    if where is not None:
        joined = joined.filter(where)
    return (
        joined.withColumn("moved", F.col("value") * F.col("weight"))
        .groupBy("label", F.col("dst").alias("node"))
        .agg(F.sum("moved").alias("value"))
        .select("node", "label", "value")
    )


def _wide_bounds(held: DataFrame) -> DataFrame:
    """Per label the most one light edge adds to a node, and those of all wide nodes together."""
    each = F.col("value") * F.col("widest")
    # a little room, as the sums that are compared with it differ in the last bits
    room = F.lit(1.000001)
    return held.groupBy("label").agg(
        (F.max(each) * room).alias("one"), (F.sum(each) * room).alias("all"))


def _moved(ranks: DataFrame, graph: _Graph, limit: float) -> DataFrame:
    """Sums per (label, node) after moving; sums not above the limit may be missing.

    ``reach`` is the most that the light edges into a node can add to it. Pairs whose reach is
    above the limit get what comes along them by moving it as usual. The others come up only
    if something else reaches them and both together may pass the limit; for those few the
    values behind the light edges are looked up, in the cell that sums the ordinary edges.
    """
    held = ranks.filter(_is_wide("node")).join(graph.out_mass, "node")
    bounds = stored(_wide_bounds(held), "bounds")
    reach = F.least(F.col("one") * F.col("n_wide"), F.col("all"))
    parts = [cells.moved(ranks, bounds, graph.packs, graph.blocks, limit)]

    strong = bounds.filter(F.least(F.col("one") * graph.most_wide, F.col("all")) > limit)
    if not strong.isEmpty():
        every = F.sequence(F.lit(0), F.col("blocks") - 1)
        parts.append(_spread(
            held.join(strong, "label").withColumn("block", F.explode(every))
            .select("node", "block", "label", "value", "one", "all"),
            graph.far,
            ["src", "block"],
            reach > limit,
        ))
    if graph.crowded is not None:
        parts.append(_spread(ranks, graph.crowded, ["src"]))
    if len(parts) == 1:
        return parts[0]
    return reduce(DataFrame.unionByName, parts).groupBy("node", "label").agg(F.sum("value").alias("value"))


def _one_pass(ranks: DataFrame, graph: _Graph, variant: Variant) -> DataFrame:
    value = F.col("value")
    if variant.prune_first:
        summed = stored(
            _moved(ranks, graph, variant.min_weight).filter(above(value, variant.min_weight)),
            "summed",
        )
        kept = summed.join(label_totals(summed), "label").select(
            "node", "label", (value / F.col("total")).alias("value")
        )
    else:
        kept = _moved(_scaled(ranks, graph), graph, variant.min_weight).filter(
            above(value, variant.min_weight)
        )
    kept = kept.filter(F.col("node") != F.col("label")).unionByName(graph.seeds)
    return stored(kept, "ranks")


def _max_change(new: DataFrame, old: DataFrame) -> float:
    """Largest change over (article, label); rows on one side only count in full."""
    signed = new.filter(_has_type("node", ARTICLE)).unionByName(
        old.filter(_has_type("node", ARTICLE)).withColumn("value", -F.col("value"))
    )
    changes = signed.groupBy("label", "node").agg(F.abs(F.sum("value")).alias("change"))
    return changes.agg(F.max("change")).first()[0] or 0.0


def run_passes(
    edges: DataFrame,
    seeds: DataFrame,
    variant: Variant = CLUSTER,
    passes: int | None = None,
    watch: bool = False,
    wide: int = WIDE,
    block_edges: int = BLOCK_EDGES,
    cell_edges: int = cells.CELL_EDGES,
) -> tuple[DataFrame, list[tuple[int, float]]]:
    """Ranks after the loop and the change of each watched pass.

    ``passes`` fixes the number of passes; without it the loop stops once the change of a
    pass after the first is within the tolerance. ``wide``, ``block_edges`` and ``cell_edges`` say
    how the edges are kept; the ranks do not depend on them.
    """
    graph = _number_nodes(edges, seeds, wide, block_edges, cell_edges)
    ranks = graph.seeds
    history: list[tuple[int, float]] = []
    for number in range(1, (passes or variant.max_passes) + 1):
        before, ranks = ranks, _one_pass(ranks, graph, variant)
        if number > 1 and (watch or passes is None):
            change = _max_change(ranks, before)
            history.append((number, change))
            if passes is None and change <= variant.tolerance:
                break
    return _named(ranks, graph), history


def _named(ranks: DataFrame, graph: _Graph) -> DataFrame:
    node_names = graph.nodes.select(
        F.col("id").alias("node"), F.col("type").alias("node_type"), F.col("name").alias("_node")
    )
    user_names = graph.nodes.filter(F.col("type") == USER).select(
        F.col("id").alias("label"), F.col("name").alias("_label")
    )
    named = ranks.join(node_names, "node").join(user_names, "label")
    return named.select(
        "node_type", F.col("_node").alias("node"), F.col("_label").alias("label"), "value"
    )


def article_ranks(ranks: DataFrame) -> DataFrame:
    """(label, article_id, article_rank): what the rank table stores."""
    return ranks.filter(F.col("node_type") == ARTICLE).select(
        "label",
        F.col("node").cast("long").alias("article_id"),
        F.col("value").alias("article_rank"),
    )


def adsorption(
    edges: DataFrame,
    seeds: DataFrame,
    variant: Variant = CLUSTER,
    passes: int | None = None,
    tolerance: float | None = None,
) -> DataFrame:
    """The whole ranking job, article nodes only."""
    if tolerance is not None:
        variant = replace(variant, tolerance=tolerance)
    ranks, _ = run_passes(edges, seeds, variant, passes)
    return article_ranks(ranks)
