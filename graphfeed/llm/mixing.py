"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words. Its documents, in the order of their size, each
expect ``target / source size`` copies. One offset is added to the running sum of expected
copies, and a document is taken once per whole number that the sum crosses in it. Going by
size makes neighbours alike, so what a source gives differs from its target by no more than
about its longest document.

The running sum over a source of any size: rows are range-partitioned by (source, size, id) and
written, which fixes their places; the start of each range follows from row counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphfeed.lineage import stored
from graphfeed.llm.common import words

# The weights of the sources in turn, all targets as a share of all words, and how often
# a source's words may be taken.
WEIGHTS = [5, 2, 1]
SHARE = 1.5
MOST = 2.0
SEED = "mix"


def source_targets(
    sizes: DataFrame, weights: list[int] | None = None, share: float = SHARE, most: float = MOST,
) -> DataFrame:
    """(source, source_size, target) from rows with ``source`` and ``size``.

    Sources in code-point order, null last, weigh ``weights`` in turn. A target stops at
    ``most`` times its source's size; what is above goes to the others by weight until none
    is above: every target is ``least(most * size, level * weight)`` for one level, found by
    filling the sources in the order in which they become full. One row per source from the
    first sum on.
    """
    weights = weights or WEIGHTS
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn % len(weights) + 1)
    full = by_source.withColumn("_weight", weight).withColumn("_cap", most * F.col("source_size"))
    ratio = F.col("_cap") / F.col("_weight")
    order = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (
        share * F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ) / F.sum("_weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    filled = full.withColumn("_level", level).withColumn(
        # the first source that is not full tells the level of all
        "_found", F.first(F.when(level <= ratio, level), ignorenulls=True).over(
            order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return filled.select(
        "source", "source_size",
        F.least(F.col("_cap"), F.coalesce("_found", F.lit(float("inf"))) * F.col("_weight"))
        .alias("target"))


def _positions(rows: DataFrame) -> DataFrame:
    """``rows`` with ``position``, the place in its source from 1, by (size, id)."""
    order = [F.col("source"), F.col("size"), F.col("_id")]
    placed = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_seq", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_seq", 33)), "mix-places")
    runs = placed.groupBy("source", "_part").agg(
        F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    # one row per source and range
    runs = runs.select(
        F.col("source").alias("_s"), F.col("_part").alias("_p"), "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return placed.join(
        runs, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p"))
    ).select(*rows.columns,
             (F.col("_seq") - F.col("_first") + F.col("_before") + 1).alias("position"))


def _offset(seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the source only."""
    of = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))))
    return F.conv(F.substring(of, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def copies(rows: DataFrame, seed: str = SEED, **targets) -> DataFrame:
    """``rows`` (``source``, ``size``, ``_id``, more) with source_size, target and ``copies``.

    Rows with equal source, size and id, such as repeated ones, take places next to each other
    and are interchangeable. A document without words may be taken and adds nothing.
    """
    shares = source_targets(rows, **targets).select(
        F.col("source").alias("_source"), "source_size", "target")
    each = F.col("target") / F.greatest(F.col("source_size"), F.lit(1))
    crossed = (F.floor(F.col("position") * each + _offset(seed))
               - F.floor((F.col("position") - 1) * each + _offset(seed)))
    return (
        _positions(rows)
        .join(shares, F.col("source").eqNullSafe(F.col("_source")))
        # rounding of the running sum must not give a copy beyond the bound
        .withColumn("copies", F.least(crossed, F.ceil(each)).cast("long"))
        .drop("_source", "position")
    )


def sized(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def taken(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
          seed: str = SEED) -> DataFrame:
    """Per row of ``docs``: id, size, source_size, target, taken (words, repeats counted).

    Size is the number of words, 0 for null. Null ids and repeated rows are rows like others.
    An empty table gives no rows.
    """
    # stored, since sums and places both read the sizes
    rows = stored(docs.select(F.col(id_col).alias("_id"), F.col(source).alias("source"),
                              sized(F.col(text)).alias("size")), "mix-sizes")
    return copies(rows, seed).select(
        F.col("_id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
          seed: str = SEED) -> DataFrame:
    """The rows of the mix with the columns of ``docs``, each as often as it is taken."""
    rows = stored(docs.select(F.struct(*docs.columns).alias("_doc"))
                  .withColumn("_row", F.monotonically_increasing_id()), "mix-rows")
    sizes = stored(rows.select("_row", F.col(f"_doc.{id_col}").alias("_id"),
                               F.col(f"_doc.{source}").alias("source"),
                               sized(F.col(f"_doc.{text}")).alias("size")), "mix-sizes")
    # by hash at every size: the counts are small, the texts are not to be sorted
    often = copies(sizes, seed).filter("copies > 0").select("_row", "copies").hint("shuffle_hash")
    return (rows.join(often, "_row")
            .select("_doc", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
            .select("_doc.*"))
