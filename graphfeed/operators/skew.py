"""Operators that stay balanced when one key holds a large part of the rows.

Plain equi-joins are left to adaptive execution, which splits oversize partitions of either
side when it has seen them. What it cannot split is cut here: windows over a hot group, and
many-to-many joins of a known hot key. ``HOT_ROWS`` is the number of rows of one key that a
single task may be given. Keys above it are split; there are at most ``rows / HOT_ROWS`` of
them, which bounds what is broadcast here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphfeed.lineage import stored

HOT_ROWS = 1_000_000


def hot_keys(sizes: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys above the limit with the number of pieces each has to be cut into."""
    return sizes.filter(F.col("n") > hot_rows).select(
        *keys, F.ceil(F.col("n") / hot_rows).cast("int").alias("_pieces")
    )


def skew_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot_rows: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Join on ``keys`` where ``big`` may hold very many rows of one key.

    Rows of a hot key take its pieces in turn, so equal rows spread too; the matching rows of
    ``small`` are repeated once per piece. Other keys are joined as they are. ``how`` is any
    type that keeps at most the rows of ``big``: inner, left, left_semi, left_anti. ``big``
    should be a written table, whose rows keep their places. ``sizes`` may give its rows per
    key as (keys, n).
    """
    hot_rows = hot_rows or HOT_ROWS
    keys = list(keys)
    if sizes is None:
        sizes = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = stored(hot_keys(sizes, keys, hot_rows), "hot-keys")
    if hot.isEmpty():
        return big.join(small, keys, how)
    hot = F.broadcast(hot)
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    salted = (
        big.withColumn("_turn", F.monotonically_increasing_id())
        .join(hot, keys, "left")
        .withColumn("_piece", F.pmod("_turn", pieces).cast("int"))
        .drop("_pieces", "_turn")
    )
    repeated = (
        small.join(hot, keys, "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("_pieces")
    )
    return salted.join(repeated, [*keys, "_piece"], how).drop("_piece")


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "position",
    hot_rows: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each group from 1 in a total order.

    Ordinary groups use ``row_number``. Groups above ``hot_rows`` (and the whole table, if
    ``keys`` is empty) are range-partitioned by key and order instead, so that no task sorts
    a whole hot group; the start of each range follows from row counts. ``sizes`` may give
    the group sizes as (keys, n) where they are known more cheaply than by counting ``df``;
    without it ``df`` is written once and counted there, so that its plan runs one time.
    """
    hot_rows = hot_rows or HOT_ROWS
    keys = list(keys)
    if not keys:
        return _number_by_range(df, [], order, name)
    ordinary = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    if sizes is None:
        df = stored(df, "to-number")
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = stored(hot_keys(sizes, keys, hot_rows).drop("_pieces"), "hot-keys")
    if hot.isEmpty():
        return df.withColumn(name, ordinary.cast("long"))
    hot = F.broadcast(hot)
    cold_rows = df.join(hot, keys, "left_anti").withColumn(name, ordinary.cast("long"))
    hot_rows_df = df.join(hot, keys, "left_semi")
    return cold_rows.unionByName(_number_by_range(hot_rows_df, keys, order, name))


def _number_by_range(
    df: DataFrame, keys: list[str], order: Sequence[Column], name: str
) -> DataFrame:
    # numbers given by place must not change once given, hence written before they are used
    placed = stored(
        df.repartitionByRange(*[F.col(k) for k in keys], *order)
        .sortWithinPartitions(*[F.col(k) for k in keys], *order)
        .withColumn("_seq", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_seq", 33)),
        "placed",
    )
    # one row per group and range: at most (hot groups + ranges) rows
    runs = placed.groupBy(*keys, "_part").agg(
        F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    if keys:
        earlier = (
            Window.partitionBy(*keys)
            .orderBy("_part")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    else:
        runs = runs.join(_sums_before(runs.select("_part", "_n")), "_part")
    return (
        placed.join(F.broadcast(runs.drop("_n")), [*keys, "_part"])
        .withColumn(name, F.col("_seq") - F.col("_first") + F.col("_before") + 1)
        .select(*df.columns, name)
    )


def _sums_before(parts: DataFrame, fan: int = 1024) -> DataFrame:
    """(_part, _before) from (_part, _n): the sum of ``_n`` over smaller parts, in two levels.

    Parts are numbered by ranges of a table; ``fan`` neighbours are summed in one task, and only
    one number per such group meets the others.
    """
    group = F.floor(F.col("_part") / fan)
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    inside = parts.withColumn("_group", group).withColumn(
        "_inside", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    totals = F.collect_list(F.struct(F.col("_group").alias("g"), F.col("_total").alias("n")))
    zero = F.lit(0).cast("long")
    above = (
        parts.groupBy(group.alias("_group")).agg(F.sum("_n").alias("_total"))
        .agg(totals.alias("_all"))
        .select("_all", F.explode("_all").alias("_one"))
        .select(F.col("_one.g").alias("_group"), F.aggregate(
            F.filter("_all", lambda x: x.g < F.col("_one.g")), zero, lambda a, x: a + x.n
        ).alias("_above"))
    )
    return inside.join(above, "_group").select(
        "_part", (F.col("_inside") + F.col("_above")).alias("_before"))


def sums_before(counts: DataFrame, order: Sequence[Column], n: str, name: str) -> DataFrame:
    """``counts`` with the sum of column ``n`` over all rows before, in a total order.

    Rows are range-partitioned; sums run within a range, and ranges are summed in two levels.
    """
    placed = stored(
        counts.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(F.sum(n).alias("_n"))
    return (
        placed.withColumn("_inside", F.coalesce(F.sum(n).over(earlier), F.lit(0)))
        .join(_sums_before(totals), "_part")
        .select(*counts.columns, (F.col("_inside") + F.col("_before")).alias(name))
    )


def previous_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: str,
    name: str = "previous",
    hot_rows: int | None = None,
) -> DataFrame:
    """The value of the row before, per group; null for the first row of a group."""
    hot_rows = hot_rows or HOT_ROWS
    keys = list(keys)
    lagged = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    df = stored(df, "to-lag")
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if hot_keys(sizes, keys, hot_rows).isEmpty():
        return df.withColumn(name, lagged)
    # joined by position, so that the rows of a hot group spread over all tasks
    numbered = stored(number_within(df, keys, order, "_pos", hot_rows, sizes), "numbered")
    before = numbered.select(*keys, (F.col("_pos") + 1).alias("_pos"), F.col(value).alias(name))
    return numbered.join(before, [*keys, "_pos"], "left").drop("_pos")


def dense_index(df: DataFrame, id_col: str, name: str = "rn", bits: int = 20) -> DataFrame:
    """Zero-based rank of a unique integer id, without sorting the table in one task.

    Ids are cut into blocks of ``2**bits``; a block holds at most that many rows because
    ids are unique. With sparse ids there may be as many blocks as rows: their starts are sums
    over ranges, not over one task.
    """
    block = F.shiftright(F.col(id_col), bits)
    blocks = df.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_n"))
    starts = sums_before(blocks, [F.col("_block")], "_n", "_start").drop("_n")
    inside = F.row_number().over(Window.partitionBy("_block").orderBy(id_col))
    return (
        df.withColumn("_block", block)
        .join(starts, "_block")
        .withColumn(name, F.col("_start") + inside - 1)
        .drop("_block", "_start")
    )


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key. One running maximum per key, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(picked.alias("_row")).select(*keys, "_row.*").select(*df.columns)
