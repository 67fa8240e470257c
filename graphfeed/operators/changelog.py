"""Current state folded from logs of keyed changes.

A log row has an order (time, then operation id). Folds are running maxima or minima per key,
combined before the shuffle, so a key with very many changes costs no more than others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphfeed.operators.skew import newest, previous_within

ORDER = ["op_ts", "op_id"]


def insert_if_absent(log: DataFrame, key: str, order: Sequence[str] = ORDER) -> DataFrame:
    """The first row per key wins."""
    rest = [c for c in log.columns if c != key]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return log.groupBy(key).agg(first.alias("_row")).select(key, "_row.*").select(*log.columns)


def partial_update(
    log: DataFrame, key: str, fields: Sequence[str], order: Sequence[str] = ORDER
) -> DataFrame:
    """Per field the last given value; null means keep."""
    last = [
        F.max_by(f, F.when(F.col(f).isNotNull(), F.struct(*order))).alias(f) for f in fields
    ]
    return log.groupBy(key).agg(*last)


def profile_change_posts(log: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """A post "My new ... is ...!" for each changed email or affiliation."""
    given = log.select(
        "id", *ORDER,
        F.explode(
            F.array(
                F.struct(F.lit("email").alias("field"), F.col("email").alias("value")),
                F.struct(F.lit("affiliation").alias("field"), F.col("affiliation").alias("value")),
            )
        ).alias("_given"),
    ).select("id", *ORDER, "_given.*").filter(F.col("value").isNotNull())
    order = [F.col(c).asc() for c in ORDER]
    seen = previous_within(given, ["id", "field"], order, "value", "previous", hot_rows)
    return seen.filter(F.col("value") != F.col("previous")).select(
        F.col("id").alias("author"),
        F.col("op_ts").alias("ts"),
        "op_id",
        F.concat(F.lit("My new "), "field", F.lit(" is "), "value", F.lit("!")).alias("text"),
    )


def fold_edits(log: DataFrame, key: str) -> DataFrame:
    """The last operation per key; keys whose last one is a delete are gone."""
    return newest(log, [key], ORDER).filter(F.col("op") != "delete")


def idempotent_put(puts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Putting a key twice is putting it once."""
    return puts.select(*keys).distinct()


def delete_returning(
    table: DataFrame, deletes: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(deleted rows, kept rows)."""
    asked = deletes.select(*keys).distinct()
    return (
        table.join(asked, keys, "left_semi"),
        table.join(asked, keys, "left_anti"),
    )
