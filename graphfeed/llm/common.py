"""Small helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# what separates words: the space and the control characters tab to carriage return
SEPARATORS = r"[ \t-\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1), "")


def id_remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5))


def hash_sample(df: DataFrame, key: str, size: int, count: int) -> DataFrame:
    """About ``size`` of the ``count`` rows: those with the smallest hashes of ``key``, all if no more.

    A threshold, not a sorted limit, so that no more than the sample ever leaves the executors.
    """
    if count <= size:
        return df
    return df.filter(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < (1 << 40) * size // count)
