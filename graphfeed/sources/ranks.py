"""Rank and recommendation tables.

Each write makes a new version and readers take complete versions only, so a job that dies
half-way leaves the old table in place. A table is cut into buckets of labels, as many as its rows
need. Replacing it writes all buckets (folder ``v=N``), an upsert only those that its rows touch
(``d=N``); of each bucket the newest version since the last replacement counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphfeed.lineage import stored
from graphfeed.sources import folders

RECS = "label string, article_id long, article_rank double"
KEYS = ["label", "article_id"]
ROWS_PER_BUCKET = 4_000_000


def _version_folders(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(version, folder) of the complete versions, oldest first."""
    found = [(int(name[2:]), f"{path}/{name}") for name in folders.names(spark, path)
             if name[:2] in ("v=", "d=")]
    return sorted(f for f in found if folders.is_complete(spark, f[1]))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions below ``path``, oldest first."""
    return [version for version, _ in _version_folders(spark, path)]


def bucket_folders(spark: SparkSession, path: str) -> tuple[int, dict[int, str]]:
    """How many buckets the table has, and the folder that holds each filled one now."""
    buckets, current = 1, {}
    for _, folder in reversed(_version_folders(spark, path)):
        for sized in folders.names(spark, folder):
            buckets = int(sized.removeprefix("buckets="))
            for name in folders.names(spark, f"{folder}/{sized}"):
                current.setdefault(int(name.removeprefix("label_bucket=")), f"{folder}/{sized}/{name}")
        if folder.startswith(f"{path}/v="):
            break
    return buckets, current


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    # no schema inference and no listing beyond the folders named
    return spark.read.schema(RECS).parquet(*paths) if paths else spark.createDataFrame([], RECS)


def read_recs(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, list(bucket_folders(spark, path)[1].values()))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("label"), F.lit(buckets)).cast("int")


def write_recs(
    ranks: DataFrame, path: str, mode: str = "replace", rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """``replace`` drops the old content, ``upsert`` keeps old rows with other keys.

    Of several new rows with one key the one with the highest rank is put. An upsert reads and
    writes the buckets of its own labels only; files of the others stay as they are.
    """
    spark = ranks.sparkSession
    known = versions(spark, path)
    rows = stored(ranks.groupBy(*KEYS).agg(F.max("article_rank").alias("article_rank")), "recs-new")
    upsert = mode == "upsert" and bool(known)
    if upsert:
        buckets, current = bucket_folders(spark, path)
        # numbers below the count of buckets, one for some million rows of the table
        touched = [r[0] for r in rows.select(_bucket(buckets)).distinct().collect()]
        old = _read(spark, [current[b] for b in touched if b in current])
        rows = old.join(rows.select(*KEYS), KEYS, "left_anti").unionByName(rows)
    else:
        buckets = max(1, -(-rows.count() // rows_per_bucket))
    folder = "d" if upsert else "v"
    target = f"{path}/{folder}={(known[-1] if known else 0) + 1}/buckets={buckets}"
    # ranges of (bucket, label, article): a task has few buckets, a bucket few files
    placed = rows.withColumn("label_bucket", _bucket(buckets)).repartitionByRange(
        "label_bucket", *KEYS)
    placed.write.mode("overwrite").partitionBy("label_bucket").parquet(target)
    spark.createDataFrame([], "done int").write.mode("append").parquet(target.rsplit("/", 1)[0])
    return read_recs(spark, path)


def drop_old(spark: SparkSession, path: str) -> None:
    """Remove what no reader of the newest table needs: all before the last replacement, and
    buckets that later versions have written anew. For times when nobody reads an older table."""
    kept = set(bucket_folders(spark, path)[1].values())
    full = [v for v, folder in _version_folders(spark, path) if folder.startswith(f"{path}/v=")]
    for version, folder in _version_folders(spark, path):
        if full and version < full[-1]:
            folders.remove(spark, folder)
            continue
        for sized in folders.names(spark, folder):
            for name in folders.names(spark, f"{folder}/{sized}"):
                if f"{folder}/{sized}/{name}" not in kept:
                    folders.remove(spark, f"{folder}/{sized}/{name}")


def write_user_recs(user_recs: DataFrame, path: str) -> DataFrame:
    """One row per user; users without recommendations have no row."""
    filled = user_recs.filter(F.size("recs") > 0)
    filled.write.mode("overwrite").parquet(path)
    return user_recs.sparkSession.read.schema(user_recs.schema).parquet(path)
