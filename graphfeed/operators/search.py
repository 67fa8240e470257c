"""Keyword search over article headlines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphfeed.functions.stemmer import with_stem
from graphfeed.lineage import stored
from graphfeed.sources import folders

# letters and digits of any script
TOKEN = r"[\p{L}\p{N}']+"

# Postings in a bucket of a written index.
ROWS_PER_BUCKET = 4_000_000

# English words without content of their own, the default stop list.
STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been before being "
    "below between both but by can could did do does doing down during each few for from further "
    "had has have having he her here hers herself him himself his how i if in into is it its "
    "itself just me more most my myself no nor not now of off on once only or other our ours "
    "ourselves out over own same she should so some such than that the their theirs them "
    "themselves then there these they this those through to too under until up very was we were "
    "what when where which while who whom why will with would you your yours yourself yourselves"
).split()


def tokens(news: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """(article_id, token) of the headlines, lower case, stop words left out."""
    words = F.regexp_extract_all(F.lower("headline"), F.lit(f"({TOKEN})"), F.lit(1))
    found = news.select(F.col("id").alias("article_id"), F.explode(words).alias("token"))
    stops = news.sparkSession.createDataFrame([(w,) for w in stop_words], "token string")
    # the stop list is a fixed parameter, not data
    return found.join(F.broadcast(stops), "token", "left_anti").select("article_id", "token")


def stem_tokens(found: DataFrame) -> DataFrame:
    """(token, stem) of the distinct tokens: each is stemmed once.

    Written to a table before use. A join filter pushed into the chain of projections would
    repeat its expressions in every step.
    """
    return stored(with_stem(found.select("token").distinct(), "token", "stem"), "stems")


def build_index(
    news: DataFrame, stop_words: Sequence[str] = STOP_WORDS, stem: bool = True
) -> DataFrame:
    """Distinct (keyword, article_id)."""
    postings = tokens(news, stop_words).distinct()
    if not stem:
        return postings.select(F.col("token").alias("keyword"), "article_id")
    joined = postings.join(stem_tokens(postings), ["token"])
    return joined.select(F.col("stem").alias("keyword"), "article_id").distinct()


# -- the written index ------------------------------------------------------------------
#
# Folders buckets=B/segment=S/bucket=b. A segment is never changed; new articles make a new one.


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("keyword"), F.lit(buckets)).cast("int")


def _write_segment(postings: DataFrame, path: str, buckets: int, segment: int) -> None:
    # ranges of (bucket, keyword, article): a task has few buckets, a bucket few files, and a file
    # the postings of neighbouring keywords
    order = ["bucket", "keyword", "article_id"]
    rows = postings.withColumn("bucket", _bucket(buckets)).repartitionByRange(*order)
    rows.sortWithinPartitions(*order).write.mode("overwrite").partitionBy("bucket").parquet(
        f"{path}/buckets={buckets}/segment={segment}")


def write_index(index: DataFrame, path: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Store by keyword bucket; a lookup of known keywords reads only their buckets.

    There are as many buckets as the postings of this first segment need.
    """
    postings = stored(index.select("keyword", "article_id"), "postings")
    _write_segment(postings, path, max(1, -(-postings.count() // rows_per_bucket)), 0)
    return read_index(index.sparkSession, path)


def segments(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """How many buckets the index has, and its complete segments."""
    sized = folders.names(spark, path)[0]
    found = [int(name.removeprefix("segment=")) for name in folders.names(spark, f"{path}/{sized}")
             if folders.is_complete(spark, f"{path}/{sized}/{name}")]
    return int(sized.removeprefix("buckets=")), sorted(found)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(keyword, article_id, bucket) of an index written before; a posting may come twice."""
    buckets, found = segments(spark, path)
    below = f"{path}/buckets={buckets}"
    schema = "keyword string, article_id long, segment int, bucket int"
    return spark.read.schema(schema).option("basePath", below).parquet(
        *[f"{below}/segment={segment}" for segment in found]).drop("segment")


def add_to_index(index: DataFrame, path: str, fan: int = 8) -> DataFrame:
    """Add the postings of further articles; what is written grows with these alone.

    When ``fan`` segments have come since the first or last merge, they are merged into one; so
    a posting is written again once in ``fan`` additions at most, and the first segment never.
    """
    spark = index.sparkSession
    buckets, found = segments(spark, path)
    _write_segment(index.select("keyword", "article_id"), path, buckets, found[-1] + 1)
    later = [s for s in segments(spark, path)[1] if s > 0]
    if len(later) >= fan:
        below = f"{path}/buckets={buckets}"
        rows = spark.read.schema("keyword string, article_id long").parquet(
            *[f"{below}/segment={s}/bucket=*" for s in later])
        _write_segment(rows.distinct(), path, buckets, later[-1] + 1)
        for s in later:  # until here each posting is there at least once
            folders.remove(spark, f"{below}/segment={s}")
    return read_index(spark, path)


def postings_of(spark: SparkSession, path: str, keywords: DataFrame) -> DataFrame:
    """The part of a written index in the buckets of the asked keywords.

    Bucket numbers, one for some million postings, are told to the scan as a partition filter.
    """
    buckets, _ = segments(spark, path)
    asked = [r[0] for r in keywords.select(_bucket(buckets)).distinct().collect()]
    return read_index(spark, path).filter(F.col("bucket").isin(asked)).drop("bucket")


def query_keywords(queries: DataFrame, stem: bool = True) -> DataFrame:
    """(query_id, keyword, keyword_position): the tokens of the text as in headlines."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(f"({TOKEN})"), F.lit(1))
    words = queries.select("query_id", F.posexplode(found).alias("_pos", "token"))
    keyword = "token"
    if stem:
        words = words.join(stem_tokens(words), ["token"])
        keyword = "stem"
    return words.groupBy("query_id", F.col(keyword).alias("keyword")).agg(
        F.min("_pos").alias("keyword_position")
    )


def search(
    index: DataFrame | str, news: DataFrame, queries: DataFrame, n: int = 15, stem: bool = True
) -> DataFrame:
    """First ``n`` articles per query that have any of its keywords.

    ``index`` is a table of postings or the path of a written index.

    Hits are ordered by the first matching keyword, then by article id. An article that is
    not among the ``n`` smallest ids of a keyword has ``n`` hits before it under that
    keyword, so the posting lists are cut to their first ``n`` ids before the join. The cut
    is exact, and no query meets a whole list of a frequent word.
    """
    # a posting that comes twice takes one place
    place = F.dense_rank().over(Window.partitionBy("keyword").orderBy("article_id"))
    asked = query_keywords(queries, stem)
    if isinstance(index, str):
        asked = stored(asked, "asked")
        index = postings_of(news.sparkSession, index, asked)
    # a keyword nobody asks for is left out before the lists are cut
    index = index.join(asked.select("keyword").distinct(), ["keyword"], "left_semi")
    heads = (
        index.select("keyword", "article_id")
        .withColumn("_place", place)
        .filter(F.col("_place") <= n)
        .drop("_place")
    )
    hits = asked.join(heads, ["keyword"]).groupBy("query_id", "article_id").agg(
        F.min("keyword_position").alias("keyword_position")
    )
    order = Window.partitionBy("query_id").orderBy("keyword_position", "article_id")
    best = hits.withColumn("position", F.row_number().over(order).cast("long")).filter(
        F.col("position") <= n
    )
    shown = news.select(F.col("id").alias("article_id"), "headline", "authors", "link")
    return best.join(shown, ["article_id"]).select(
        "query_id", "position", "article_id", "headline", "authors", "link"
    )
