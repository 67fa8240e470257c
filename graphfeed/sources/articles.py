"""News ingestion from JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphfeed.operators.skew import sums_before

ARTICLE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("category", "headline", "authors", "link", "short_description", "date")
    ]
)

_BAD = "_bad"
_WITH_BAD = T.StructType([*ARTICLE.fields, T.StructField(_BAD, T.StringType())])


def write_article_lines(df: DataFrame, path: str, order_col: str) -> None:
    """JSON lines whose order over all files follows ``order_col``."""
    ordered = df.repartitionByRange(order_col).sortWithinPartitions(order_col)
    ordered.drop(order_col).write.option("ignoreNullFields", "false").json(path)


def _parsed(lines: DataFrame) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    return lines.withColumn("_row", F.from_json("value", _WITH_BAD, options))


def read_articles(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(articles, bad lines). A bad line is set aside; the lines after it are still read."""
    parsed = _parsed(spark.read.text(path))
    bad = F.col(f"_row.{_BAD}").isNotNull() | F.col("_row").isNull()
    good = parsed.filter(~bad).select(*[f"_row.{name}" for name in ARTICLE.names])
    return good, parsed.filter(bad).select(F.col("value").alias("line"))


def read_with_line_ids(spark: SparkSession, path: str) -> DataFrame:
    """Articles with their zero-based line number over all files in path order.

    Part files come in the order of their numbers. A file is read in blocks. The number of a
    line is the number of lines in earlier blocks plus its place in its own block, so only one
    row per block is ever ordered, in ranges. Bad lines count, as they do in the file, but are
    left out of the result.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    part = F.expr("try_cast(regexp_extract(_file, 'part-([0-9]+)', 1) as bigint)")
    blocks = lines.groupBy("_file", "_block").agg(
        F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    blocks = sums_before(blocks, [part, F.col("_file"), F.col("_block")], "_n", "_before").drop("_n")
    numbered = lines.join(blocks, ["_file", "_block"]).withColumn(
        "id", F.col("_seq") - F.col("_first") + F.col("_before")
    )
    parsed = _parsed(numbered)
    bad = F.col(f"_row.{_BAD}").isNotNull() | F.col("_row").isNull()
    return parsed.filter(~bad).select("id", *[f"_row.{name}" for name in ARTICLE.names])


def build_news(numbered: DataFrame) -> DataFrame:
    return numbered.withColumnRenamed("short_description", "description").select(
        "id", "category", "headline", "authors", "link", "description", "date"
    )


def write_news(news: DataFrame, path: str) -> DataFrame:
    """Put by id: ids are unique, so the table is written as a whole."""
    news.write.mode("overwrite").parquet(path)
    return news.sparkSession.read.schema(news.schema).parquet(path)
