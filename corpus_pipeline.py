"""The corpus pipeline: documents in, encoded training documents out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
reread as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphfeed.lineage import stored
from graphfeed.llm import minhash, mixing, quality_rules, secret_scan, sentencepiece
from graphfeed.llm.common import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a certified rule rejects go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: shingles of five words, similarity 0.8."""
    return minhash.deduplicated(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets that look live are masked; ``n_chars`` follows the text."""
    masked = secret_scan.mask_live(
        docs, F.concat_ws("/", "source", "lang"), F.col("source"))
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is taken to its target; a document comes as often as it is taken."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix."""
    return sentencepiece.encoded(docs, F.col("doc_id"), F.col("text")).withColumnRenamed(
        "_id", "doc_id")


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("secret_scan", secrets),
    ("mixing", mix),
    ("sentencepiece", encode),
]

# the encoded pieces of the last stage are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
