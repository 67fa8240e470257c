"""The numbered corpus queries over the given tables, and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphfeed.llm import (
    ann,
    archive,
    divergence,
    importance,
    minhash,
    mixing,
    ngram_lm,
    pairwise_quality,
    pii,
    quality_rules,
    secret_scan,
    sentencepiece,
    suffix_dedup,
)
from graphfeed.llm.common import id_remainder, table
from graphfeed.llm.queries_sql import ORACLES


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; strata are languages."""
    return quality_rules.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; those whose remainder is not 1 train."""
    found = ngram_lm.scored(table(spark, sf_dir, "documents"), F.col("doc_id"),
                            id_remainder(F.col("doc_id")) != 1, F.col("text"))
    return found.withColumnRenamed("_id", "doc_id")


def op3_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by way of ARC files and the WARC files made from them."""
    records = archive.archived(table(spark, sf_dir, "pages"))
    return records.select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_key").alias("refers_to"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as piece ids, and whether they decode to its text."""
    return sentencepiece.encoded(
        table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text")
    ).withColumnRenamed("_id", "doc_id")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document. The source owns it; its part in a language is the repository."""
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, F.concat_ws("/", "source", "lang"), F.col("source"))
    base = F.filter("spans", lambda s: s["rank"] < len(secret_scan.KINDS))
    kinds = F.transform("spans", lambda s: s.kind)
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
              for kind in secret_scan.KINDS]
    return found.select(
        "doc_id", *counts,
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s.live)).cast("long").alias("n_live"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document; counts and digest are of the base spans."""
    found = pii.found(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"))
    names = F.array(*[F.lit(k) for k in pii.KINDS])

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["rank"]), s.start.cast("string"), s.end.cast("string"))), ",")

    ranks = F.transform("base", lambda s: s["rank"])
    counts = [(F.size(ranks) - F.size(F.array_remove(ranks, i))).cast("long").alias(f"n_{kind}")
              for i, kind in enumerate(pii.KINDS)]
    return found.select(F.col("_id").alias("doc_id"), *counts,
                        F.sha2(listed("base"), 256).alias("base_sha256"),
                        listed("spans").alias("spans"))


def op8_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; those with remainder 0 teach nothing."""
    held_out = id_remainder(F.col("_id")) == 0
    found = pairwise_quality.ranked(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("doc_id"),
        F.col("text"), ~held_out)
    return found.select(F.col("_id").alias("doc_id"), held_out.alias("held_out"), "score", "predicted")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mix of sources takes."""
    return mixing.taken(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents, by shingles of four words."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4)
    return found.select(
        F.col("_id").alias("doc_id"), "n_shingles", "component_id",
        F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn by how much they read like the benchmark."""
    found = importance.resampled(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), F.col("doc_id"),
        F.col("text"), F.col("text"))
    return found.withColumnRenamed("_id", "doc_id")


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the strings of 400 bytes that occur more than once."""
    found = suffix_dedup.deduplicated(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"))
    return found.select(
        F.col("_id").alias("doc_id"), "n_bytes", "n_removed",
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ in their terms, and the terms that mark them."""
    return divergence.audited(table(spark, sf_dir, "documents"), F.col("text"), F.col("lang"),
                              F.col("source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_ngram_lm": op2_ngram_lm,
    "op3_archive": op3_archive,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_secret_scan": op5_secret_scan,
    "op6_ann": op6_ann,
    "op7_pii": op7_pii,
    "op8_pairwise_quality": op8_pairwise_quality,
    "op9_mixing": op9_mixing,
    "op10_minhash": op10_minhash,
    "op11_importance": op11_importance,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_divergence": op13_divergence,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
