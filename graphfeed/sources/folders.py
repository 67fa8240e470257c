"""Listing and removing folders of tables, wherever the table lives."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if there is no such path."""
    fs, root = _located(spark, path)
    if not fs.exists(root):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the write of the folder came to its end."""
    fs, marker = _located(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def remove(spark: SparkSession, path: str) -> None:
    fs, root = _located(spark, path)
    fs.delete(root, True)
