"""A local session for tests, checks and the benchmark.

On a cluster the session comes from ``spark-submit``; set ``spark.checkpoint.dir`` there, and
``spark.cleaner.referenceTracking.cleanCheckpoints`` so that old passes are removed.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS") or "8"
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("graphfeed")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.extraJavaOptions", "-XX:+UseParallelGC")
        # sums of one ranking task fit the fast map of the hash aggregate
        .config("spark.sql.codegen.aggregate.fastHashMap.capacityBit", "20")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="graphfeed-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
