"""Where intermediate tables live, and how long lineages are cut.

Everything goes to the folder the cluster names in ``spark.checkpoint.dir``, so a
lost executor never takes an intermediate result with it. Each application has a folder of its
own there, which goes when its driver's Python ends.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one only in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="graphfeed-"))
    return sc.getCheckpointDir()


_own_folders: set[str] = set()


def _remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of this application; nothing to do if its JVM is gone already."""
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's folder below the shared one."""
    own = f"{shared_dir(spark).rstrip('/')}/graphfeed/{spark.sparkContext.applicationId}"
    if own not in _own_folders:
        _own_folders.add(own)
        atexit.register(_remove, spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder: the lineage ends there.

    Unlike a checkpoint it is columnar, and Catalyst knows its true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """As ``stored``, with rows of equal ``keys`` in one bucket: joins on them do not move it."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    (df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys)
     .option("path", scratch_path(spark, name)).saveAsTable(table))
    atexit.register(_forget, spark, table)
    return spark.table(table)


def _forget(spark: SparkSession, table: str) -> None:
    with contextlib.suppress(Exception):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
