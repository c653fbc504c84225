"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL_ROOTS: dict[str, str] = {}
_WRITTEN: list[str] = []


def local_session(cpus: int = 8, **extra: str) -> SparkSession:
    """Session for tests and the benchmark. On a cluster, pass your own session to the library."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("temperament")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in extra.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder.

    Only a local session without that setting gets a temporary folder of its own: on a cluster the
    executors could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="temperament-")
        root = _LOCAL_ROOTS[app]
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def discard_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables that this process has asked for so far, once nothing reads them any more.

    Returns how many there were.
    """
    count = 0
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        count += 1
    return count


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the scratch folder and read it back.

    Cuts the lineage of an iterative job; the written table outlives any lost executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
