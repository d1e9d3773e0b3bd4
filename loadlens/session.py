"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """A small local session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loadlens")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", None):  # it can't be set later; this one machine shares its temporary folder
        spark.stop()
        spark = builder.config("spark.checkpoint.dir", os.path.join(tempfile.gettempdir(), "loadlens-scratch")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int, executor_cores: int) -> dict[str, str]:
    """Settings for a large input: shuffle partitions near 128 MB, never fewer than the cores.

    AQE merges what turns out small and cuts what turns out skewed, so the count errs high.
    """
    partitions = str(max(executor_cores, -(-input_bytes // (128 << 20))))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.session.timeZone": "UTC",
    }


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, which must be set, on a local master too."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return shared.rstrip("/")


def _session_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/loadlens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this session's part of the shared folder; never reused, so nothing is overwritten."""
    return f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove all scratch data of this session. Results that still read it must have been written or shown before."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: used where two results need the same expensive input."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
