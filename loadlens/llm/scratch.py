"""Intermediate tables in the shared folder, and their removal once they are superseded."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.session import scratch_path


_open: list[list[str]] = []


def write(df: DataFrame, name: str) -> str:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir``; returns the path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    for paths in _open:
        paths.append(path)
    return path


@contextmanager
def passing(spark: SparkSession) -> Iterator[list[str]]:
    """Tables written inside are removed at the end; take the paths of those that stay out of the list."""
    paths: list[str] = []
    _open.append(paths)
    try:
        yield paths
    finally:
        _open.remove(paths)
        for path in paths:
            discard(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write and read back: cuts lineage, so that a lost executor repeats little."""
    return df.sparkSession.read.schema(df.schema).parquet(write(df, name))


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many signs behind it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_apart(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` in a shuffle of its own, so that adaptive execution can cut a hot key on the left.

    When ``right`` is an aggregation by the same key, its partitioning would serve the join as well, and a partition
    that an aggregation has read is never cut. The hash as a second join key asks for a new one on both sides.
    """
    both = "_apart"
    keyed = (df.withColumn(both, F.xxhash64(F.col(key))) for df in (left, right))
    one, two = keyed
    return one.join(two, [key, both], how).drop(both)


@functools.cache
def warm() -> None:
    """Once per Python worker: one thread for the numeric libraries, as Spark gives each task one core."""
    import os

    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "RAYON_NUM_THREADS"):
        os.environ.setdefault(name, "1")
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
