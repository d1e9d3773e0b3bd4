"""Micro-batches into a Parquet store, one folder per batch, merged now and then.

A batch that runs again after a lost executor overwrites its own folder, so results are
exactly-once without any transaction log of our own. ``merge_batches`` folds the closed
batches into one table, so that a long stream does not leave a folder for every trigger.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    transform: Callable[[DataFrame, int], DataFrame] = lambda batch, _: batch,
    available_now: bool = True,
) -> StreamingQuery:
    """Run ``transform`` on every micro-batch and keep its result under ``path/batch_id=<n>``."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        transform(batch, batch_id).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def drain(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _folders(spark: SparkSession, path: str) -> tuple[dict[int, str], dict[int, str]]:
    """Finished batch folders and merged folders by number."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    batches, merged = {}, {}
    for status in fs.listStatus(root) if fs.exists(root) else []:
        found = re.fullmatch(r"(batch_id|merged)=(\d+)", status.getPath().getName())
        where = f"{path}/{status.getPath().getName()}"
        if found and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{where}/_SUCCESS")):
            (batches if found[1] == "batch_id" else merged)[int(found[2])] = where
    return batches, merged


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """All that is stored: the newest merged table and the batches after it, with ``batch_id``
    (that of a merged row is the last batch it covers)."""
    batches, merged = _folders(spark, path)
    upto = max(merged, default=-1)
    parts = [spark.read.parquet(merged[upto]).withColumn("batch_id", F.lit(upto).cast("bigint"))] if merged else []
    later = [batches[n] for n in sorted(batches) if n > upto]
    if later:
        parts.append(spark.read.option("basePath", path).parquet(*later).withColumn("batch_id", F.col("batch_id").cast("bigint")))
    if not parts:
        raise FileNotFoundError(f"nothing is stored below {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def merge_batches(
    spark: SparkSession, path: str, combine: Callable[[DataFrame], DataFrame] = lambda rows: rows, keep: int = 2
) -> int:
    """Fold all but the last ``keep`` batches into one table and remove them; returns the last batch folded (-1: none).

    ``combine`` shrinks the rows (adds up counts, keeps last snapshots). The merged table counts once it is
    complete, so a failed merge changes nothing; a reader takes the newest and skips what it covers. The last
    batches stay apart because the stream may still run them again.
    """
    batches, merged = _folders(spark, path)
    upto = max(merged, default=-1)
    closed = [n for n in sorted(batches) if n > upto][: -keep or None]
    if not closed:
        return upto
    last = closed[-1]
    rows = spark.read.option("basePath", path).parquet(*[batches[n] for n in closed]).drop("batch_id")
    if merged:
        rows = rows.unionByName(spark.read.parquet(merged[upto]))
    combine(rows).write.mode("overwrite").parquet(f"{path}/merged={last}")
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for old in [*[batches[n] for n in batches if n <= last], *merged.values()]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(old), True)
    return last


# -- keyed upserts --------------------------------------------------------------------------------
# <path>/version=<batch>/bucket__=<n>: a batch writes only the buckets of the keys it has, from their newest version before it.

def _versions(spark: SparkSession, path: str, before: int | None = None) -> dict[int, list[int]]:
    """Complete versions of every bucket, ascending: at most a few per bucket."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[int, list[int]] = {}
    for status in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/bucket__=*")) or []:
        where = status.getPath()
        version, bucket = int(where.getParent().getName().split("=")[1]), int(where.getName().split("=")[1])
        if (before is None or version < before) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={version}/_SUCCESS")):
            out.setdefault(bucket, []).append(version)
    return {b: sorted(v) for b, v in out.items()}


def upsert(
    batch: DataFrame, batch_id: int, path: str, keys: list[str], combine: Callable[[DataFrame], DataFrame], buckets: int = 16
) -> list[int]:
    """Merge ``batch`` into the store at ``path``; returns the buckets it touched (at most ``buckets``).

    ``combine`` makes the stored rows of old and new ones. Only the buckets of the batch's keys are read and written. A batch
    that runs again starts from the versions before it and writes the same; superseded versions are removed, all but the
    one a repetition needs.
    """
    spark = batch.sparkSession
    fresh = batch.withColumn("bucket__", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    touched = sorted(r["bucket__"] for r in fresh.select("bucket__").distinct().collect())
    if not touched:
        return []
    versions = _versions(spark, path, batch_id)
    old = [f"{path}/version={versions[b][-1]}/bucket__={b}" for b in touched if b in versions]
    rows = fresh.drop("bucket__")
    if old:
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(*old))
    merged = combine(rows).withColumn("bucket__", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    merged.write.mode("overwrite").partitionBy("bucket__").parquet(f"{path}/version={batch_id}")
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for b in touched:
        for version in versions.get(b, [])[:-1]:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={version}/bucket__={b}"), True)
    return touched


def read_upserts(spark: SparkSession, path: str, schema: str, buckets: list[int] | None = None) -> DataFrame:
    """The newest version of every bucket, or of some."""
    versions = _versions(spark, path)
    folders = [f"{path}/version={v[-1]}/bucket__={b}" for b, v in versions.items() if buckets is None or b in buckets]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
