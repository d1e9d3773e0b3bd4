"""Live twins of the log, snapshot and lag results.

Histogram and lag summary need exact percentiles, which no bounded stream state can hold for
a hot second or step. So the stream keeps value counts per micro-batch (they add up, in any
order and however late) and the percentiles are taken from the store when it is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from loadlens.functions import dr_risk
from loadlens.operators.lag import lag_columns
from loadlens.operators.latency import SECOND_SHARES, histogram_of_counts, parse_txn_lines
from loadlens.operators.ordered import distribution, value_counts
from loadlens.operators.statements import last_snapshot, snapshot_delta
from loadlens.sources.files import step_levels
from loadlens.streaming.store import _folders, append_batches, read_store, read_upserts, upsert


# -- transaction log ------------------------------------------------------------------------

def txn_log_stream(spark: SparkSession, root: str, files_per_batch: int | None = None) -> DataFrame:
    """Live parse of closed log files, with run set, run and step from their folders.

    A file is read once, when it is first seen: logs must arrive complete (moved in, or rotated). Files that
    are still written to belong to ``ingest_growing_logs``.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", "pgbench_log*")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_txn_lines(reader.text(root).select(*step_levels(), F.col("value").alias("line")))


def ingest_growing_logs(spark: SparkSession, root: str, path: str) -> int:
    """One pass over log files that may still grow; returns the number of files read. Call it again at will.

    A file that is new, or of another length or time of change than at its last reading, is read whole, and its rows
    replace those of before (see ``growing_logs``), so a half-written last line is corrected by the next pass, and a log
    that was cut or begun anew under its name is read again. Lengths and times seen are stored with each batch; a pass
    that fails leaves no complete batch and is repeated.
    """
    batches, _ = _folders(spark, path)
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "pgbench_log*")
        .load(root).select(F.col("path").alias("file"), "length", "modificationTime")
    )  # the content is not read
    if batches:
        # batches of before the times were stored have null there: such files are read once more
        stored = spark.read.schema("file string, length bigint, modificationTime timestamp, batch_id bigint").option("basePath", f"{path}/sizes")
        seen = stored.parquet(*[f"{path}/sizes/batch_id={n}" for n in batches]).groupBy("file").agg(
            F.max_by(F.struct("length", "modificationTime"), "batch_id").alias("known")
        )
        files = files.join(seen, "file", "left").where(~F.struct("length", "modificationTime").eqNullSafe(F.col("known"))).drop("known")
    number = max(batches, default=-1) + 1
    files.write.mode("overwrite").parquet(f"{path}/sizes/batch_id={number}")
    grown = spark.read.parquet(f"{path}/sizes/batch_id={number}")
    names = [r.file for r in grown.select("file").collect()]  # the files of one pass
    if not names:
        return 0
    lines = spark.read.text(names).select(*step_levels(), F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    parse_txn_lines(lines).write.mode("overwrite").parquet(f"{path}/batch_id={number}")
    return len(names)


def growing_logs(spark: SparkSession, path: str) -> DataFrame:
    """What ``ingest_growing_logs`` has stored: of each file the rows of its last reading."""
    batches, _ = _folders(spark, path)
    sizes = spark.read.option("basePath", f"{path}/sizes").parquet(*[f"{path}/sizes/batch_id={n}" for n in batches])
    newest = sizes.groupBy(F.regexp_replace("file", "^file:/+", "file:///").alias("file")).agg(F.max("batch_id").cast("bigint").alias("batch_id"))
    rows = read_store(spark, path).withColumn("file", F.regexp_replace("file", "^file:/+", "file:///"))
    return rows.join(newest, ["file", "batch_id"], "left_semi").drop("batch_id")


def start_latency_counts(txn: DataFrame, keys: Sequence[str], path: str, checkpoint: str, **options):
    """Keep (keys, second, latency, n) per micro-batch."""
    columns = [*keys, "epoch_sec"]
    return append_batches(txn, path, checkpoint, lambda batch, _: value_counts(batch, columns, "latency_us"), **options)


def latency_histogram_so_far(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame:
    """The per-second histogram of everything stored up to now; late rows are simply part of it."""
    return histogram_of_counts(read_store(spark, path), [*keys, "epoch_sec"], freq="n")


def add_up(keys: Sequence[str]):
    """For ``merge_batches`` on a store of counts: one row per key."""
    return lambda rows: rows.groupBy(*keys).agg(F.sum("n").alias("n"))


def closed_second_counts(txn: DataFrame, event_time: str, late: str = "10 seconds") -> DataFrame:
    """Watermarked count and mean per second for a running dashboard: a second is emitted once, when it closes."""
    return (
        txn.withWatermark(event_time, late)
        .groupBy(F.window(event_time, "1 second").alias("second"))
        .agg(F.count(F.lit(1)).alias("count"), (F.avg("latency_us") / F.lit(1000.0)).alias("avg_ms"))
        .select(F.unix_seconds("second.start").alias("epoch_sec"), "count", "avg_ms")
    )


def closed_second_percentiles(txn: DataFrame, event_time: str, late: str = "10 seconds", keys: Sequence[str] = ()) -> DataFrame:
    """Exact percentiles inside the stream: a second is emitted once, with count, mean and percentiles, when it closes.

    Two aggregations in a row: first counts per (second, latency), whose state is a number per different latency of the open
    seconds, then the weighted percentiles of each closed second. Rows that are later than ``late`` are left out.
    """
    counts = (
        txn.withWatermark(event_time, late)
        .groupBy(F.window(event_time, "1 second").alias("second"), *keys, "latency_us")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("n")
    closed = counts.groupBy(F.window("second", "1 second").alias("closed"), *keys).agg(
        total.alias("count"), (F.sum(F.col("latency_us") * F.col("n")) / F.lit(1000.0) / total).alias("avg_ms"),
        F.percentile("latency_us", list(SECOND_SHARES.values()), F.col("n")).alias("shares"),
    )
    shares = [(F.col("shares")[i] / F.lit(1000.0)).alias(name) for i, name in enumerate(SECOND_SHARES)]
    return closed.select(*keys, F.unix_seconds("closed.start").alias("epoch_sec"), "count", "avg_ms", *shares)


def without_repeats(txn: DataFrame, event_time: str, keys: Sequence[str], late: str) -> DataFrame:
    """Rows that are delivered again within ``late`` count once; what is remembered of a row is dropped behind the watermark."""
    return txn.withWatermark(event_time, late).dropDuplicatesWithinWatermark(list(keys))


# -- lag ------------------------------------------------------------------------------------

def decimate(polls: DataFrame, seq: str, lag_interval_sec: int, poll_interval_sec: int) -> DataFrame:
    """Every k-th poll, k = lag interval over poll interval, at least 1."""
    k = max(1, lag_interval_sec // max(1, poll_interval_sec))
    return polls.where(F.pmod(F.col(seq), F.lit(k)) == 0)


def decimate_counted(polls: DataFrame, keys: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """Every k-th poll per ``keys``, counted from 0 by the stream itself: the state holds how many there were, so it does not
    matter where the micro-batches are cut. Polls of one key must arrive in ``order``, batch by batch; ``number`` is added.

    A key's polls of one batch meet in one task: a poller makes one every few seconds. ``maxFilesPerTrigger`` bounds a batch.
    """
    kinds = StructType([*polls.schema.fields, StructField("number", LongType())])

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get[0] if state.exists else 0
        rows = pd.concat(list(frames), ignore_index=True).sort_values(list(order), kind="stable")
        rows["number"] = before + np.arange(len(rows))
        state.update((before + len(rows),))
        yield rows[rows["number"] % k == 0]

    return polls.groupBy(*keys).applyInPandasWithState(run, kinds, "n bigint", "append", GroupStateTimeout.NoTimeout)


LAG_COUNTS = "lag_ms double, n bigint"


def start_running_lag(lag: DataFrame, keys: Sequence[str], path: str, checkpoint: str, **options):
    """A running lag summary: after every micro-batch the summaries of the keys it touched are written anew, exactly.

    Value counts are kept in hash buckets of the keys, of which a batch rewrites only those it touches.
    """
    keys = list(keys)
    return append_batches(lag, f"{path}/updates", checkpoint, lambda batch, number: running_lag_update(batch, number, keys, path), **options)


def running_lag_update(batch: DataFrame, batch_id: int, keys: list[str], path: str) -> DataFrame:
    """One batch of ``start_running_lag``; repeated, it changes nothing."""
    spark = batch.sparkSession
    fresh = value_counts(batch, keys, "lag_ms").select(*keys, "lag_ms", "n")
    counts = f"{path}/counts"
    add = lambda rows: rows.groupBy(*keys, "lag_ms").agg(F.sum("n").alias("n"))
    touched = upsert(fresh, batch_id, counts, keys, add)
    kept = read_upserts(spark, counts, fresh.schema.toDDL() if not touched else fresh.schema, touched)
    mine = kept.join(fresh.select(*keys).distinct(), keys, "left_semi")
    return lag_columns(distribution(mine, keys, "lag_ms", nearest={"p95": 0.95}, freq="n"), keys)


def running_lag(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest summary of every key."""
    rows = read_store(spark, f"{path}/updates")
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("last")).select(*keys, "last.*")


def start_lag_counts(lag: DataFrame, keys: Sequence[str], path: str, checkpoint: str, **options):
    """Keep (keys, lag, n) per micro-batch."""
    return append_batches(lag, path, checkpoint, lambda batch, _: value_counts(batch, keys, "lag_ms"), **options)


def lag_summary_so_far(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    return lag_columns(distribution(read_store(spark, path), keys, "lag_ms", nearest={"p95": 0.95}, freq="n"), keys)


def lag_alerts(lag: DataFrame, lag_column: str = "lag_ms") -> DataFrame:
    """Snapshots in the Warning and High Risk bands; stateless, so it streams as it is."""
    return lag.withColumn("dr_risk", dr_risk(F.col(lag_column))).where(F.col("dr_risk").isin("Warning", "High Risk"))


# -- cumulative statement snapshots ----------------------------------------------------------

def start_snapshots(snapshots: DataFrame, keys: Sequence[str], order: Sequence[str], path: str, checkpoint: str, **options):
    """Keep the cumulative snapshots of a stream; intervals are taken when the store is read."""
    columns = [*keys, *order, "calls", "mean_ms"]
    return append_batches(snapshots, path, checkpoint, lambda batch, _: batch.select(*columns), **options)


def snapshot_deltas_so_far(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], bucket: Column | None = None
) -> DataFrame:
    """Per-interval values of everything stored up to now. A snapshot that came late is simply in its place."""
    return snapshot_delta(read_store(spark, path).drop("batch_id"), list(keys), list(order), bucket)


PENDING = "calls bigint, mean double, at array<bigint>, sec array<bigint>, seq array<bigint>, all_calls array<bigint>, all_means array<double>"


def interval_stream(snapshots: DataFrame, keys: Sequence[str], event_time: str, late: str) -> DataFrame:
    """Intervals as they happen: (keys, elapsed_sec, seq, interval_calls, interval_mean_ms), each once.

    A snapshot (elapsed_sec, seq, calls, mean_ms) waits in keyed state until the watermark has passed its second; then it
    leaves in order, with the difference to the one before. Fewer calls than before mean a reset: null. What comes later than
    ``late`` is left out. The state holds the last values and the snapshots of the last ``late``; a step's snapshots meet in
    one task per batch, a poller making one every few seconds.
    """
    from pyspark.sql.types import DoubleType, StructField as Field

    kinds = StructType([
        *[snapshots.schema[k] for k in keys], Field("elapsed_sec", LongType()), Field("seq", LongType()), Field("interval_calls", LongType()),
        Field("interval_mean_ms", DoubleType()),
    ])

    columns = ["at", "elapsed_sec", "seq", "calls", "mean_ms"]

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        calls, mean, *held = state.get if state.exists else (0, 0.0, [], [], [], [], [])
        rows = pd.DataFrame(dict(zip(columns, map(list, held), strict=True)))
        more = [f.assign(at=f[event_time].astype("datetime64[ms]").astype("int64"))[columns] for f in frames] if not state.hasTimedOut else []
        full = [r for r in (rows, *more) if len(r)]
        rows = (pd.concat(full, ignore_index=True) if full else rows).sort_values(["elapsed_sec", "seq"], kind="stable")
        closed = rows["at"] < state.getCurrentWatermarkMs()
        ready, left = rows[closed], rows[~closed]
        if len(ready):
            now, means = ready["calls"].to_numpy(np.int64), ready["mean_ms"].to_numpy(float)
            before, before_mean = np.concatenate([[calls], now[:-1]]), np.concatenate([[mean], means[:-1]])
            n = now - before
            spent = means * now - before_mean * before
            with np.errstate(divide="ignore", invalid="ignore"):
                each = spent / n
            out = pd.DataFrame({k: [v] * len(ready) for k, v in zip(keys, key, strict=True)})
            out["elapsed_sec"], out["seq"] = ready["elapsed_sec"].to_numpy(), ready["seq"].to_numpy()
            out["interval_calls"] = pd.array(n, "Int64").copy()
            out.loc[n < 0, "interval_calls"] = pd.NA
            out["interval_mean_ms"] = np.where(n > 0, each, np.nan)
            out["interval_mean_ms"] = out["interval_mean_ms"].astype(object).where(n > 0, None)
            calls, mean = int(now[-1]), float(means[-1])
            yield out
        state.update((calls, mean, *[left[c].astype(float if c == "mean_ms" else int).tolist() for c in columns]))
        if len(left):
            state.setTimeoutTimestamp(int(left["at"].min()) + 1)

    timed = snapshots.withWatermark(event_time, late)
    return timed.groupBy(*keys).applyInPandasWithState(run, kinds, PENDING, "append", GroupStateTimeout.EventTimeTimeout)


def start_last_snapshots(
    snapshots: DataFrame, keys: Sequence[str], order: Sequence[str], path: str, checkpoint: str, **options
):
    """Keep the last snapshot per step of each batch; an ``availableNow`` run drains what is left after the end."""
    return append_batches(
        snapshots, path, checkpoint, lambda batch, _: last_snapshot(batch, keys, list(order)), **options
    )


def final_snapshots(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return last_snapshot(read_store(spark, path).drop("batch_id"), keys, list(order))


def keep_last(keys: Sequence[str], order: Sequence[str]):
    """For ``merge_batches`` on a store of last snapshots: one row per step."""
    return lambda rows: last_snapshot(rows, list(keys), list(order))
