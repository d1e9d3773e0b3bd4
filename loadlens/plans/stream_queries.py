"""Streaming queries: each drains its source with ``availableNow``, slice by slice, and returns what the stream stored."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.functions import round_half_even
from loadlens.plans import driver_tables as t
from loadlens.plans.log_queries import DELTA_SQL, LAG_SQL, PARSED, RISK_SQL, SECOND_SQL
from loadlens.plans.registry import query
from loadlens.session import scratch_path, store
from loadlens.sinks import files as sinks
from loadlens.streaming import operators as live
from loadlens.streaming.store import append_batches, drain, merge_batches, read_store
from loadlens.streaming.tail import appended_logs, ingest_appended


def _paths(spark, name):
    return scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")


@query(
    "stream_latency_histogram",
    f"""select variant, epoch_sec, count(*) as count, cast(printf('%.6f', cast(sum(latency_us) as double) / 1000 / count(*)) as double) as avg_ms, {SECOND_SQL}
        from txn group by all""",
)
def _(spark, sf):
    path, checkpoint = _paths(spark, "stream-histogram")
    for txn in t.txn_stream(spark, sf):
        drain(live.start_latency_counts(txn, ["variant"], path, checkpoint))
    merge_batches(spark, path, live.add_up(["variant", "epoch_sec", "latency_us"]))
    rows = live.latency_histogram_so_far(spark, path, ["variant"])
    return rows.withColumns({c: round_half_even(F.col(c), 6) for c in ("avg_ms", "p50_ms", "p95_ms", "p99_ms")})


@query(
    "stream_closed_seconds",
    """select epoch_sec, count(*) as count, cast(printf('%.6f', cast(sum(latency_us) as double) / 1000 / count(*)) as double) as avg_ms from txn
       where epoch_sec + 1 <= (select max(epoch_sec) from txn) - 10 group by epoch_sec""",
)
def _(spark, sf):
    # The last seconds are still open when the input ends: a second closes ten seconds after its end.
    path, checkpoint = _paths(spark, "stream-seconds")
    for txn in t.txn_stream(spark, sf, in_order=True):
        timed = txn.withColumn("at", F.timestamp_seconds("epoch_sec"))
        drain(
            live.closed_second_counts(timed, "at").writeStream.outputMode("append").format("parquet")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
        )
    return spark.read.parquet(path).withColumn("avg_ms", round_half_even(F.col("avg_ms"), 6))


@query("stream_decimate", "select variant, step, elapsed_sec, seq, lag_ms from lag_snapshot where seq % 4 = 0")
def _(spark, sf):
    path, checkpoint = _paths(spark, "stream-decimate")
    for txn in t.txn_stream(spark, sf):
        drain(append_batches(live.decimate(txn.selectExpr(*t.LAG_COLUMNS), "seq", 20, 5), path, checkpoint))
    merge_batches(spark, path)
    return read_store(spark, path).drop("batch_id")


@query("stream_lag_summary", f"select variant, step, {LAG_SQL} from lag_snapshot where lag_ms is not null group by all")
def _(spark, sf):
    path, checkpoint = _paths(spark, "stream-lag")
    for txn in t.txn_stream(spark, sf):
        drain(live.start_lag_counts(txn.selectExpr(*t.LAG_COLUMNS), ["variant", "step"], path, checkpoint))
    return live.lag_summary_so_far(spark, path, ["variant", "step"])


@query(
    "stream_lag_alert",
    f"select variant, step, seq, lag_ms, {RISK_SQL.format('lag_ms')} as dr_risk from lag_snapshot where lag_ms >= 100",
)
def _(spark, sf):
    path, checkpoint = _paths(spark, "stream-alert")
    for txn in t.txn_stream(spark, sf):
        drain(append_batches(live.lag_alerts(txn.selectExpr(*t.LAG_COLUMNS)), path, checkpoint))
    return read_store(spark, path).select("variant", "step", "seq", "lag_ms", "dr_risk")


@query("stream_snapshot_delta", DELTA_SQL)
def _(spark, sf):
    path, checkpoint = _paths(spark, "stream-delta")
    # The slices come out of order, so some snapshots follow a batch after those that come later in time.
    keys, order = ["variant", "step"], ["elapsed_sec", "seq"]
    for txn in t.txn_stream(spark, sf):
        drain(live.start_snapshots(txn.selectExpr(*t.STAT_COLUMNS), keys, order, path, checkpoint))
    merge_batches(spark, path)
    return live.snapshot_deltas_so_far(spark, path, keys, order)


@query(
    "stream_final_snapshot",
    """select variant, step, elapsed_sec, seq, calls, mean_ms from stat_snapshot
       qualify row_number() over (partition by variant, step order by elapsed_sec desc, seq desc) = 1""",
)
def _(spark, sf):
    keys, order = ["variant", "step"], ["elapsed_sec", "seq"]
    path, checkpoint = _paths(spark, "stream-final")
    for txn in t.txn_stream(spark, sf):
        drain(live.start_last_snapshots(txn.selectExpr(*t.STAT_COLUMNS), keys, order, path, checkpoint))
    merge_batches(spark, path, live.keep_last(keys, order))
    return live.final_snapshots(spark, path, keys, order)


@query("stream_txn_ingest", f"select variant as runset, operation as run, step, {', '.join(PARSED[3:])} from parsed")
def _(spark, sf):
    logs = scratch_path(spark, "txn-log")
    sinks.write_txn_log(t.txn_line(spark, sf).withColumnsRenamed({"variant": "runset", "operation": "run"}), logs)
    path, checkpoint = _paths(spark, "stream-ingest")
    drain(append_batches(live.txn_log_stream(spark, logs, files_per_batch=20), path, checkpoint))
    return read_store(spark, path).drop("batch_id")


#: How late a row may come where a stream closes seconds or forgets rows: longer than a slice of the fixture.
LATE = 400


def _timed(txn, second="epoch_sec"):
    return txn.withColumn("at", F.timestamp_seconds(second))


def _to_parquet(rows, path, checkpoint):
    drain(rows.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))


@query(
    "stream_closed_percentiles",
    f"""select variant, epoch_sec, count(*) as count, cast(printf('%.6f', cast(sum(latency_us) as double) / 1000 / count(*)) as double) as avg_ms, {SECOND_SQL}
        from txn where epoch_sec + 1 <= (select max(epoch_sec) from txn) - {LATE} group by variant, epoch_sec""",
)
def _(spark, sf):
    path, checkpoint = _paths(spark, "stream-percentiles")
    for txn in t.txn_stream(spark, sf, late=True):
        _to_parquet(live.closed_second_percentiles(_timed(txn), "at", f"{LATE} seconds", ["variant"]), path, checkpoint)
    return spark.read.parquet(path).withColumns({c: round_half_even(F.col(c), 6) for c in ("avg_ms", "p50_ms", "p95_ms", "p99_ms")})


@query("stream_intervals", DELTA_SQL.replace("from seen", f"from seen where elapsed_sec < (select max(elapsed_sec) from stat_snapshot) - {LATE}"))
def _(spark, sf):
    path, checkpoint = _paths(spark, "stream-intervals")
    for txn in t.txn_stream(spark, sf, late=True):
        snapshots = txn.selectExpr(*t.STAT_COLUMNS, "timestamp_seconds(epoch_sec) as at")
        _to_parquet(live.interval_stream(snapshots, ["variant", "step"], "at", f"{LATE} seconds"), path, checkpoint)
    return spark.read.parquet(path)


@query(
    "stream_running_lag",
    f"""select slice, variant, step, {LAG_SQL} from lag_snapshot, (select cast(unnest([0, 1, 2, 3]) as integer) as slice)
        where lag_ms is not null and (seq % 4 + 1) % 4 <= slice group by slice, variant, step""",
)
def _(spark, sf):
    # What a reader sees after each of the four slices.
    path, checkpoint = _paths(spark, "stream-running-lag")
    keys, seen = ["variant", "step"], []
    for n, txn in enumerate(t.txn_stream(spark, sf)):
        drain(live.start_running_lag(txn.selectExpr(*t.LAG_COLUMNS), keys, path, checkpoint))
        seen.append(store(live.running_lag(spark, path, keys).select(F.lit(n).alias("slice"), "*"), "running-lag"))
    return seen[0].unionByName(seen[1]).unionByName(seen[2]).unionByName(seen[3])


TXN_KEY = ["variant", "operation", "step", "client_id", "txn_no"]


@query("stream_without_repeats", f"select {', '.join(TXN_KEY)}, latency_us, epoch_sec, epoch_us from txn")
def _(spark, sf):
    path, checkpoint = _paths(spark, "stream-repeats")
    for txn in t.txn_stream(spark, sf, again=True):
        _to_parquet(live.without_repeats(_timed(txn), "at", TXN_KEY, f"{LATE} seconds"), path, checkpoint)
    return spark.read.parquet(path).select(*TXN_KEY, "latency_us", "epoch_sec", "epoch_us")


@query(
    "stream_decimate_counted",
    """select variant, step, event_id as seq, number from (select variant, step, event_id, row_number() over (partition by variant, step order by ts, event_id) - 1 as number
       from txn join events on event_id = txn_no) where number % 4 = 0""",
)
def _(spark, sf):
    path, checkpoint = _paths(spark, "stream-counted")
    for txn in t.txn_stream(spark, sf, in_order=True):
        polls = txn.selectExpr("variant", "step", "txn_no as seq", "at_us")
        _to_parquet(live.decimate_counted(polls, ["variant", "step"], ["at_us", "seq"], 4), path, checkpoint)
    return spark.read.parquet(path).select("variant", "step", "seq", "number")


@query("stream_appended_logs", f"select variant as runset, operation as run, step, {', '.join(PARSED[3:])} from parsed where not (operation = 'signup' and txn_no % 4 < 2)")
def _(spark, sf):
    # Four passes over growing files; those of one operation are begun anew before the third.
    root, path = scratch_path(spark, "growing"), scratch_path(spark, "appended")
    for _step in t.growing_logs(spark, sf, root):
        ingest_appended(spark, root, path, part_bytes=1 << 16)
    return appended_logs(spark, path).drop("file")
