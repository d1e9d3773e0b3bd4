import os

import pytest
from pyspark.sql import functions as F

from loadlens.operators.lag import lag_summary
from loadlens.operators.latency import latency_histogram
from loadlens.operators.statements import snapshot_delta
from loadlens.plans import driver_tables
from loadlens.plans.catalog import QUERIES
from loadlens.plans.driver_tables import BATCHES
from loadlens.session import _session_folder
from loadlens.streaming import operators as live
from loadlens.streaming.store import append_batches, drain, merge_batches, read_store

SCHEMA = "step string, elapsed_sec int, epoch_sec bigint, latency_us bigint, lag_ms double, calls bigint, mean_ms double"


@pytest.fixture
def source(spark, tmp_path):
    """Three files in arrival order, one micro-batch each; seconds straddle the files."""
    path = str(tmp_path / "in")
    rows = [(f"s{i % 2}", i, 1700000000 + i // 7, (i * 7919) % 5000, float(i % 13) * 100 if i % 5 else None,
             i * 3 if i % 20 else 1, float(i % 9)) for i in range(90)]
    for n in range(3):
        spark.createDataFrame(rows[n * 30:(n + 1) * 30], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def _stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_histogram_of_the_stream_equals_the_batch(spark, source, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for _ in range(2):  # the second start finds nothing new
        drain(live.start_latency_counts(_stream(spark, source), ["step"], out, ck))
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("batch_id=")]) == 3
    assert _rows(live.latency_histogram_so_far(spark, out, ["step"])) == _rows(latency_histogram(spark.read.parquet(source), ["step"]))


def test_a_repeated_batch_rewrites_itself(spark, source, tmp_path):
    batch = spark.read.parquet(source)
    out = str(tmp_path / "out")
    drain(append_batches(_stream(spark, source), out, str(tmp_path / "ck1")))
    drain(append_batches(_stream(spark, source), out, str(tmp_path / "ck2")))
    assert spark.read.parquet(out).count() == batch.count()


def test_lag_summary_and_alerts(spark, source, tmp_path):
    drain(live.start_lag_counts(_stream(spark, source), ["step"], str(tmp_path / "o"), str(tmp_path / "c")))
    batch = spark.read.parquet(source)
    assert _rows(live.lag_summary_so_far(spark, str(tmp_path / "o"), ["step"])) == _rows(lag_summary(batch, ["step"]))
    drain(append_batches(live.lag_alerts(_stream(spark, source)), str(tmp_path / "a"), str(tmp_path / "ca")))
    alerts = spark.read.parquet(str(tmp_path / "a"))
    assert alerts.count() == batch.where("lag_ms >= 100").count()
    assert {r.dr_risk for r in alerts.collect()} == {"Warning", "High Risk"}


def test_deltas_carry_over_batches(spark, source, tmp_path):
    order = ["elapsed_sec"]
    drain(live.start_snapshots(_stream(spark, source), ["step"], order, str(tmp_path / "o"), str(tmp_path / "c")))
    got = live.snapshot_deltas_so_far(spark, str(tmp_path / "o"), ["step"], order)
    assert _rows(got) == _rows(snapshot_delta(spark.read.parquet(source), ["step"], order))


def test_a_late_snapshot_takes_its_place(spark, tmp_path):
    path = str(tmp_path / "in")
    for times in ((10, 30), (20, 40)):
        rows = [("s", at, 0, 0, 0.0, at * 10, 1.0) for at in times]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    drain(live.start_snapshots(_stream(spark, path), ["step"], ["elapsed_sec"], str(tmp_path / "o"), str(tmp_path / "c")))
    got = live.snapshot_deltas_so_far(spark, str(tmp_path / "o"), ["step"], ["elapsed_sec"]).orderBy("elapsed_sec").collect()
    assert [(r.elapsed_sec, r.interval_calls) for r in got] == [(10, 100), (20, 100), (30, 100), (40, 100)]


def test_the_default_bucket_follows_the_order(spark):
    rows = [("s", i, (7 - i) * 1_000_000, (i + 1) * 10, 1.0) for i in range(4)]
    frame = spark.createDataFrame(rows, "step string, elapsed_sec int, seq bigint, calls bigint, mean_ms double")
    got = snapshot_delta(frame, ["step"], ["elapsed_sec", "seq"]).orderBy("elapsed_sec").collect()
    assert [r.interval_calls for r in got] == [10, 10, 10, 10]


def test_merged_stores_read_the_same(spark, source, tmp_path):
    out, keys = str(tmp_path / "out"), ["step", "epoch_sec", "latency_us"]
    drain(live.start_latency_counts(_stream(spark, source), ["step"], out, str(tmp_path / "ck")))
    before = _rows(live.latency_histogram_so_far(spark, out, ["step"]))
    assert merge_batches(spark, out, live.add_up(keys)) == 0 and merge_batches(spark, out, live.add_up(keys), keep=0) == 2
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["merged=2"]
    assert _rows(live.latency_histogram_so_far(spark, out, ["step"])) == before
    # a merge that did not end is not seen
    (tmp_path / "out" / "merged=9").mkdir()
    assert _rows(live.latency_histogram_so_far(spark, out, ["step"])) == before


def test_final_snapshots(spark, source, tmp_path):
    keys, order = ["step"], ["elapsed_sec"]
    stream = _stream(spark, source).select("step", "elapsed_sec", "calls")
    drain(live.start_last_snapshots(stream, keys, order, str(tmp_path / "o"), str(tmp_path / "c")))
    assert {(r.step, r.elapsed_sec) for r in live.final_snapshots(spark, str(tmp_path / "o"), keys, order).collect()} == {("s0", 88), ("s1", 89)}


def test_closed_log_files(spark, tmp_path):
    step = tmp_path / "logs" / "set" / "run" / "step"
    step.mkdir(parents=True)
    out, ck = str(tmp_path / "o"), str(tmp_path / "c")
    (step / "pgbench_log.1").write_text("1 2 300 0 1700000000 5\nbroken\n")
    (step / "pgbench.log").write_text("1 2 300 0 1700000000 5\n")
    drain(append_batches(live.txn_log_stream(spark, str(tmp_path / "logs")), out, ck))
    (step / "pgbench_log.2").write_text("1 3 400 0 1700000001 5\n")
    drain(append_batches(live.txn_log_stream(spark, str(tmp_path / "logs")), out, ck))
    rows = read_store(spark, out).collect()
    assert sorted((r.runset, r.run, r.step, r.latency_us) for r in rows) == [("set", "run", "step", 300), ("set", "run", "step", 400)]


def test_growing_log_files(spark, tmp_path):
    """Lines appended to a file that was read before, a line that was cut in two, a new file, and a pass without news."""
    step = tmp_path / "logs" / "runset=a" / "run=r" / "step=s"
    step.mkdir(parents=True)
    out, log = str(tmp_path / "o"), step / "pgbench_log.1"
    line = lambda i: f"1 {i} {100 + i} 0 1700000000 5\n"
    log.write_text("".join(map(line, range(10))) + "1 10 11")
    assert live.ingest_growing_logs(spark, str(tmp_path / "logs"), out) == 1
    assert live.growing_logs(spark, out).count() == 10
    log.write_text("".join(map(line, range(30))))
    (step / "pgbench_log.2").write_text(line(30))
    assert live.ingest_growing_logs(spark, str(tmp_path / "logs"), out) == 2
    assert live.ingest_growing_logs(spark, str(tmp_path / "logs"), out) == 0
    rows = live.growing_logs(spark, out).collect()
    assert sorted(r.txn_no for r in rows) == list(range(31)) and {(r.runset, r.run, r.step) for r in rows} == {("a", "r", "s")}


def test_a_log_begun_anew_is_read_again(spark, tmp_path):
    """Shorter than before, then longer but still below its greatest length, then of equal length with other lines."""
    step = tmp_path / "logs" / "runset=a" / "run=r" / "step=s"
    step.mkdir(parents=True)
    out, log = str(tmp_path / "o"), step / "pgbench_log.1"
    for n, (low, high) in enumerate([(10, 40), (50, 55), (50, 60), (60, 70)]):
        log.write_text("".join(f"1 {i} {100 + i} 0 1700000000 5\n" for i in range(low, high)))
        os.utime(log, (1_700_000_000 + n, 1_700_000_000 + n))
        assert live.ingest_growing_logs(spark, str(tmp_path / "logs"), out) == 1
        assert sorted(r.txn_no for r in live.growing_logs(spark, out).collect()) == list(range(low, high))
    assert live.ingest_growing_logs(spark, str(tmp_path / "logs"), out) == 0


def test_slices_are_written_by_all_tasks(spark, tmp_path):
    """Each slice of the driver's events is one micro-batch of several files, a file per task."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    options = {"spark.sql.files.maxPartitionBytes": "16384", "spark.sql.files.openCostInBytes": "16384"}
    before = set(os.listdir(_session_folder(spark))) if os.path.isdir(_session_folder(spark)) else set()
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        got = QUERIES["stream_lag_alert"](spark, str(tmp_path / "sf")).count()
    finally:
        for k in options:
            spark.conf.unset(k)
    fresh = {name.rsplit("-", 1)[0]: f"{_session_folder(spark)}/{name}" for name in set(os.listdir(_session_folder(spark))) - before}
    assert len([f for f in os.listdir(fresh["event-files"]) if f.startswith("part-")]) >= 3 * BATCHES
    assert sorted(f for f in os.listdir(f"{fresh['stream-alert-checkpoint']}/commits") if f.isdigit()) == [str(n) for n in range(BATCHES)]
    stored = spark.read.parquet(fresh["stream-alert"]).groupBy("batch_id").agg(F.collect_set(F.pmod("seq", F.lit(BATCHES))).alias("slices")).collect()
    assert {r.batch_id: r.slices for r in stored} == {0: [BATCHES - 1], **{n + 1: [n] for n in range(BATCHES - 1)}}
    assert got == lag_alerts_of(spark) > 0


def lag_alerts_of(spark):
    return live.lag_alerts(driver_tables.lag_snapshot(spark, "/root/testdata/sf0.001")).count()


def test_every_kth_poll(spark):
    polls = spark.range(10).withColumnRenamed("id", "seq")
    assert [r.seq for r in live.decimate(polls, "seq", 20, 5).collect()] == [0, 4, 8]
    assert live.decimate(polls, "seq", 1, 5).count() == 10
    assert live.decimate(polls, "seq", 5, 0).count() == 2


def test_closed_seconds_are_a_prefix_of_the_batch(spark, source, tmp_path):
    """Every emitted second has its final count and mean; only the last, still open ones are missing."""
    timed = _stream(spark, source).withColumn("at", F.timestamp_seconds("epoch_sec"))
    drain(
        live.closed_second_counts(timed, "at", "2 seconds").writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "o"))
    )
    got = {r.epoch_sec: (r["count"], round(r.avg_ms, 9)) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    batch = spark.read.parquet(source).groupBy("epoch_sec").agg(F.count(F.lit(1)).alias("n"), F.avg("latency_us").alias("a"))
    want = {r.epoch_sec: (r.n, round(r.a / 1000, 9)) for r in batch.collect()}
    assert got == {s: v for s, v in want.items() if s <= max(got)}
    assert 0 < len(want) - len(got) <= 4
