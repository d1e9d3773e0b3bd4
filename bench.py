"""Headline queries at one scale; prints one JSON line.

The log is also multiplied BENCH_REPLICATE times (10 by default, 0 for none), a third of it moved
into one step and one second, and the log statistics are timed on that (62 at sf0.1 is one
production rate test of 6.2 M lines). Report queries read stored step records, as a user would.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from loadlens.operators import latency, reports
from loadlens.plans import driver_tables
from loadlens.plans.catalog import QUERIES
from loadlens.session import drop_scratch, local_session, store

HEADLINES = [
    "latency_percentiles", "latency_histogram", "per_script_stats", "throughput", "schema_decision", "lag_summary",
    "statement_summary", "histogram_percentile", "snapshot_delta", "per_operation", "sink_report_csv", "sink_latency_histogram",
    "apply_updates", "delete_one_per_key", "ordered_batch_apply", "fk_chain", "preload_tables",
    "stream_latency_histogram", "stream_txn_ingest", "stream_appended_logs", "stream_closed_percentiles", "smoothed_latency", "fk_roots",
]


def timed(run, repeat: int = 2) -> float:
    best = float("inf")
    for _ in range(repeat):
        started = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - started)
    return round(best, 3)


def skewed_log(spark, sf: str, copies: int):
    """The log ``copies`` times; every third copy in one hot step and second."""
    rows = driver_tables.txn(spark, sf).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    hot = F.col("copy") % 3 == 0
    return store(
        rows.select(
            F.when(hot, "hot").otherwise(F.col("variant")).alias("variant"),
            F.when(hot, "hot").otherwise(F.col("step")).alias("step"),
            F.when(hot, 0).otherwise(F.col("epoch_sec") + F.col("copy") * 1000).alias("epoch_sec"),
            (F.col("latency_us") + F.col("copy") * 7).alias("latency_us"),
        ),
        "bench-log",
    )


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), **{"spark.ui.showConsoleProgress": "false"})
    spark.read.parquet(f"{sf}/events.parquet").groupBy("event_type").count().collect()  # start the engine
    seconds = {}
    for name in HEADLINES:
        seconds[name] = timed(lambda: QUERIES[name](spark, sf))
    records = store(driver_tables.records(spark, sf), "bench-records")
    seconds["flatten_report"] = timed(lambda: reports.flatten_records(records))
    seconds["report_html_rows"] = timed(lambda: reports.report_html_rows(reports.flatten_records(records), ["runset", "run"]))
    copies = int(os.environ.get("BENCH_REPLICATE", "10"))
    if copies:
        log, keys = skewed_log(spark, sf, copies), ["variant", "step"]
        seconds["replicated_latency_percentiles"] = timed(lambda: latency.latency_percentiles(log, keys))
        seconds["replicated_latency_histogram"] = timed(lambda: latency.latency_histogram(log, keys))
        seconds["replicated_per_operation"] = timed(lambda: latency.operation_stats(log, keys))
        seconds["replicated_throughput"] = timed(lambda: latency.throughput(log, keys))
    print(json.dumps({
        "metric": "total wall time of the headline queries (best of two runs each)",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf.rsplit("sf", 1)[-1],
    }))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
