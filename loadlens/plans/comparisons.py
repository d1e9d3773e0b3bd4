"""Comparison tables over runs, operations and schema variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions import client_overhead, clients_resolved
from loadlens.operators.lag import lag_columns, with_risk
from loadlens.operators.latency import STEP_SHARES, operation_stats
from loadlens.operators.ordered import distribution, join_keys

PERCENTILES = ["latency_p90_ms", "latency_p95_ms", "latency_p99_ms"]

# The operations of the keyed workload.
OPERATIONS = ["select", "insert", "update", "delete"]


def summary_comparison(flat: DataFrame, labels: DataFrame) -> DataFrame:
    """Label, operation, step, throughput, percentiles and clients of every step of every run."""
    rows = flat.join(labels.select("runset", "run", "run_label"), ["runset", "run"], "left")
    return rows.select(
        "runset", "run", F.coalesce("run_label", F.lit("")).alias("run_label"),
        "operation", "step", "tps", *PERCENTILES, "clients",
    )


def connection_count(flat: DataFrame, phase_clients: DataFrame | None = None) -> DataFrame:
    """Clients per step; a step that names none takes its phase's."""
    if phase_clients is None:
        return flat.select("runset", "run", "step", "clients")
    rows = flat.join(phase_clients, ["run", "phase_idx"], "left")
    return rows.select(
        "runset", "run", "step", clients_resolved(F.col("clients"), F.col("phase_clients")).alias("clients")
    )


def latency_breakdown(flat: DataFrame) -> DataFrame:
    """Client average, server mean and what lies between them."""
    return flat.select(
        "runset", "run", "step",
        F.col("latency_avg_ms").alias("client_ms"),
        F.col("pg_stat_mean_ms").alias("server_ms"),
        client_overhead(F.col("latency_avg_ms"), F.col("pg_stat_mean_ms")).alias("overhead_ms"),
    )


def run_details(flat: DataFrame) -> DataFrame:
    return flat.select(
        "runset", "run", "phase", "step", "clients", "jobs", "duration_sec", "target_tps", "total_transactions"
    )


def per_operation(txn: DataFrame, keys: Sequence[str] = ("operation",)) -> DataFrame:
    """Throughput and p90/p95/p99 per operation, from one pass over the log; a null operation is one of its own."""
    return operation_stats(txn, list(keys), {k: v for k, v in STEP_SHARES.items() if k in PERCENTILES})


def per_operation_wide(rows: DataFrame, key: str, operations: Sequence[str] = OPERATIONS) -> DataFrame:
    """One row per key with the figures of each operation side by side."""
    return (
        rows.groupBy(key)
        .pivot("operation", list(operations))
        .agg(F.max("tps").alias("tps"), F.max("latency_p95_ms").alias("p95_ms"))
    )


def schema_decision(txn: DataFrame, lag: DataFrame, key: str = "variant") -> DataFrame:
    """Per schema variant: throughput, percentiles, lag figures and recovery risk."""
    rates = operation_stats(txn, [key]).select(key, "tps", *STEP_SHARES)
    lag_stats = lag_columns(distribution(lag, [key], "lag_ms", nearest={"p95": 0.95}), [key])
    return with_risk(join_keys(rates, lag_stats.select(key, "avg_lag_ms", "p95_lag_ms", "max_lag_ms"), [key], "left"))


def variant_rank(rows: DataFrame, group: str = "operation", variant: str = "variant", base: str = "plain") -> DataFrame:
    """Rank of each variant by throughput within an operation, and its figures relative to the base variant.

    ``rows`` has one row per (operation, variant), so a group is as large as there are variants.
    """
    within = Window.partitionBy(group)

    def of_base(column: str):
        return F.max(F.when(F.col(variant) == base, F.col(column))).over(within)

    return rows.select(
        group, variant, "tps", "latency_p95_ms",
        F.rank().over(within.orderBy(F.col("tps").desc())).alias("tps_rank"),
        (F.col("tps") / of_base("tps")).alias("tps_ratio"),
        (F.col("latency_p95_ms") / of_base("latency_p95_ms")).alias("p95_ratio"),
    )


def target_vs_achieved(steps: DataFrame, achieved: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Asked and reached rate of the rate-limited steps."""
    rated = steps.where(F.col("target_tps").isNotNull()).select(*keys, "target_tps")
    return rated.join(achieved.select(*keys, "tps"), list(keys), "left").withColumn(
        "achieved_share", F.col("tps") / F.col("target_tps")
    )
