"""Replication lag: parsing, worst case, first answering node, step summary, rate limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions import dr_risk, lag_ms_from_text, round_half_even
from loadlens.operators.ordered import distribution, value_bucket, with_previous


def parse_lag_text(df: DataFrame, text: str = "line") -> DataFrame:
    """Add ``lag_ms`` of a metrics line or a whole capture (null when it holds no lag metric)."""
    return df.withColumn("lag_ms", lag_ms_from_text(F.col(text)))


def lag_worst_case(lag: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Largest lag of one scrape over all metric families and label sets."""
    return lag.groupBy(*keys).agg(round_half_even(F.max("lag_ms"), 2).alias("lag_ms"))


def lag_first_available(node_lag: DataFrame, keys: Sequence[str], node_order: str) -> DataFrame:
    """The first node in list order that has a value wins, however large the others are."""
    answered = F.when(F.col("lag_ms").isNotNull(), F.col(node_order))
    return node_lag.groupBy(*keys).agg(F.min_by("lag_ms", answered).alias("lag_ms"))


def lag_summary(snapshots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Min, mean, nearest-rank p95, max and sample count; groups without a value give no row."""
    stats = distribution(snapshots, keys, "lag_ms", nearest={"p95": 0.95})
    return lag_columns(stats, keys)


def lag_columns(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Samples have two or three decimals, so six decimals of the sum are exact and free of the
    # noise that the order of a parallel addition leaves behind.
    mean = round_half_even(F.col("sum"), 6) / F.col("n")
    return stats.select(
        *keys,
        round_half_even(F.col("min"), 2).alias("min_lag_ms"),
        round_half_even(mean, 2).alias("avg_lag_ms"),
        round_half_even(F.col("p95"), 2).alias("p95_lag_ms"),
        round_half_even(F.col("max"), 2).alias("max_lag_ms"),
        F.col("n").alias("samples"),
    )


def with_risk(df: DataFrame, lag: str = "p95_lag_ms") -> DataFrame:
    return df.withColumn("dr_risk", dr_risk(F.col(lag)))


def lag_threshold(
    steps: DataFrame, keys: Sequence[str], rate: str, lag: str, factor: float = 1.0
) -> DataFrame:
    """First rate whose lag exceeds ``factor`` x the lag at the rate before, and the last rate below it.

    A group whose lag never grows has no limit; its last good rate is its highest.
    """
    per_rate = steps.groupBy(*keys, rate).agg(F.max(lag).alias(lag))
    seen = with_previous(per_rate, keys, [rate], value_bucket(F.col(rate)), [rate, lag])
    grew = F.col(lag) > F.lit(factor) * F.col(f"prev_{lag}")
    return seen.groupBy(*keys).agg(
        F.min(F.when(grew, F.col(rate))).alias("limit_rate"),
        F.coalesce(F.min_by(F.col(f"prev_{rate}"), F.when(grew, F.col(rate))), F.max(rate)).alias("last_good_rate"),
    )


def lag_over_time(snapshots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lag by elapsed second within each step, in order (a range-partitioned sort)."""
    return snapshots.select(*keys, "elapsed_sec", "lag_ms").orderBy(*keys, "elapsed_sec")
