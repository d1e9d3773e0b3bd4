"""Transaction logs: parsing, percentiles, per-second histogram, throughput."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions import MAX_LATENCY_US, MIN_LOG_FIELDS, fixed_text, has_only_integers, log_fields, us_to_ms
from loadlens.operators.ordered import COARSE_PER_DOUBLING, distribution, join_keys

# Reported shares.
STEP_SHARES = {"latency_p50_ms": 0.50, "latency_p90_ms": 0.90, "latency_p95_ms": 0.95, "latency_p99_ms": 0.99}
SECOND_SHARES = {"p50_ms": 0.50, "p95_ms": 0.95, "p99_ms": 0.99}


def parse_txn_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Log lines -> typed rows; other columns pass through.

    A line counts if it has at least six fields, all integers, and 0 <= latency <= 60 s.
    """
    fields = F.col("fields__")
    layout = [
        ("client_id", 0, "int"), ("txn_no", 1, "bigint"), ("latency_us", 2, "bigint"), ("script_no", 3, "int"),
        ("epoch_sec", 4, "bigint"), ("epoch_us", 5, "bigint"), ("schedule_lag", 6, "bigint"),
    ]
    others = [c for c in lines.columns if c != line]
    # The one-element explode splits a line once; a plain column would be split again by
    # every filter and column that Catalyst merges with it.
    return (
        lines.where(has_only_integers(F.col(line)))
        .select(*others, F.explode(F.array(log_fields(F.col(line)))).alias("fields__"))
        .where(F.size(fields) >= MIN_LOG_FIELDS)
        .select(*others, *[F.get(fields, F.lit(at)).try_cast(kind).alias(name) for name, at, kind in layout])
        .where(F.col("latency_us").between(0, MAX_LATENCY_US))
    )


def latency_percentiles(txn: DataFrame, keys: Sequence[str] = ("variant", "step")) -> DataFrame:
    """Samples and interpolated p50/p90/p95/p99 in ms per group."""
    stats = distribution(txn, keys, "latency_us", interpolated=STEP_SHARES, divisor=1000.0)
    return stats.select(*keys, F.col("n").alias("latency_samples"), *STEP_SHARES)


def latency_percentiles_of(steps: DataFrame, txn: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same for every listed step; a step without samples has 0 samples and null percentiles."""
    keys = list(keys)
    return join_keys(steps, latency_percentiles(txn, keys), keys, "left").fillna({"latency_samples": 0})


def latency_histogram(txn: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per second of completion: count, mean, p50, p95, p99 in ms."""
    return histogram_of_counts(txn, [*keys, "epoch_sec"])


def histogram_of_counts(txn: DataFrame, keys: Sequence[str], freq: str | None = None) -> DataFrame:
    stats = distribution(
        txn, keys, "latency_us", interpolated=SECOND_SHARES, divisor=1000.0, freq=freq, per_doubling=COARSE_PER_DOUBLING
    )
    return stats.select(
        *keys, F.col("n").alias("count"), (F.col("sum") / F.col("n")).alias("avg_ms"), *SECOND_SHARES
    )


def formatted_histogram(histogram: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Three decimals as text, the way the histogram file holds them."""
    return histogram.select(
        *keys, "epoch_sec", "count",
        *[F.coalesce(fixed_text(F.col(c), 3), F.lit("")).alias(c) for c in ("avg_ms", "p50_ms", "p95_ms", "p99_ms")],
    )


def throughput(txn: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Transactions per elapsed second; null when a group spans no time."""
    span = F.col("last_sec") - F.col("first_sec")
    return (
        txn.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.min("epoch_sec").alias("first_sec"),
            F.max("epoch_sec").alias("last_sec"),
        )
        .withColumn("elapsed_sec", span)
        .withColumn("tps", F.col("transactions").cast("double") / F.nullif(F.col("elapsed_sec"), F.lit(0)))
        .drop("first_sec", "last_sec")
    )


def operation_stats(txn: DataFrame, keys: Sequence[str], shares: dict[str, float] = STEP_SHARES) -> DataFrame:
    """Transactions, throughput and percentiles per group from one pass over the log.

    A null key is a group like others; throughput is null when a group spans no time.
    """
    stats = distribution(txn, keys, "latency_us", interpolated=shares, divisor=1000.0, ranges=["epoch_sec"])
    span = F.col("last_epoch_sec") - F.col("first_epoch_sec")
    tps = F.col("n").cast("double") / F.nullif(span, F.lit(0))
    return stats.select(*keys, F.col("n").alias("transactions"), tps.alias("tps"), *shares)


def script_weights(plans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Scripts of every phase of a plan with their number in the log, weight and share.

    A phase has a ``mix``, whose entries without a script do not count and whose default weight is 1,
    or one ``script``. ``script_no`` counts from 0 in that order, as the log does.
    """
    phase = F.col("phase")
    listed = F.filter(phase["mix"], lambda m: F.coalesce(m["script"], F.lit("")) != "")
    weighted = F.transform(listed, lambda m: F.struct(m["script"].alias("script"), F.coalesce(m["weight"], F.lit(1)).alias("weight")))
    single = F.array(F.struct(phase["script"].alias("script"), F.lit(1).alias("weight")))
    scripts = F.when(F.size(F.coalesce(phase["mix"], F.array())) > 0, weighted).when(F.coalesce(phase["script"], F.lit("")) != "", single)
    total = F.aggregate(scripts, F.lit(0), lambda a, m: a + m["weight"])
    return (
        plans.select(*keys, F.posexplode("phases").alias("phase_idx", "phase"))
        .where(phase["type"] == "pgbench")
        .select(*keys, "phase_idx", F.coalesce(phase["name"], F.lit("pgbench")).alias("phase"), total.alias("total"), F.posexplode(scripts).alias("script_no", "s"))
        .select(*keys, "phase_idx", "phase", "script_no", "s.script", "s.weight", (F.col("s.weight") / F.col("total")).alias("share"))
    )


def per_script_stats(txn: DataFrame, keys: Sequence[str] = ("step",)) -> DataFrame:
    """Samples, mean and percentiles per script of a mixed step."""
    keys = [*keys, "script_no"]
    stats = distribution(txn, keys, "latency_us", interpolated=STEP_SHARES, divisor=1000.0)
    return stats.select(
        *keys, F.col("n").alias("latency_samples"), (F.col("sum") / F.col("n")).alias("latency_avg_ms"), *STEP_SHARES
    )


def with_script_names(stats: DataFrame, weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per-script statistics with script, weight and planned share of the mix; null for a number that the plan lacks."""
    named = weights.select(*keys, "script_no", "script", "weight", F.col("share").alias("planned_share"))
    return join_keys(stats, named, [*keys, "script_no"], "left")


def with_latency_ms(txn: DataFrame) -> DataFrame:
    return txn.withColumn("latency_ms", us_to_ms(F.col("latency_us")))
