"""Server statement statistics: filter, summary, dominant statement, cumulative snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from loadlens.functions import (
    finite_round,
    histogram_buckets_sql,
    histogram_percentiles_sql,
    histogram_total_sql,
    is_other_statement,
    is_workload_statement,
    round_half_even,
)
from loadlens.operators.ordered import FRAME_BLOCK, moving_mean, with_previous

# The two spellings of the time columns, older first; and the reported percentiles.
TIME_COLUMNS = {
    "total_time": ["total_time", "total_exec_time"],
    "min_time": ["min_time", "min_exec_time"],
    "max_time": ["max_time", "max_exec_time"],
}
HISTOGRAM_PERCENTS = {"yb_p50_ms": 50, "yb_p90_ms": 90, "yb_p95_ms": 95, "yb_p99_ms": 99}


def with_time_columns(statements: DataFrame) -> DataFrame:
    """One spelling of the time columns, whichever the server version exported."""
    for name, spellings in TIME_COLUMNS.items():
        present = [F.col(s) for s in spellings if s in statements.columns]
        statements = statements.withColumn(name, F.coalesce(*present)).drop(*[s for s in spellings if s != name])
    return statements


def workload_statements(statements: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    return statements.where(is_workload_statement(F.col("query"), patterns))


def _summary_columns() -> list[Column]:
    mean = F.sum("total_time").cast("double") / F.nullif(F.sum("calls"), F.lit(0))
    return [
        round_half_even(F.coalesce(mean, F.lit(0.0)), 3).alias("mean_exec_time_ms"),
        round_half_even(F.coalesce(F.min("min_time").cast("double"), F.lit(0.0)), 3).alias("min_exec_time_ms"),
        round_half_even(F.coalesce(F.max("max_time").cast("double"), F.lit(0.0)), 3).alias("max_exec_time_ms"),
        F.coalesce(F.sum("calls"), F.lit(0)).cast("bigint").alias("calls"),
    ]


def statement_summary(statements: DataFrame, keys: Sequence[str] = (), patterns: list[str] | None = None) -> DataFrame:
    """Call-weighted mean, min, max and calls of the workload; without keys always one row."""
    matching = workload_statements(with_time_columns(statements), patterns)
    return matching.groupBy(*keys).agg(*_summary_columns())


def statement_summary_or_all(statements: DataFrame, when_empty: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """Summary of the workload, or of all but the self-reference when the filter cannot be applied.

    The filter cannot be applied without a ``query`` text column. An empty match is no
    reason to fall back, unless ``when_empty`` asks for it, per group: then both are summed in one pass.
    """
    timed = with_time_columns(statements)
    if "query" not in timed.columns:
        return timed.groupBy(*keys).agg(*_summary_columns())
    if not when_empty:
        return statement_summary(timed, keys)
    others = timed.where(is_other_statement(F.col("query")))
    per_kind = others.groupBy(*keys, is_workload_statement(F.col("query")).alias("workload")).agg(
        F.sum("total_time").alias("total_time"),
        F.min("min_time").alias("min_time"),
        F.max("max_time").alias("max_time"),
        F.sum("calls").alias("calls"),
    )
    # At most two rows a group: the workload and the rest. The rest counts only when the workload is absent.
    kind = F.struct("total_time", "min_time", "max_time", "calls")
    kept = per_kind.groupBy(*keys).agg(F.max_by(kind, F.col("workload")).alias("kind")).select(*keys, "kind.*")
    return kept.groupBy(*keys).agg(*_summary_columns())


def dominant_statement(statements: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The workload statement with most calls and a histogram; the lowest id breaks ties."""
    order = F.struct("calls", -F.col("queryid"))
    return (
        workload_statements(statements)
        .where(F.col("yb_latency_histogram").isNotNull())
        .groupBy(*keys)
        .agg(F.max_by(F.struct("queryid", "calls", "yb_latency_histogram"), order).alias("top"))
        .where(F.col("top").isNotNull())
        .select(*keys, "top.*")
    )


def histogram_percentiles(df: DataFrame, histogram: str = "yb_latency_histogram", interpolate: bool = False) -> DataFrame:
    """p50/p90/p95/p99 of a bucket histogram; null when empty or in the open last bucket."""
    others = [c for c in df.columns if c != histogram]
    # Exploded as one element, so that the text is parsed once and not per percentile.
    parsed = df.select(*others, F.explode(F.array(F.expr(histogram_buckets_sql(histogram)))).alias("buckets__"))
    summed = parsed.withColumn("total__", F.expr(histogram_total_sql("buckets__")))
    percents = [str(p) for p in HISTOGRAM_PERCENTS.values()]
    found = summed.select(*others, F.expr(histogram_percentiles_sql("buckets__", "total__", percents, interpolate)).alias("found__"))
    # Rounded in steps of their own, since rounding reads its value several times.
    values = found.select(*others, *[F.col(f"found__.p{i}").alias(name) for i, name in enumerate(HISTOGRAM_PERCENTS)])
    return values.select(*others, *[finite_round(F.col(c)).alias(c) for c in HISTOGRAM_PERCENTS])


def stats_json(statements: DataFrame) -> DataFrame:
    """The summary as one JSON object."""
    row = statement_summary(statements)
    return row.select(
        F.to_json(
            F.struct(
                F.col("mean_exec_time_ms").alias("mean"),
                F.col("min_exec_time_ms").alias("min"),
                F.col("max_exec_time_ms").alias("max"),
                "calls",
            )
        ).alias("stats")
    )


def top_statements(statements: DataFrame, n: int = 1) -> DataFrame:
    return statements.orderBy(F.col("calls").desc(), "queryid").limit(n)


def last_snapshot(snapshots: DataFrame, keys: Sequence[str], order: Sequence[str] = ("elapsed_sec",)) -> DataFrame:
    """The latest cumulative snapshot of a step is its statistics."""
    values = [c for c in snapshots.columns if c not in keys]
    return (
        snapshots.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), F.struct(*order)).alias("last"))
        .select(*keys, "last.*")
    )


def snapshot_bucket(order: str = "elapsed_sec", width: int = 60) -> Column:
    """Order-preserving cut of a snapshot series, by seconds."""
    return F.floor(F.col(order) / F.lit(width))


def series_bucket(snapshots: DataFrame, order: Sequence[str], width: int = 1_000_000) -> Column:
    """Order-preserving cut of a series: whole seconds, each cut further by the number that follows in ``order``.

    Only the first column of ``order`` never falls along it, so the second can cut no more than equal values of the first;
    where the first is no whole number or there is no second number, the seconds alone are cut.
    """
    kinds = [snapshots.schema[c].dataType for c in order[:2]]
    if len(kinds) < 2 or not isinstance(kinds[0], IntegralType) or not isinstance(kinds[1], NumericType):
        return snapshot_bucket(order[0])
    return F.struct(F.col(order[0]), F.floor(F.col(order[1]) / F.lit(width)).alias("part__"))


def interval_columns(previous_calls: Column, previous_mean: Column) -> dict[str, Column]:
    """Calls and mean within one interval, from cumulative calls and mean.

    The counters start at zero with the step, so the first snapshot is its own interval.
    Fewer calls than before mean a reset: null.
    """
    before = F.coalesce(previous_calls, F.lit(0))
    calls = F.col("calls") - before
    spent = F.col("mean_ms") * F.col("calls") - F.coalesce(previous_mean, F.lit(0.0)) * before
    return {
        "interval_calls": F.when(calls >= 0, calls),
        "interval_mean_ms": F.when(calls > 0, spent / calls),
    }


def snapshot_delta(
    snapshots: DataFrame, keys: Sequence[str], order: Sequence[str] = ("elapsed_sec",), bucket: Column | None = None
) -> DataFrame:
    """Per-interval calls and mean from cumulative snapshots.

    The default bucket is ``series_bucket``.
    """
    bucket = series_bucket(snapshots, order) if bucket is None else bucket
    seen = with_previous(snapshots, keys, order, bucket, ["calls", "mean_ms"])
    deltas = interval_columns(F.col("prev_calls"), F.col("prev_mean_ms"))
    return seen.select(*keys, *order, *[c.alias(name) for name, c in deltas.items()])


def smoothed_latency(
    snapshots: DataFrame, keys: Sequence[str], order: Sequence[str] = ("elapsed_sec",), width: int = 5, bucket: Column | None = None, block: int = FRAME_BLOCK
) -> DataFrame:
    """Latency per interval (see ``snapshot_delta``) and its moving mean over ``width`` intervals; intervals without calls or
    with a reset have no latency and do not count in the mean."""
    deltas = snapshot_delta(snapshots, keys, order, bucket)
    cut = series_bucket(deltas, order) if bucket is None else bucket
    return moving_mean(deltas, keys, order, cut, "interval_mean_ms", width, "smoothed_ms", block)


def latency_over_time(snapshots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Server latency over elapsed time, cumulative as recorded, in order."""
    shown = [c for c in ("mean_ms", *HISTOGRAM_PERCENTS) if c in snapshots.columns]
    return snapshots.select(*keys, "elapsed_sec", *shown).orderBy(*keys, "elapsed_sec")
