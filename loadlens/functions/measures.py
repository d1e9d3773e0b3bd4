"""Column expressions over numbers: units, rounding, bands, plan arithmetic, keys."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Lag bands in ms.
LAG_WARNING_MS = 100
LAG_HIGH_RISK_MS = 500

# Multiplier of the generated payload of test tables t1..t10, and its modulus.
PAYLOAD_FACTORS = [13, 17, 19, 23, 29, 31, 37, 41, 43, 47]
PAYLOAD_MODULUS = 1_000_000

# Defaults of a load plan.
DEFAULT_CLIENTS = 8
DEFAULT_JOBS = 2
DEFAULT_LAG_INTERVAL_SEC = 5
DEFAULT_PHASE = "pgbench"
DEFAULT_DB = {"host": "127.0.0.1", "port": "5433", "admin_dbname": "postgres"}


def us_to_ms(micros: Column) -> Column:
    return micros.cast("double") / F.lit(1000.0)


def round_half_even(value: Column, digits: int) -> Column:
    """Round the binary value half to even, as a float formatter does (2.675 -> 2.67).

    Spark's ``round`` and ``bround`` work on the printed decimal and give 2.68.
    Non-finite input gives null. Most values have no more digits already: those skip the formatter.
    """
    value, scale = value.cast("double"), F.lit(10.0**digits)
    near = F.rint(value * scale) / scale  # the double closest to a number of so many digits
    plain = (value == near) & (F.abs(value) < F.lit(1e12))
    return F.when(plain, value).otherwise(fixed_text(value, digits).try_cast("double"))


def fixed_text(value: Column, digits: int) -> Column:
    """Fixed number of decimals as text; null and non-finite stay null."""
    value = value.cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    pattern = "0." + "0" * digits if digits else "0"
    return F.when(finite, F.call_function("format_number", value, F.lit(pattern)))


def finite_round(value: Column) -> Column:
    """Three decimals; null for null, text that is no number, infinities and NaN."""
    return round_half_even(value.try_cast("double"), 3)


def client_overhead(client_avg_ms: Column, server_mean_ms: Column) -> Column:
    """Network and connection share of the client's average; may be negative, null if a side is missing."""
    return round_half_even(client_avg_ms - server_mean_ms, 3)


def server_time_estimate(latency_ms: Column, baseline_ms: Column) -> Column:
    """Server time without server statistics: latency minus that of a trivial query."""
    return latency_ms - baseline_ms


def dr_risk(lag_ms: Column, warning: float = LAG_WARNING_MS, high: float = LAG_HIGH_RISK_MS) -> Column:
    """Recovery risk band of a lag; both bounds belong to Warning."""
    return (
        F.when(lag_ms < F.lit(float(warning)), "Safe")
        .when(lag_ms <= F.lit(float(high)), "Warning")
        .when(lag_ms > F.lit(float(high)), "High Risk")
    )


def uuid_from_int(number: Column) -> Column:
    """Repeatable key: md5 of the decimal text in 8-4-4-4-12 form."""
    digest = F.md5(number.cast("bigint").cast("string"))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def payload_mod(number: Column, factor: int | Column) -> Column:
    factor = factor if isinstance(factor, Column) else F.lit(factor)
    return F.pmod(number.cast("bigint") * factor.cast("bigint"), F.lit(PAYLOAD_MODULUS).cast("bigint"))


def account_delta(number: Column) -> Column:
    return number.cast("bigint") * F.lit(37) % F.lit(200) - F.lit(100)


def run_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd-HHmmss")


def run_id_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyyMMdd-HHmmss"))


def elapsed_seconds(now_us: Column, start_us: Column) -> Column:
    """Whole seconds since the start, cut towards zero."""
    return whole_division(now_us - start_us, F.lit(1_000_000).cast("bigint"))


def split_transactions(total: Column, clients: Column) -> Column:
    """Transactions per client, rounded up, at least 1: the sum may exceed what was asked."""
    total, clients = total.cast("bigint"), clients.cast("bigint")
    return F.greatest(F.lit(1).cast("bigint"), whole_division(total + clients - 1, clients))


def step_mode(total_transactions: Column, transactions_per_client: Column, target_tps: Column) -> Column:
    """Fixed work wins over a rate; neither is a capacity step."""
    return (
        F.when((F.coalesce(total_transactions, F.lit(0)) > 0) | (F.coalesce(transactions_per_client, F.lit(0)) > 0),
               "transaction_count")
        .when(target_tps.isNotNull(), "tps")
        .otherwise("capacity")
    )


def step_label(
    phase: Column,
    position: Column,
    total_transactions: Column,
    transactions_per_client: Column,
    target_tps: Column,
    clients: Column,
) -> Column:
    """Name of a ramp step (``position`` counts from 1)."""
    asked = F.coalesce(
        F.when(total_transactions > 0, total_transactions.cast("bigint")),
        transactions_per_client.cast("bigint") * clients.cast("bigint"),
    )
    mode = step_mode(total_transactions, transactions_per_client, target_tps)
    tail = (
        F.when(mode == "transaction_count", F.concat(asked.cast("string"), F.lit("tx")))
        .when(mode == "tps", F.concat(rate_text(target_tps), F.lit("tps")))
        .otherwise(F.concat(F.lit("capacity_step"), position.cast("string")))
    )
    return F.concat(phase, F.lit("_"), tail)


def rate_text(target_tps: Column) -> Column:
    """A whole rate prints without decimals."""
    whole = target_tps.cast("bigint")
    return F.when(target_tps == whole, whole.cast("string")).otherwise(target_tps.cast("string"))


def client_sizing(target_tps: Column, latency_ms: Column, headroom: float | Column = 2.0) -> Column:
    """Connections that a rate needs: rate x average latency in seconds x headroom, rounded up."""
    headroom = headroom if isinstance(headroom, Column) else F.lit(float(headroom))
    return F.ceil(target_tps * latency_ms * headroom / F.lit(1000.0)).cast("bigint")


def clients_resolved(step_clients: Column, phase_clients: Column, default: int = DEFAULT_CLIENTS) -> Column:
    return F.coalesce(step_clients, phase_clients, F.lit(default))


def parse_interval(text: Column, default: int = 0) -> Column:
    """Whole seconds; 0 switches polling off, and so does anything that is no whole number."""
    return F.greatest(F.coalesce(text.try_cast("int"), F.lit(default)), F.lit(0))


# One entry: bounds and count. An open upper bound is missing or no number.
_HISTOGRAM_ENTRY = r'"[\[(]?\s*([-+0-9.eE]+)\s*,\s*([^\])"]*)[\])]?"\s*:\s*([0-9]+)'


def histogram_buckets_sql(histogram: str) -> str:
    """SQL: ``[{"[lo,hi)": n}, ..]`` -> array of (lo, hi, n), ascending; an open upper bound is infinite."""
    found = ", ".join(f"regexp_extract_all({histogram}, r'{_HISTOGRAM_ENTRY}', {k})" for k in (1, 2, 3))
    bucket = (
        "named_struct('lo', try_cast(e['0'] as double), 'hi', coalesce(try_cast(trim(e['1']) as double), double('inf')), "
        "'n', cast(e['2'] as bigint))"
    )
    return f"array_sort(transform(arrays_zip({found}), e -> {bucket}))"


def histogram_total_sql(buckets: str) -> str:
    return f"aggregate({buckets}, 0L, (a, b) -> a + b.n)"


def histogram_percentiles_sql(buckets: str, total: str, percents: list[str], interpolate: bool = False) -> str:
    """SQL: for each share the upper bound of the first bucket that reaches it (or the point inside it), as fields p0, p1, ..;
    null when empty. One pass keeps a running count and the hits."""
    names = [f"p{i}" for i in range(len(percents))]
    start = ", ".join(f"'{n}', cast(null as double)" for n in names)
    hits = []
    for name, percent in zip(names, percents, strict=True):
        need = f"cast({total} as double) * cast({percent} / 100 as double)"
        inside = f"b.lo + (b.hi - b.lo) * ({need} - acc.upto) / b.n" if interpolate else "b.hi"
        hits.append(f"'{name}', case when acc.{name} is null and b.n > 0 and acc.upto + b.n >= {need} then {inside} else acc.{name} end")
    return (
        f"aggregate({buckets}, named_struct('upto', 0L, {start}), "
        f"(acc, b) -> named_struct('upto', acc.upto + b.n, {', '.join(hits)}))"
    )


def histogram_percentile(histogram: str, percent: float, interpolate: bool = False) -> Column:
    """Percentile of the bucket histogram in a column or SQL expression."""
    return F.expr(_one_percentile_sql(histogram, str(percent), interpolate))


def _one_percentile_sql(histogram: str, percent: str, interpolate: bool = False) -> str:
    buckets = histogram_buckets_sql(histogram)
    return f"{histogram_percentiles_sql(buckets, histogram_total_sql(buckets), [percent], interpolate)}.p0"


def whole_division(a: Column, b: Column) -> Column:
    """BIGINT division cut towards zero, exact beyond 2^53."""
    return F.call_function("div", a, b)


def register_functions(spark: SparkSession) -> None:
    """SQL surface: ``uuid_from_int(n)`` and ``get_percentile(histogram_json, percent)``."""
    spark.sql(
        "create or replace temporary function uuid_from_int(n bigint) returns string return "
        "regexp_replace(md5(cast(n as string)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '$1-$2-$3-$4-$5')"
    )
    body = _one_percentile_sql("histogram", "percent")
    spark.sql(f"create or replace temporary function get_percentile(histogram string, percent double) returns double return {body}")
