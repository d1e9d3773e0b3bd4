"""Column expressions over text: log lines, tool output, metrics text, JSON and HTML."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The longest transaction that counts (60 s) and the smallest field count of a log line.
MAX_LATENCY_US = 60_000_000
MIN_LOG_FIELDS = 6

# Lag metric families and the factor that turns their unit into milliseconds.
LAG_METRICS = {
    "async_replication_committed_lag_micros": 1.0 / 1000.0,
    "async_replication_sent_lag_micros": 1.0 / 1000.0,
    "consumer_safe_time_lag": 1.0,
}

# Statement patterns of the keyed test tables (case-insensitive) and the self-reference (case-sensitive).
WORKLOAD_PATTERNS = [
    "%from t%", "%into t%", "%update t%", "%delete from t%",
    *[f"% t{n} %" for n in range(1, 11)],
]
SELF_PATTERN = "%pg_stat_statements%"

# Name formats.
RUN_NAME = r"^[A-Za-z0-9._-]+$"
RUN_ID = r"^\d{8}-\d{6}$"
DB_NAME = r"^[A-Za-z0-9_]+$"

_BLANKS = " \t\r\n\f\x0b"
# Nearly every line has digits and blanks only; the cheap test settles those. For the rest, one
# hit of the second pattern means that some field is not an integer: a foreign character, a sign
# without a digit behind it, or a sign after a digit. Neither repeats groups, so very long lines
# cannot exhaust the regex stack.
_NOT_DIGITS = r"[^0-9\s]"
_NOT_AN_INTEGER = r"[^0-9\s+-]|[+-](?:[^0-9]|$)|[0-9][+-]"


def log_fields(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(_BLANKS)), r"\s+")


def has_only_integers(line: Column) -> Column:
    """Every field is an integer ('skipped' and 'failed' lines are not of this kind)."""
    return ~line.rlike(_NOT_DIGITS) | ~line.rlike(_NOT_AN_INTEGER)


def _last_number(text: Column, pattern: str) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(-1)).try_cast("double")


def stdout_figures(text: Column) -> dict[str, Column]:
    """Throughput and latency lines of one step's output; the last matching line counts."""
    return {
        "tps": _last_number(text, r"(?m)^\s*tps = ([0-9.]+)"),
        "tps_excluding": _last_number(text, r"(?m)^\s*tps = ([0-9.]+) \(excluding connections establishing\)"),
        "latency_avg_ms": _last_number(text, r"(?m)^\s*latency average = ([0-9.]+) ms"),
        "latency_stddev_ms": _last_number(text, r"(?m)^\s*latency stddev = ([0-9.]+) ms"),
    }


def _numbers_in_ms(text: Column, name: str, scale: float) -> Column:
    numbers = F.regexp_extract_all(text, F.lit(rf"{name}(?:\{{[^}}]*\}})?\s+([\d.e+-]+)"), F.lit(1))
    return F.transform(numbers, lambda number: number.try_cast("double") * F.lit(scale))


def lag_ms_from_text(text: Column) -> Column:
    """Worst lag in ms over every family and label set in a line or a whole capture; null if there is none."""
    found = [_numbers_in_ms(text, name, scale) for name, scale in LAG_METRICS.items()]
    return F.array_max(F.concat(*found))


def is_workload_statement(query: Column, patterns: list[str] | None = None) -> Column:
    """Statements on the keyed test tables. The patterns are loose on purpose: any table name starting with t."""
    hit = F.lit(False)
    for pattern in WORKLOAD_PATTERNS if patterns is None else patterns:
        hit = hit | query.ilike(pattern)
    return hit & is_other_statement(query)


def is_other_statement(query: Column) -> Column:
    """Everything but the statistics query itself."""
    return ~query.like(SELF_PATTERN)


def sanitize_nonfinite(text: Column) -> Column:
    """Turn the JSON-invalid float literals into null, inside string values too."""
    plain = text
    for literal in ("-Infinity", "Infinity", "NaN"):
        text = F.replace(text, F.lit(literal), F.lit("null"))
    # Hardly a document has one, and looking for a literal costs a fraction of replacing it.
    return F.when(F.contains(plain, F.lit("Infinity")) | F.contains(plain, F.lit("NaN")), text).otherwise(plain)


def html_escape(value: Column) -> Column:
    """Cell text with markup characters escaped; null becomes an empty cell."""
    plain = text = value.cast("string")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    # Most cells have nothing to escape, and looking for a character costs less than replacing it.
    marked = reduce(lambda a, b: a | b, [F.contains(plain, F.lit(char)) for char in '<&>"'])
    return F.coalesce(F.when(marked, text).otherwise(plain), F.lit(""))


def join_list(values: Column) -> Column:
    """``;``-joined; null and empty lists become an empty string."""
    return F.coalesce(F.array_join(values, ";"), F.lit(""))


def join_metric_paths(captures: Column) -> Column:
    """``;``-joined paths of the metric captures that have one."""
    # A function over the array is not written out in generated code, so Spark cuts the code of a report row into methods (see ``number_text``).
    return join_list(F.array_remove(F.transform(captures, lambda capture: capture["path"]), ""))  # joining leaves out nulls


def split_urls(urls: Column) -> Column:
    """Flatten a list whose entries may be comma-separated; trims and drops empties."""
    parts = F.flatten(F.transform(urls, lambda u: F.split(u, ",")))
    return F.filter(F.transform(parts, lambda p: F.btrim(p, F.lit(_BLANKS))), lambda p: p != "")


def is_run_name(name: Column) -> Column:
    return name.rlike(RUN_NAME)


def is_run_id(name: Column) -> Column:
    return name.rlike(RUN_ID)


def is_db_name(name: Column) -> Column:
    return name.rlike(DB_NAME)
