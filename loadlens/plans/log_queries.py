"""Queries over transaction logs, lag and statement statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loadlens import functions as fn
from loadlens.operators import lag, latency, reports, statements
from loadlens.plans import comparisons
from loadlens.plans import driver_tables as t
from loadlens.plans.registry import query
from loadlens.session import scratch_path
from loadlens.sinks import files as sinks
from loadlens.sources import files as sources

PCT = ["latency_p50_ms", "latency_p90_ms", "latency_p95_ms", "latency_p99_ms"]


def rounded(df, *columns):
    """Six decimals, so that interpolation noise below 1e-13 cannot show."""
    return df.withColumns({c: fn.round_half_even(F.col(c), 6) for c in columns})


def _q(share: float, name: str, column: str = "latency_us") -> str:
    return f"cast(printf('%.6f', quantile_cont(cast({column} as double) / 1000, {share})) as double) as {name}"


PCT_SQL = ", ".join(_q(s, n) for n, s in latency.STEP_SHARES.items())
SECOND_SQL = ", ".join(_q(s, n) for n, s in latency.SECOND_SHARES.items())
PARSED = ["variant", "operation", "step", "client_id", "txn_no", "latency_us", "script_no", "epoch_sec", "epoch_us", "schedule_lag"]


@query("parse_txn_line", f"select {', '.join(PARSED)} from parsed")
def _(spark, sf):
    return latency.parse_txn_lines(t.txn_line(spark, sf))


@query("scan_txn_log", "select variant as runset, operation as run, step, txn_no, latency_us, epoch_sec, schedule_lag from parsed")
def _(spark, sf):
    path = scratch_path(spark, "txn-log")
    lines = t.txn_line(spark, sf).withColumnsRenamed({"variant": "runset", "operation": "run"})
    sinks.write_txn_log(lines, path)
    return sources.scan_txn_log(spark, path).select(
        "runset", "run", "step", "txn_no", "latency_us", "epoch_sec", "schedule_lag"
    )


@query(
    "union_logs",
    f"select variant as runset, operation as run, count(*) as latency_samples, {PCT_SQL} from parsed group by all",
)
def _(spark, sf):
    # The files of all steps of a run as one bag of samples.
    path = scratch_path(spark, "txn-log")
    lines = t.txn_line(spark, sf).withColumnsRenamed({"variant": "runset", "operation": "run"})
    sinks.write_txn_log(lines, path)
    return rounded(latency.latency_percentiles(sources.scan_txn_log(spark, path, partitioned=True), ["runset", "run"]), *PCT)


@query("latency_percentiles", f"select variant, step, count(*) as latency_samples, {PCT_SQL} from parsed group by all")
def latency_percentiles(spark, sf):
    return rounded(latency.latency_percentiles(latency.parse_txn_lines(t.txn_line(spark, sf))), *PCT)


@query(
    "latency_histogram",
    f"""select variant, step, epoch_sec, count(*) as count,
        cast(printf('%.6f', cast(sum(latency_us) as double) / 1000 / count(*)) as double) as avg_ms, {SECOND_SQL} from txn group by all""",
)
def _(spark, sf):
    rows = latency.latency_histogram(t.txn(spark, sf), ["variant", "step"])
    return rounded(rows, "avg_ms", "p50_ms", "p95_ms", "p99_ms")


SORTED_SQL = f"""select epoch_sec, count(*) as count, cast(printf('%.6f', cast(sum(latency_us) as double) / 1000 / count(*)) as double) as avg_ms,
    {SECOND_SQL} from txn group by all"""


@query("sorted_histogram", SORTED_SQL + " order by epoch_sec")
def _(spark, sf):
    return rounded(latency.latency_histogram(t.txn(spark, sf)), "avg_ms", "p50_ms", "p95_ms", "p99_ms").orderBy("epoch_sec")


def _fixed(share: float, name: str) -> str:
    """The interpolation formula itself: half-way cases make the third decimal depend on the last bit."""
    rank = f"(cast({share} as double) * (count(*) - 1))"
    values, low = "list_sort(list(cast(latency_us as double) / 1000))", f"cast(floor({rank}) as bigint)"
    weight = f"({rank} - floor({rank}))"
    return f"""cast(printf('%.3f', {values}[{low} + 1] * (1 - {weight})
      + {values}[least({low} + 2, count(*))] * {weight}) as double) as {name}"""


FIXED_SQL = f"""select variant as runset, operation as run, step, epoch_sec, count(*) as count,
    cast(printf('%.3f', cast(sum(latency_us) as double) / 1000 / count(*)) as double) as avg_ms,
    {', '.join(_fixed(s, n) for n, s in latency.SECOND_SHARES.items())} from txn group by all"""


def _stored_histogram(spark, sf):
    path = scratch_path(spark, "histogram")
    txn = t.txn(spark, sf).withColumnsRenamed({"variant": "runset", "operation": "run"})
    folders = ["runset", "run", "step"]
    return sinks.write_latency_histogram(latency.latency_histogram(txn, folders), path, folders)


@query("scan_latency_histogram", FIXED_SQL)
def _(spark, sf):
    return sources.scan_latency_histogram(spark, _stored_histogram(spark, sf))


@query(
    "sink_latency_histogram",
    f"""select runset, run, step, cast(epoch_sec as varchar) as epoch_sec, cast(count as varchar) as count,
        printf('%.3f', avg_ms) as avg_ms, printf('%.3f', p50_ms) as p50_ms, printf('%.3f', p95_ms) as p95_ms,
        printf('%.3f', p99_ms) as p99_ms from ({FIXED_SQL})""",
)
def _(spark, sf):
    # Read back as text: the decimals in the files are part of the result.
    return spark.read.csv(_stored_histogram(spark, sf), header=True)


@query(
    "throughput",
    """select variant, step, count(*) as transactions, max(epoch_sec) - min(epoch_sec) as elapsed_sec,
       cast(count(*) as double) / nullif(max(epoch_sec) - min(epoch_sec), 0) as tps from txn group by all""",
)
def _(spark, sf):
    return latency.throughput(t.txn(spark, sf), ["variant", "step"])


@query(
    "per_script_stats",
    f"""select step, script_no, count(*) as latency_samples,
        cast(printf('%.6f', cast(sum(latency_us) as double) / 1000 / count(*)) as double) as latency_avg_ms, {PCT_SQL} from txn group by all""",
)
def _(spark, sf):
    return rounded(latency.per_script_stats(t.txn(spark, sf)), "latency_avg_ms", *PCT)


@query("unit_to_ms", "select txn_no, cast(latency_us as double) / 1000 as latency_ms from txn")
def _(spark, sf):
    return latency.with_latency_ms(t.txn(spark, sf)).select("txn_no", "latency_ms")


STDOUT = """concat_ws(chr(10), 'transaction type: multiple scripts', concat('latency average = ', txn_no, '.5 ms'),
    concat(' - latency average = ', epoch_us, ' ms'),
    case when txn_no % 3 > 0 then concat('  latency stddev = ', client_id, '.25 ms') end,
    case when txn_no % 5 > 0 then concat('tps = ', latency_us, '.125 (including connections establishing)') end,
    case when txn_no % 4 > 0 then concat('tps = ', latency_us + 1, '.5 (excluding connections establishing)') end)"""


@query(
    "stdout_last_match",
    """select txn_no, case when txn_no % 4 > 0 then latency_us + 1.5 when txn_no % 5 > 0 then latency_us + 0.125 end::double as tps,
       case when txn_no % 4 > 0 then latency_us + 1.5 end::double as tps_excluding, (txn_no + 0.5)::double as latency_avg_ms,
       case when txn_no % 3 > 0 then client_id + 0.25 end::double as latency_stddev_ms from txn""",
)
def _(spark, sf):
    texts = t.txn(spark, sf).select("txn_no", F.expr(STDOUT).alias("text"))
    return texts.select("txn_no", *[c.alias(n) for n, c in fn.stdout_figures(F.col("text")).items()])


@query(
    "scan_step_stdout",
    """select variant as runset, operation as run, step, (count(*) + 1.5)::double as tps, (count(*) + 1.5)::double as tps_excluding,
       (sum(latency_us) + 0.5)::double as latency_avg_ms, (max(latency_us) + 0.25)::double as latency_stddev_ms
       from txn group by all""",
)
def _(spark, sf):
    totals = t.txn(spark, sf).groupBy(F.col("variant").alias("runset"), F.col("operation").alias("run"), "step").agg(
        F.count(F.lit(1)).alias("n"), F.sum("latency_us").alias("total"), F.max("latency_us").alias("worst")
    )
    texts = totals.select(
        "runset", "run", "step",
        F.expr(
            """concat_ws(chr(10), concat('latency average = ', total, '.5 ms'), concat('latency stddev = ', worst, '.25 ms'),
            concat('tps = ', n, '.125 (including connections establishing)'),
            concat('tps = ', n + 1, '.5 (excluding connections establishing)'))"""
        ).alias("text"),
    )
    path = scratch_path(spark, "stdout")
    sinks.write_step_stdout(texts, path)
    return sources.scan_step_stdout(spark, path, "pgbench.log*")


# -- lag ------------------------------------------------------------------------------------

@query(
    "parse_lag_metric",
    """select node, epoch_sec, epoch_us, case metric when 'other_metric' then null when 'consumer_safe_time_lag' then value
       else value * (cast(1 as double) / 1000) end as lag_ms from prom_value""",
)
def _(spark, sf):
    return lag.parse_lag_text(t.prom_line(spark, sf)).select("node", "epoch_sec", "epoch_us", "lag_ms")


@query(
    "lag_worst_case",
    "select epoch_sec, cast(printf('%.2f', max(lag_ms)) as double) as lag_ms from node_lag group by all",
)
def _(spark, sf):
    return lag.lag_worst_case(lag.parse_lag_text(t.prom_line(spark, sf)), ["epoch_sec"])


@query(
    "lag_first_available",
    """select epoch_sec, arg_min(lag_ms, node) filter (where lag_ms is not null) as lag_ms from
       (select epoch_sec, node, cast(printf('%.2f', max(lag_ms)) as double) as lag_ms from node_lag group by all) group by all""",
)
def _(spark, sf):
    per_node = lag.lag_worst_case(lag.parse_lag_text(t.prom_line(spark, sf)), ["epoch_sec", "node"])
    return lag.lag_first_available(per_node, ["epoch_sec"], "node")


LAG_SQL = """cast(printf('%.2f', min(lag_ms)) as double) as min_lag_ms, cast(printf('%.2f', round(sum(lag_ms), 6) / count(*)) as double) as avg_lag_ms,
    cast(printf('%.2f', list_sort(list(lag_ms))[cast(ceil(count(*) * 0.95) as bigint)]) as double) as p95_lag_ms,
    cast(printf('%.2f', max(lag_ms)) as double) as max_lag_ms, count(*) as samples"""


@query("lag_summary", f"select variant, step, {LAG_SQL} from lag_snapshot where lag_ms is not null group by all")
def _(spark, sf):
    return lag.lag_summary(t.lag_snapshot(spark, sf), ["variant", "step"])


RISK_SQL = "case when {0} < 100 then 'Safe' when {0} <= 500 then 'Warning' when {0} > 500 then 'High Risk' end"


@query("dr_risk", f"select txn_no, {RISK_SQL.format('latency_us / 50')} as dr_risk from txn")
def _(spark, sf):
    return t.txn(spark, sf).select("txn_no", fn.dr_risk(F.col("latency_us") / F.lit(50)).alias("dr_risk"))


def _lag_rows(spark, sf):
    return t.lag_snapshot(spark, sf).selectExpr(
        "variant", "'lag' as operation", "step", "5 as interval_sec", "seq", "cast(elapsed_sec as int) as elapsed_sec",
        f"elapsed_sec + {t.START} as timestamp", "lag_ms",
    )


@query(
    "scan_lag_snapshots",
    """select variant as runset, 'lag' as run, step, 5 as interval_sec, cast(elapsed_sec as integer) as elapsed_sec,
       elapsed_sec + 1704067200 as "timestamp", lag_ms from lag_snapshot""",
)
def _(spark, sf):
    folders, path = ["variant", "operation", "step"], scratch_path(spark, "lag")
    sinks.write_snapshots(_lag_rows(spark, sf), path, folders, "replication_lag_over_time", ["elapsed_sec", "seq"])
    return sources.scan_lag_snapshots(spark, path, "replication_lag_over_time*", one_per_file=False)


def _stat_rows(spark, sf):
    return t.stat_snapshot(spark, sf).selectExpr(
        "variant", "step", "5 as interval_sec", "seq", "cast(elapsed_sec as int) as elapsed_sec", "mean_ms", "mean_ms / 2 as min_ms",
        "mean_ms * 2 as max_ms", "calls", "mean_ms as yb_p50_ms", "mean_ms as yb_p90_ms", "mean_ms as yb_p95_ms",
        "case when seq % 3 = 0 then mean_ms end as yb_p99_ms",
    )


STAT_SQL = """cast(elapsed_sec as integer) as elapsed_sec, mean_ms, mean_ms / 2 as min_ms, mean_ms * 2 as max_ms, calls,
    mean_ms as yb_p50_ms, mean_ms as yb_p90_ms, mean_ms as yb_p95_ms, case when seq % 3 = 0 then mean_ms end as yb_p99_ms"""


def _stored_snapshots(spark, sf):
    order = ["elapsed_sec", "seq"]
    return sinks.write_snapshots(_stat_rows(spark, sf), scratch_path(spark, "stat"), ["variant", "step"], "pg_stat_statements_over_time", order)


@query("scan_stat_snapshots", f"select variant as run, step, 5 as interval_sec, {STAT_SQL} from stat_snapshot")
def _(spark, sf):
    path = _stored_snapshots(spark, sf)
    return sources.scan_stat_snapshots(spark, path, "pg_stat_statements_over_time*", one_per_file=False).drop("runset")


@query(
    "snapshots_explode",
    """select txn_no, 5 as interval_sec, cast(epoch_us + n * 5 as integer) as elapsed_sec, cast(latency_us as double) / n as mean_ms,
       client_id * n as calls from txn, (select unnest([1, 2, 3]) as n) where n <= txn_no % 4""",
)
def _(spark, sf):
    # A document per transaction, of none to three snapshots.
    docs = t.txn(spark, sf).selectExpr(
        "txn_no", "5 as interval_sec",
        """transform(slice(array(1, 2, 3), 1, cast(txn_no % 4 as int)), n -> struct(cast(epoch_us + n * 5 as int) as elapsed_sec,
        cast(latency_us as double) / n as mean_ms, client_id * n as calls)) as snapshots""",
    )
    return sources.explode_snapshots(docs)


@query(
    "sink_snapshots_json",
    """select variant, step, 5 as interval_sec, count(*) as snapshots, sum(calls)::bigint as calls,
       min(elapsed_sec)::integer as first_sec, max(elapsed_sec)::integer as last_sec, count(*) filter (where seq % 3 = 0) as with_p99,
       0::bigint as out_of_order from stat_snapshot group by variant, step""",
)
def _(spark, sf):
    # Files of a folder are numbered in order, and so are the lines of a file.
    fields = "interval_sec int, seq bigint, " + sources.schemas.STAT_FIELDS + ", variant string, step string"
    lines = spark.read.json(_stored_snapshots(spark, sf), schema=fields).withColumns(
        {"file": F.col("_metadata.file_name"), "place": F.col("_metadata.file_block_start") * 0 + F.monotonically_increasing_id()}
    )
    before = F.lag(F.struct("elapsed_sec", "seq")).over(Window.partitionBy("variant", "step", "file").orderBy("place"))
    return lines.withColumn("late", before > F.struct("elapsed_sec", "seq")).groupBy("variant", "step", "interval_sec").agg(
        F.count(F.lit(1)).alias("snapshots"), F.sum("calls").alias("calls"), F.min("elapsed_sec").alias("first_sec"),
        F.max("elapsed_sec").alias("last_sec"), F.count("yb_p99_ms").alias("with_p99"), F.count_if("late").alias("out_of_order"),
    )


NESTED_STEPS = ["variant", "operation", "step"]


@query(
    "lag_documents",
    """select variant as runset, 'lag' as run, step, 5 as interval_sec, cast(elapsed_sec as integer) as elapsed_sec,
       elapsed_sec + 1704067200 as "timestamp", lag_ms from lag_snapshot""",
)
def _(spark, sf):
    # Nested documents, one per step, written and read back.
    rows, path = _lag_rows(spark, sf), scratch_path(spark, "lag-documents")
    sinks.write_snapshot_documents(rows, path, NESTED_STEPS, "replication_lag_over_time", ["elapsed_sec", "seq"], ["elapsed_sec", "timestamp", "lag_ms"])
    return sources.scan_lag_snapshots(spark, path, "replication_lag_over_time*")


@query("stat_documents", f"select variant as run, step, 5 as interval_sec, {STAT_SQL} from stat_snapshot")
def _(spark, sf):
    fields = [f.split()[0] for f in sources.schemas.STAT_FIELDS.split(",")]
    rows, path = _stat_rows(spark, sf), scratch_path(spark, "stat-documents")
    sinks.write_snapshot_documents(rows, path, ["variant", "step"], "pg_stat_statements_over_time", ["elapsed_sec", "seq"], fields)
    return sources.scan_stat_snapshots(spark, path, "pg_stat_statements_over_time*").drop("runset")


@query("lag_over_time", "select variant, step, elapsed_sec, lag_ms from lag_snapshot order by all")
def _(spark, sf):
    return lag.lag_over_time(t.lag_snapshot(spark, sf), ["variant", "step"])


@query(
    "lag_threshold",
    """with per_rate as (select variant, operation, client_id % 20 * 500 + 500 as rate, max(latency_us) / 1000 as lag_ms from txn group by all),
       seen as (select *, lag(rate) over w as prev_rate, lag(lag_ms) over w as prev_lag from per_rate
                window w as (partition by variant, operation order by rate))
       select variant, operation, min(rate) filter (where lag_ms > 1.2 * prev_lag) as limit_rate,
         coalesce(arg_min(prev_rate, rate) filter (where lag_ms > 1.2 * prev_lag), max(rate)) as last_good_rate
       from seen group by all""",
)
def _(spark, sf):
    rows = t.txn(spark, sf).select(
        "variant", "operation", (F.col("client_id") % 20 * 500 + 500).alias("rate"), fn.us_to_ms(F.col("latency_us")).alias("lag_ms")
    )
    return lag.lag_threshold(rows, ["variant", "operation"], "rate", "lag_ms", factor=1.2)


@query(
    "scan_metrics_text",
    """select 'scrape' as step, node, metric, labels, value from
       (select epoch_sec % 4 as node, metric, labels, value from prom_value)""",
)
def _(spark, sf):
    # One capture file per node position; metric text goes out and comes back parsed.
    path = scratch_path(spark, "metrics")
    lines = t.prom_line(spark, sf).selectExpr("'s' as runset", "'r' as run", "'scrape' as step", "epoch_sec % 4 as node", "line")
    sinks.write_metrics_text(lines, path, "scrape_before")
    rows = sources.scan_metrics_text(spark, path)
    return rows.select("step", F.col("node").cast("bigint").alias("node"), "metric", reports.label_text(F.col("labels")).alias("labels"), "value")


@query(
    "metrics_before_after",
    """with b as (select node, metric, labels, max(value) as value_before from prom_value where epoch_us < 500000 group by all),
       a as (select node, metric, labels, max(value) as value_after from prom_value where epoch_us >= 500000 group by all)
       select node, metric, labels, value_before, value_after, value_after - value_before as delta
       from b full outer join a using (node, metric, labels)""",
)
def _(spark, sf):
    rows = sources.parse_metrics_lines(t.prom_line(spark, sf)).withColumn("labels", reports.label_text(F.col("labels")))
    early = F.col("epoch_us") < 500000
    return reports.metrics_before_after(rows.where(early), rows.where(~early))


# -- statements -----------------------------------------------------------------------------

@query("workload_statement_filter", "select queryid, query from workload")
def _(spark, sf):
    return statements.workload_statements(t.statements(spark, sf)).select("queryid", "query")


SUMMARY_SQL = """cast(printf('%.3f', coalesce(cast(sum(total_time) as double) / nullif(sum(calls), 0), 0)) as double) as mean_exec_time_ms,
    cast(printf('%.3f', coalesce(min(min_time), 0)) as double) as min_exec_time_ms,
    cast(printf('%.3f', cast(coalesce(max(max_time), 0) as double)) as double) as max_exec_time_ms, coalesce(sum(calls), 0)::bigint as calls"""


@query("statement_summary", f"select {SUMMARY_SQL} from workload")
def _(spark, sf):
    return statements.statement_summary(t.statements(spark, sf))


@query(
    "statement_fallback",
    f"""with k as (select *, queryid % 997 as grp from statements where query not like '%pg_stat_statements%'),
        w as (select distinct grp from k where queryid in (select queryid from workload))
        select grp, {SUMMARY_SQL} from k where queryid in (select queryid from workload) or grp not in (select grp from w) group by grp""",
)
def _(spark, sf):
    # Small groups, so that some have no workload statement: there all other statements count.
    rows = t.statements(spark, sf).withColumn("grp", F.col("queryid") % 997)
    return statements.statement_summary_or_all(rows, when_empty=True, keys=["grp"])


@query(
    "scan_statement_stats",
    "select queryid, query, calls, total_time, min_time, max_time, yb_latency_histogram from statements",
)
def _(spark, sf):
    # Exported with the newer column names; the reader gives the older ones.
    path = scratch_path(spark, "statements")
    renamed = {"total_time": "total_exec_time", "min_time": "min_exec_time", "max_time": "max_exec_time"}
    t.statements(spark, sf).withColumnsRenamed(renamed).write.parquet(path)
    return sources.scan_statement_stats(spark, path).select(
        "queryid", "query", "calls", "total_time", "min_time", "max_time", "yb_latency_histogram"
    )


@query(
    "dominant_statement",
    """select server, queryid, calls, yb_latency_histogram from workload where yb_latency_histogram is not null
       qualify row_number() over (partition by server order by calls desc, queryid) = 1""",
)
def _(spark, sf):
    return statements.dominant_statement(t.statements(spark, sf), ["server"])


@query("top_statement", "select queryid, calls, query from workload order by calls desc, queryid limit 1")
def _(spark, sf):
    return statements.top_statements(statements.workload_statements(t.statements(spark, sf))).select("queryid", "calls", "query")


def _bucket_sql(percent: float, name: str) -> str:
    need = f"tot * cast({percent} as double)"
    return f"case when tot = 0 or tot is null then null when a >= {need} then 0.2 when a + b >= {need} then 0.4 when a + b + c >= {need} then 0.8 end::double as {name}"


HIST_SQL = ", ".join(_bucket_sql(p / 100, n) for n, p in statements.HISTOGRAM_PERCENTS.items())


@query(
    "histogram_percentile",
    f"""select queryid, {HIST_SQL} from (select queryid, k % 7 as a, k % 11 as b, k % 5 as c, case when k is not null then
        k % 7 + k % 11 + k % 5 + k % 3 end as tot from (select queryid, case when queryid % 9 > 0 then queryid end as k from statements))""",
)
def _(spark, sf):
    return statements.histogram_percentiles(t.statements(spark, sf).select("queryid", "yb_latency_histogram"))


@query("stats_json", f"select mean_exec_time_ms as mean, min_exec_time_ms as min, max_exec_time_ms as max, calls from (select {SUMMARY_SQL} from workload)")
def _(spark, sf):
    # The JSON text, read back: engines differ in blanks and digits of JSON, not in its values.
    text = statements.stats_json(t.statements(spark, sf))
    return text.select(F.from_json("stats", "mean double, min double, max double, calls bigint").alias("j")).select("j.*")


@query(
    "finite_round",
    """select txn_no, case when txn_no % 5 > 2 then cast(printf('%.3f', cast(latency_us as double) / 7) as double) end as value from txn""",
)
def _(spark, sf):
    raw = F.expr(
        """case txn_no % 5 when 0 then 'Infinity' when 1 then 'NaN' when 2 then 'n/a'
        else cast(cast(latency_us as double) / 7 as string) end"""
    )
    return t.txn(spark, sf).select("txn_no", fn.finite_round(raw).alias("value"))


@query(
    "last_snapshot",
    """select variant, step, elapsed_sec, seq, calls, mean_ms from stat_snapshot
       qualify row_number() over (partition by variant, step order by elapsed_sec desc, seq desc) = 1""",
)
def _(spark, sf):
    return statements.last_snapshot(t.stat_snapshot(spark, sf), ["variant", "step"], ["elapsed_sec", "seq"])


DELTA_SQL = """with seen as (select *, coalesce(lag(calls) over w, 0) as pc, coalesce(lag(mean_ms) over w, 0) as pm from stat_snapshot
    window w as (partition by variant, step order by elapsed_sec, seq))
    select variant, step, elapsed_sec, seq, case when calls >= pc then calls - pc end as interval_calls,
      case when calls > pc then (mean_ms * calls - pm * pc) / (calls - pc) end as interval_mean_ms from seen"""


@query("snapshot_delta", DELTA_SQL)
def _(spark, sf):
    return statements.snapshot_delta(
        t.stat_snapshot(spark, sf), ["variant", "step"], ["elapsed_sec", "seq"]
    )


@query(
    "smoothed_latency",
    f"""select variant, step, elapsed_sec, seq, interval_calls, interval_mean_ms, cast(printf('%.6f', avg(interval_mean_ms) over
        (partition by variant, step order by elapsed_sec, seq rows between 4 preceding and current row)) as double) as smoothed_ms from ({DELTA_SQL})""",
)
def _(spark, sf):
    rows = statements.smoothed_latency(t.stat_snapshot(spark, sf), ["variant", "step"], ["elapsed_sec", "seq"], 5, block=1000)
    return rounded(rows, "smoothed_ms")


@query("latency_over_time", "select variant, step, elapsed_sec, mean_ms from stat_snapshot order by all")
def _(spark, sf):
    return statements.latency_over_time(t.stat_snapshot(spark, sf), ["variant", "step"])


# -- step joins and comparisons over the log --------------------------------------------------

@query(
    "step_x_statement_stats",
    f"""select s.run, s.phase_idx, s.step_idx, s.step, x.mean_exec_time_ms, x.min_exec_time_ms, x.max_exec_time_ms, x.calls
        from step_row s left join (select run, phase_idx, step_idx, {SUMMARY_SQL} from workload group by all) x
        using (run, phase_idx, step_idx)""",
)
def _(spark, sf):
    stats = statements.statement_summary(t.statements(spark, sf), reports.STEP_KEY)
    return reports.join_step_results(t.step_row(spark, sf).select(*reports.STEP_KEY, "step"), stats)


@query(
    "step_x_lag_summary",
    f"""select s.variant, s.step, x.min_lag_ms, x.avg_lag_ms, x.p95_lag_ms, x.max_lag_ms, x.samples from planned_step s left join
        (select variant, step, {LAG_SQL} from lag_snapshot where lag_ms is not null group by all) x using (variant, step)""",
)
def _(spark, sf):
    stats = lag.lag_summary(t.lag_snapshot(spark, sf), ["variant", "step"])
    return reports.join_step_results(t.steps(spark, sf), stats, ["variant", "step"])


@query(
    "step_x_latency",
    f"""select s.variant, s.step, coalesce(x.latency_samples, 0) as latency_samples, {', '.join('x.' + c for c in PCT)}
        from planned_step s left join
        (select variant, step, count(*) as latency_samples, {PCT_SQL} from parsed group by all) x using (variant, step)""",
)
def _(spark, sf):
    # Planned steps come from one table, the log from another: idle steps have no samples.
    txn = latency.parse_txn_lines(t.txn_line(spark, sf))
    return rounded(latency.latency_percentiles_of(t.steps(spark, sf), txn, ["variant", "step"]), *PCT)


@query(
    "schema_decision",
    f"""select *, {RISK_SQL.format('p95_lag_ms')} as dr_risk from
        (select variant, cast(count(*) as double) / nullif(max(epoch_sec) - min(epoch_sec), 0) as tps, {PCT_SQL} from txn group by variant)
        left join (select variant, avg_lag_ms, p95_lag_ms, max_lag_ms from
          (select variant, {LAG_SQL} from lag_snapshot where lag_ms is not null group by variant)) using (variant)""",
)
def _(spark, sf):
    return rounded(comparisons.schema_decision(t.txn(spark, sf), t.lag_snapshot(spark, sf)), *PCT)


PER_OPERATION_SQL = f"""select {{keys}}, count(*) as transactions, cast(count(*) as double) / nullif(max(epoch_sec) - min(epoch_sec), 0) as tps,
    {', '.join(_q(s, n) for n, s in list(latency.STEP_SHARES.items())[1:])} from txn group by all"""


UNNAMED = "case when client_id % 50 > 0 then operation end"


@query("per_operation", PER_OPERATION_SQL.format(keys=f"{UNNAMED} as operation"))
def _(spark, sf):
    # Some transactions have no operation; they are a group of their own.
    txn = t.txn(spark, sf).withColumn("operation", F.expr(UNNAMED))
    return rounded(comparisons.per_operation(txn), *PCT[1:])


@query(
    "per_operation_wide",
    f"""select variant, {', '.join(f"max(tps) filter (where operation = '{o}') as {o}_tps, max(latency_p95_ms) filter (where operation = '{o}') as {o}_p95_ms"
        for o in t.STEP_NAMES[:5])} from ({PER_OPERATION_SQL.format(keys='variant, operation')}) group by variant""",
)
def _(spark, sf):
    rows = rounded(comparisons.per_operation(t.txn(spark, sf), ["variant", "operation"]), *PCT[1:])
    return comparisons.per_operation_wide(rows, "variant", t.STEP_NAMES[:5])


@query(
    "variant_rank",
    f"""with o as ({PER_OPERATION_SQL.format(keys='operation, variant')})
        select operation, variant, tps, latency_p95_ms, cast(rank() over (partition by operation order by tps desc) as integer) as tps_rank,
          cast(printf('%.6f', tps / max(tps) filter (where variant = 'plain') over (partition by operation)) as double) as tps_ratio,
          cast(printf('%.6f', latency_p95_ms / max(latency_p95_ms) filter (where variant = 'plain') over (partition by operation)) as double) as p95_ratio from o""",
)
def _(spark, sf):
    rows = rounded(comparisons.per_operation(t.txn(spark, sf), ["operation", "variant"]), *PCT[1:])
    return rounded(comparisons.variant_rank(rows), "tps_ratio", "p95_ratio")


@query(
    "target_vs_achieved",
    """select variant, step, target_tps, tps, tps / target_tps as achieved_share from
       (select variant, step, cast(max(client_id) as double) as target_tps, cast(count(*) as double) / nullif(max(epoch_sec) - min(epoch_sec), 0) as tps
        from txn group by all)""",
)
def _(spark, sf):
    keys = ["variant", "step"]
    txn = t.txn(spark, sf)
    targets = txn.groupBy(*keys).agg(F.max("client_id").cast("double").alias("target_tps"))
    return comparisons.target_vs_achieved(targets, latency.throughput(txn, keys), keys)
