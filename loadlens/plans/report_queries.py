"""Queries over run documents, reports, listings and load plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens import functions as fn
from loadlens.operators import latency, reports
from loadlens.plans import comparisons, loadplan
from loadlens.plans import driver_tables as t
from loadlens.plans.registry import query
from loadlens.session import scratch_path, store
from loadlens.sinks import files as sinks
from loadlens.sources import files as sources
from loadlens.sources.schemas import HTML_COLUMNS, LISTING_RECORD, MONO_COLUMNS, REPORT_COLUMNS

FLAT = ", ".join(REPORT_COLUMNS)
TEXT_COLUMNS = ["phase", "operation", "step", "type", "latency_histogram_csv", "pgbench_log_files", "server_metrics", "log"]
# A CSV file cannot tell an empty text from null.
READ_BACK = ", ".join(f"nullif({c}, '') as {c}" if c in TEXT_COLUMNS else c for c in REPORT_COLUMNS)


def _flat(spark, sf):
    return reports.flatten_records(t.records(spark, sf, throughput=False))


def _report_rows(rows):
    return reports.flatten_records(t.record_docs(rows))


def _stored_records(spark, sf):
    # JSON with all null fields is some 1.8 KB a step, of which little is left when packed.
    return sinks.write_summaries(t.record_rows(spark, sf), scratch_path(spark, "summaries"), render=t.record_docs, compression="gzip")


@query("flatten_report", f"select runset, run, {FLAT} from flat")
def _(spark, sf):
    return _flat(spark, sf).drop("phase_idx", "step_idx")


@query("flatten_nested", "select runset, run, phase, step, type, exit_code, tps, latency_p95_ms, pg_stat_calls, replication_max_lag_ms, server_metrics from nested")
def _(spark, sf):
    return reports.flatten_report(t.summaries(spark, sf)).select(*NESTED)


NESTED = ["runset", "run", "phase", "step", "type", "exit_code", "tps", "latency_p95_ms", "pg_stat_calls", "replication_max_lag_ms", "server_metrics"]


@query("scan_summary", f"select {', '.join(NESTED)} from nested")
def _(spark, sf):
    path = scratch_path(spark, "documents")
    sinks.write_run_documents(t.summaries(spark, sf).drop("runset", "run"), path, compression="gzip")
    docs = sources.scan_summary(spark, path, "summary*", one_per_file=False)
    return reports.flatten_report(docs).select(*NESTED)


@query(
    "sink_summary_json",
    """select f.runset, f.run, concat('label of ', f.run) as run_label, count(distinct phase) as phases,
       count(*) filter (where type = 'pgbench') as steps, count(*) filter (where type = 'http') as http_phases, cast(printf('%.2f', any_value(p.phase_tps)) as double) as phase_tps
       from flat f left join (select run, sum(tps) as phase_tps from
         (select run, phase_idx, last(tps order by step_idx) as tps from step_row group by all) group by run) p on p.run = f.run
       group by f.runset, f.run""",
)
def _(spark, sf):
    listing = reports.run_listing(sources.scan_summary_records(spark, _stored_records(spark, sf), fields=LISTING_RECORD))
    return listing.withColumn("phase_tps", fn.round_half_even(F.col("phase_tps"), 2))


@query("summary_documents", f"select runset, {FLAT} from flat")
def _(spark, sf):
    # Nested documents, one per run set, with the phases of all its runs one after the other; written and read back.
    path = scratch_path(spark, "summary-documents")
    rows = t.record_docs(store(t.record_rows(spark, sf), "record-rows"))  # heads, phases and steps are taken from the same rows
    number = F.regexp_extract("run", r"(\d+)$", 1).cast("int") * 5 + F.col("phase_idx")
    sinks.write_summary_documents(rows.withColumn("phase_idx", number.cast("int")).withColumn("run", F.col("runset")), path, compression="gzip")
    # A run set's document grows with the input, beyond what a cell or an executor holds.
    docs = sources.scan_summary(spark, path, "summary*", part_size=1 << 18)
    return reports.flatten_report(docs).drop("phase_idx", "step_idx", "run")


def _stored_report(spark, sf):
    return sinks.write_report_csv(t.record_rows(spark, sf, throughput=False), scratch_path(spark, "report"), ["runset"], _report_rows, "gzip")


@query("scan_report_csv", f"select runset, {READ_BACK} from flat")
def _(spark, sf):
    rows = sources.scan_report_csv(spark, _stored_report(spark, sf))
    return rows.drop("runset").withColumnRenamed("run", "runset")  # the files lie right below their run set


@query("sink_report_csv", "select runset, " + ", ".join(f"cast(nullif(cast({c} as varchar), '') as varchar) as {c}" for c in REPORT_COLUMNS) + " from flat")
def _(spark, sf):
    # Read back as text: number formats in the file are part of the result.
    return spark.read.csv(_stored_report(spark, sf), **sources.CSV)


def _cell(name: str) -> str:
    tag = '<td class="mono">' if name in MONO_COLUMNS else "<td>"
    escaped = f"replace(replace(replace(replace(coalesce(cast({name} as varchar), ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"
    return f"'{tag}', {escaped}, '</td>'"


@query(
    "report_html_rows",
    f"select runset, run, concat('        <tr>', {', '.join(_cell(c) for c in HTML_COLUMNS)}, '</tr>') as html from flat",
)
def _(spark, sf):
    return reports.report_html_rows(_flat(spark, sf), ["runset", "run"])


@query("client_overhead", "select run, phase_idx, step_idx, latency_avg_ms - server_ms as overhead_ms from step_row")
def _(spark, sf):
    return t.step_row(spark, sf).select(
        *reports.STEP_KEY, fn.client_overhead(F.col("latency_avg_ms"), F.col("server_ms")).alias("overhead_ms")
    )


@query(
    "server_time_estimate",
    """select run, phase_idx, step_idx, latency_avg_ms - min(latency_avg_ms) over (partition by runset) as server_estimate_ms from step_row""",
)
def _(spark, sf):
    steps = t.step_row(spark, sf)
    trivial = steps.groupBy("runset").agg(F.min("latency_avg_ms").alias("baseline_ms"))
    return steps.join(trivial, "runset").select(
        *reports.STEP_KEY,
        fn.server_time_estimate(F.col("latency_avg_ms"), F.col("baseline_ms")).alias("server_estimate_ms"),
    )


@query(
    "phase_last_step",
    """select run, phase_idx, last(tps order by step_idx) as tps, last(tps_excluding order by step_idx) as tps_excluding
       from step_row group by all""",
)
def _(spark, sf):
    return reports.phase_last_step(t.step_row(spark, sf))


# -- listings -------------------------------------------------------------------------------

LABELED = "select concat('set_', o_orderkey % 50) as runset, concat('run-', o_orderkey) as run, case when o_orderpriority = '5-LOW' then '' else concat('label ', o_custkey) end as run_label from orders"


def _runs_with_labels(spark, sf):
    # Runs of low priority have left no summary.
    runs = t.run_row(spark, sf)
    labels = runs.where("o_orderpriority <> '5-LOW'").selectExpr("runset", "run", "concat('label ', o_custkey) as run_label")
    return reports.runs_with_labels(runs.select("runset", "run"), labels)


@query("run_x_label", LABELED)
def _(spark, sf):
    return _runs_with_labels(spark, sf)


@query("runs_with_labels", LABELED + " order by runset, run")
def _(spark, sf):
    return reports.sorted_runs(_runs_with_labels(spark, sf))


@query("runs_sorted", "select concat('set_', o_orderkey % 50) as runset, concat('run-', o_orderkey) as run from orders order by 1, 2")
def _(spark, sf):
    return reports.sorted_runs(t.run_row(spark, sf).select("runset", "run"))


@query(
    "run_set_counts",
    "select concat('set_', c_custkey % 97) as runset, count(o_orderkey) as runs from customer left join orders on o_custkey = c_custkey group by 1 having count(o_orderkey) >= 1",
)
def _(spark, sf):
    sets = t.table(spark, sf, "customer").selectExpr("c_custkey", "concat('set_', c_custkey % 97) as runset")
    runs = t.table(spark, sf, "orders").selectExpr("o_custkey", "concat('run-', o_orderkey) as run")
    return reports.run_set_counts(sets.join(runs, F.col("o_custkey") == F.col("c_custkey"), "left"))


@query("run_id_format", "select o_orderkey, strftime(o_orderdate + to_seconds(o_orderkey), '%Y%m%d-%H%M%S') as run_id, epoch_us(o_orderdate) + o_orderkey * 1000000 as back_us from orders")
def _(spark, sf):
    at = F.expr("timestampadd(second, o_orderkey, cast(o_orderdate as timestamp))")
    ids = t.table(spark, sf, "orders").select("o_orderkey", fn.run_id(at).alias("run_id"))
    return ids.withColumn("back_us", F.unix_micros(fn.run_id_time(F.col("run_id"))))


@query("latest_run", "select concat('set_', o_custkey % 40) as runset, max(strftime(o_orderdate + to_seconds(o_orderkey), '%Y%m%d-%H%M%S')) as latest from orders group by 1")
def _(spark, sf):
    at = F.expr("timestampadd(second, o_orderkey, cast(o_orderdate as timestamp))")
    runs = t.table(spark, sf, "orders").select(
        F.expr("concat('set_', o_custkey % 40)").alias("runset"), fn.run_id(at).alias("run")
    )
    return reports.latest_run(runs)


@query(
    "elapsed_seconds",
    "select event_id, cast(trunc((epoch_us(ts) - 1705000000000000) / 1000000) as bigint) as elapsed_sec from events",
)
def _(spark, sf):
    now = F.unix_micros(F.col("ts").cast("timestamp"))
    start = F.lit(1705000000000000).cast("bigint")
    return t.table(spark, sf, "events").select("event_id", fn.elapsed_seconds(now, start).alias("elapsed_sec"))


NAME = "concat(case {k} % 4 when 0 then 'run-' when 1 then 'a b' when 2 then '../' else 'x_' end, {k}, case when {k} % 3 = 0 then '.1' else '' end)"


@query(
    "valid_run_name",
    f"""select o_orderkey, regexp_full_match(name, '[A-Za-z0-9._-]+') as run_name, regexp_full_match(name, '[A-Za-z0-9_]+') as db_name,
        regexp_full_match(strftime(o_orderdate, '%Y%m%d-%H%M') || case when o_orderkey % 2 = 0 then '00' else 'xx' end, '[0-9]{{8}}-[0-9]{{6}}') as run_id
        from (select *, {NAME.format(k='o_orderkey')} as name from orders)""",
)
def _(spark, sf):
    rows = t.table(spark, sf, "orders").withColumns(
        {
            "name": F.expr(NAME.format(k="o_orderkey")),
            "id": F.expr("concat(date_format(o_orderdate, 'yyyyMMdd-HHmm'), case when o_orderkey % 2 = 0 then '00' else 'xx' end)"),
        }
    )
    return rows.select(
        "o_orderkey", fn.is_run_name(F.col("name")).alias("run_name"), fn.is_db_name(F.col("name")).alias("db_name"),
        fn.is_run_id(F.col("id")).alias("run_id"),
    )


# -- text -----------------------------------------------------------------------------------

@query(
    "sanitize_nonfinite",
    """select event_id, concat('{"v": ', case when event_id % 3 = 0 then 'null' when event_id % 3 = 1 then 'null' else cast(user_id as varchar) end,
       ', "w": ', case when event_id % 5 = 0 then 'null' else '1' end, ', "s": "', case when event_id % 7 = 0 then 'a null b' else event_type end, '"}') as text
       from events""",
)
def _(spark, sf):
    raw = F.expr(
        """concat('{"v": ', case event_id % 3 when 0 then 'NaN' when 1 then '-Infinity' else cast(user_id as string) end,
        ', "w": ', case when event_id % 5 = 0 then 'Infinity' else '1' end,
        ', "s": "', case when event_id % 7 = 0 then 'a NaN b' else event_type end, '"}')"""
    )
    return t.table(spark, sf, "events").select("event_id", fn.sanitize_nonfinite(raw).alias("text"))


@query(
    "html_escape",
    """select page_id, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') as html from pages""",
)
def _(spark, sf):
    return t.table(spark, sf, "pages").select("page_id", fn.html_escape(F.col("html")).alias("html"))


@query(
    "join_list",
    """select c_custkey, case c_custkey % 3 when 0 then '' when 1 then concat(c_name, ';', c_mktsegment) else '' end as listed,
       case when c_custkey % 2 = 0 then concat('/', c_name, ';/', c_mktsegment) else concat('/', c_mktsegment) end as paths from customer""",
)
def _(spark, sf):
    listed = F.expr("case c_custkey % 3 when 0 then cast(array() as array<string>) when 1 then array(c_name, c_mktsegment) end")
    paths = F.expr(
        """array(struct('u' as url, case when c_custkey % 2 = 0 then concat('/', c_name) else '' end as path),
        struct('v' as url, concat('/', c_mktsegment) as path), struct('w' as url, cast(null as string) as path))"""
    )
    return t.table(spark, sf, "customer").select(
        "c_custkey", fn.join_list(listed).alias("listed"), fn.join_metric_paths(paths).alias("paths")
    )


# -- load plans -----------------------------------------------------------------------------

STEP_COLUMNS = "run, phase_idx, step_idx, phase, step, mode, duration_sec, target_tps, transactions_per_client, total_transactions, clients, jobs"


def _plan_steps(spark, sf):
    return loadplan.plan_steps(t.plans(spark, sf).withColumnRenamed("run_label", "run"), ["run"])


@query("scan_load_plan", f"select {STEP_COLUMNS} from plan_step")
def _(spark, sf):
    path = scratch_path(spark, "plans")
    t.plans(spark, sf).write.option("mapreduce.output.basename", "plan").json(path)
    plans = sources.scan_load_plan(spark, path, "plan*", one_per_file=False)
    return loadplan.plan_steps(plans.withColumnRenamed("run_label", "run"), ["run"])


@query("explode_ramp", f"select {STEP_COLUMNS} from plan_step")
def _(spark, sf):
    return _plan_steps(spark, sf)


@query("step_label", "select run, phase_idx, step_idx, step from plan_step")
def _(spark, sf):
    return _plan_steps(spark, sf).select(*reports.STEP_KEY, "step")


@query("step_mode", "select mode, count(*) as steps from plan_step group by mode")
def _(spark, sf):
    return _plan_steps(spark, sf).groupBy("mode").agg(F.count(F.lit(1)).alias("steps"))


@query("clients_resolved", "select run, phase_idx, step_idx, clients, jobs from plan_step")
def _(spark, sf):
    return _plan_steps(spark, sf).select(*reports.STEP_KEY, "clients", "jobs")


@query("split_transactions", "select o_orderkey, greatest(1, (o_orderkey * 31 + o_custkey) // (o_custkey + 1)) as per_client from orders")
def _(spark, sf):
    total, clients = F.col("o_orderkey") * 31, F.col("o_custkey") + 1
    return t.table(spark, sf, "orders").select("o_orderkey", fn.split_transactions(total, clients).alias("per_client"))


@query(
    "client_sizing",
    """select run, phase_idx, step_idx, clients, cast(ceil(target_tps * latency_avg_ms * cast(2 as double) / 1000) as bigint) as clients_needed,
       clients >= cast(ceil(target_tps * latency_avg_ms * cast(2 as double) / 1000) as bigint) as enough from step_row""",
)
def _(spark, sf):
    steps = t.step_row(spark, sf).select(*reports.STEP_KEY, "clients", "target_tps", "latency_avg_ms")
    return loadplan.size_clients(steps).drop("target_tps", "latency_avg_ms")


@query(
    "split_urls",
    "select run, unnest([concat('http://a', k), 'http://b']) as url from (select distinct concat('run-', k) as run, k from line_step)",
)
def _(spark, sf):
    plans = t.plans(spark, sf)
    return plans.select(
        F.col("run_label").alias("run"), F.explode(fn.split_urls(F.col("server_metrics.tserver_urls"))).alias("url")
    )


@query(
    "plan_normalize",
    """select concat('run-', k) as run, case k % 3 when 1 then 'xcluster' else 'stretch' end as cluster_type,
       case when k % 4 = 0 then 'active-active' when k % 3 = 1 then 'active-passive' else 'none' end as replication_mode,
       k % 3 = 1 as xcluster_enabled, k % 2 = 0 as pg_stat_statements, case when k % 5 = 0 then 5 else 0 end as poll_sec,
       case when k % 3 <> 1 then 0 when k % 2 = 0 then 10 else 5 end as lag_sec, true as csv,
       case when k % 3 = 0 then 'db.local' else '127.0.0.1' end as host, case when k % 17 = 0 then 'port' when k % 4 > 0 then '5444' else '5433' end as port,
       'tester' as "user", 'postgres' as admin_dbname, k % 2 = 0 as create_db, false as drop_db,
       case when k % 13 = 0 then 'invalid dbname' when k % 17 = 0 then 'db.port must be an integer' end as error
       from (select distinct k from line_step)""",
)
def _(spark, sf):
    return loadplan.normalize_plans(t.plans(spark, sf), default_user="tester").select(
        F.col("run_label").alias("run"), "cluster.cluster_type", "cluster.replication_mode", "cluster.xcluster_enabled",
        "server_metrics.pg_stat_statements",
        F.col("server_metrics.pg_stat_statements_interval_sec").alias("poll_sec"),
        F.col("replication_metrics.interval_sec").alias("lag_sec"), "reports.csv",
        "db.host", "db.port", "db.user", "db.admin_dbname", "schema.create_db", "schema.drop_db", "error",
    )


@query(
    "script_weights",
    """select run, cast(phase_idx as integer) as phase_idx, phase, script_no, script, weight, cast(weight as double) / total as share from
       (select run, phase_idx, phase, k % 2 = 0 as mixed, max(pk) + 1 as top from
          (select *, cast(substr(run, 5) as bigint) as k from plan_row) group by all) p,
       lateral (select unnest(case when mixed then [0, 1] else [0] end)::integer as script_no) n,
       lateral (select case when not mixed then concat('scripts/', (case q.phase_idx when 0 then 'select' when 1 then 'insert' else 'update' end), '.sql')
          when script_no = 0 then 'a.sql' else 'b.sql' end as script, case when mixed and script_no = 0 then top else 1 end::integer as weight,
          case when mixed then top + 1 else 1 end as total
          from (select distinct k as k2, phase_idx, dense_rank() over (partition by k order by phase_idx) - 1 as pos from line_step) q
          where q.pos = p.phase_idx and concat('run-', q.k2) = p.run) w""",
)
def _(spark, sf):
    return latency.script_weights(t.plans(spark, sf).withColumnRenamed("run_label", "run"), ["run"])


# -- comparison views over the flat report ----------------------------------------------------

@query(
    "summary_comparison",
    """select runset, run, concat('label of ', run) as run_label, operation, step, tps, latency_p90_ms, latency_p95_ms, latency_p99_ms, clients
       from flat""",
)
def _(spark, sf):
    labels = t.run_row(spark, sf).selectExpr("runset", "run", "concat('label of ', run) as run_label")
    return comparisons.summary_comparison(_flat(spark, sf), labels)


@query("connection_count", "select runset, run, step, clients from flat")
def _(spark, sf):
    return comparisons.connection_count(_flat(spark, sf))


@query("latency_breakdown", "select runset, run, step, latency_avg_ms as client_ms, pg_stat_mean_ms as server_ms, overhead_ms from flat")
def _(spark, sf):
    return comparisons.latency_breakdown(_flat(spark, sf))


@query("run_details", "select runset, run, phase, step, clients, jobs, duration_sec, target_tps, total_transactions from flat")
def _(spark, sf):
    return comparisons.run_details(_flat(spark, sf))
