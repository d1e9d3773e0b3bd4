"""Registered queries and, where SQL can say it, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = with_views(oracle)
        return function

    return register


# The driver's tables in the shape of load-test data, in the oracle's dialect. Every view is
# the counterpart of the function with the same name in ``driver_tables``.
VIEWS = {
    "txn": """
        select user_id as client_id, event_id as txn_no, cast(round(value * 1000) as bigint) as latency_us,
          case event_type when 'click' then 0 when 'error' then 1 when 'purchase' then 2 when 'signup' then 3 else 4 end as script_no,
          1704067200 + (epoch_us(ts) // 1000000 - 1704067200) // 3600 as epoch_sec,
          epoch_us(ts) % 1000000 as epoch_us, event_type as operation,
          concat(event_type, '_step', user_id % 3 + 1) as step,
          case user_id % 4 when 0 then 'plain' when 1 then 'index' when 2 then 'fk' else 'index_fk' end as variant
        from events""",
    "txn_line": """
        select variant, operation, step, concat_ws(' ', client_id, txn_no,
          case when txn_no % 97 = 0 then 'skipped' when txn_no % 101 = 0 then '70000000' else cast(latency_us as varchar) end,
          script_no, epoch_sec, case when txn_no % 103 = 0 then null else epoch_us end,
          case when txn_no % 2 = 0 and txn_no % 103 <> 0 then 15 else null end) as line from txn""",
    "parsed": """
        select variant, operation, step, cast(f[1] as integer) as client_id, cast(f[2] as bigint) as txn_no,
          cast(f[3] as bigint) as latency_us, cast(f[4] as integer) as script_no, cast(f[5] as bigint) as epoch_sec,
          cast(f[6] as bigint) as epoch_us, cast(f[7] as bigint) as schedule_lag
        from (select variant, operation, step, line, string_split(trim(line), ' ') as f from txn_line)
        where regexp_full_match(trim(line), '([+-]?[0-9]+ +){5,}[+-]?[0-9]+') and cast(f[3] as bigint) between 0 and 60000000""",
    "lag_snapshot": """
        select variant, step, epoch_sec - 1704067200 as elapsed_sec, txn_no as seq,
          case when txn_no % 7 = 0 then null else cast(latency_us as double) / 1000 end as lag_ms
        from txn""",
    "stat_snapshot": """
        select variant, step, epoch_sec - 1704067200 as elapsed_sec, txn_no as seq,
          cast(greatest(0, txn_no * 3 + client_id % 5 - case when txn_no % 50 = 0 then 1000 else 0 end) as bigint) as calls,
          cast(latency_us as double) / 1000 as mean_ms
        from txn""",
    "planned_step": """
        select distinct case c_custkey % 4 when 0 then 'plain' when 1 then 'index' when 2 then 'fk' else 'index_fk' end as variant,
          concat(['click', 'error', 'purchase', 'signup', 'view', 'idle'][c_custkey // 4 % 6 + 1], '_step', c_custkey // 24 % 3 + 1) as step
        from customer""",
    "nested": """
        select concat('set_', k % 50) as runset, concat('run-', k) as run, phase, step, type, exit_code, tps, latency_p95_ms, pg_stat_calls,
          replication_max_lag_ms, server_metrics
        from (
          select k, 'select' as phase, concat('select_step', n) as step, 'pgbench' as type, 0 as exit_code, cast(c * n as double) as tps,
            cast(c as double) / 8 + n as latency_p95_ms, case when k % 3 = n then k end as pg_stat_calls,
            case when k % 2 = n - 1 then cast(k as double) end as replication_max_lag_ms, concat('/r/', k, '/', n, '.txt') as server_metrics
          from (select o_orderkey as k, o_custkey as c, unnest([1, 2]) as n from orders)
          union all select o_orderkey, 'api', '', 'http', 0, null, null, null, null, '' from orders where o_orderkey % 5 = 0
          union all select o_orderkey, 'other', '', 'custom', null, null, null, null, null, '' from orders where o_orderkey % 7 = 0)""",
    "statements": """
        select o_orderkey as queryid, concat('run-', o_orderkey) as run, cast(o_orderkey % 3 as integer) as phase_idx,
          cast(o_orderkey % 7 as integer) as step_idx, o_custkey % 20 as server,
          case o_orderpriority when '1-URGENT' then 'SELECT payload FROM t3 WHERE id = $1'
          when '2-HIGH' then 'UPDATE t4 SET payload = payload + $1' when '3-MEDIUM' then 'insert into t5 (ref_id) values ($1)'
          when '4-NOT SPECIFIED' then 'select * from pg_stat_statements' else 'SHOW search_path' end as query,
          o_orderkey % 50 + 1 as calls, cast(o_totalprice as decimal(18,2)) as total_time,
          cast(o_custkey % 9 as double) / 10 as min_time, cast(o_totalprice as decimal(18,2)) as max_time,
          case when o_orderkey % 9 = 0 then null else concat('[{"[0.1,0.2)": ', o_orderkey % 7, '}, {"[0.2,0.4)": ',
            o_orderkey % 11, '}, {"[0.4,0.8)": ', o_orderkey % 5, '}, {"[0.8,)": ', o_orderkey % 3, '}]') end as yb_latency_histogram
        from orders""",
    "workload": """
        select * from statements where (query ilike '%from t%' or query ilike '%into t%' or query ilike '%update t%')
          and query not like '%pg_stat_statements%'""",
    "prom_line": """
        select client_id as node, epoch_sec, epoch_us, concat(case script_no when 0 then 'async_replication_committed_lag_micros'
          when 1 then 'async_replication_sent_lag_micros' when 2 then 'consumer_safe_time_lag' else 'other_metric' end,
          '{stream="s', txn_no % 5, '"} ', case when script_no = 2 then latency_us // 1000 else latency_us end) as line from txn""",
    "prom_value": """
        select node, epoch_sec, epoch_us, split_part(line, '{', 1) as metric,
          concat('stream=', split_part(split_part(line, '"', 2), '"', 1)) as labels,
          cast(split_part(line, ' ', 2) as double) as value from prom_line""",
    "node_lag": """
        select node, epoch_sec, metric, case metric when 'other_metric' then null
          when 'consumer_safe_time_lag' then value else value * (cast(1 as double) / 1000) end as lag_ms from prom_value""",
    "request": """
        select o_orderkey as seq, o_custkey as account_id, case when o_orderkey % 100 < 60 then 'select'
          when o_orderkey % 100 < 85 then 'update' when o_orderkey % 100 < 95 then 'insert' else 'delete' end as op,
          o_orderkey * 37 % 101 - 50 as delta, epoch_us(o_orderdate) as req_ts from orders""",
    "account": "select c_custkey as id, cast(round(c_acctbal * 100) as bigint) as balance from customer",
    "uuids": """
        select k, concat(substr(m, 1, 8), '-', substr(m, 9, 4), '-', substr(m, 13, 4), '-', substr(m, 17, 4), '-', substr(m, 21, 12)) as id
        from (select o_orderkey as k, md5(cast(o_orderkey as varchar)) as m from orders)""",
    "account_log": """
        select u.id, o_custkey as account_id, o_orderkey as seq from orders join uuids u on u.k = o_orderkey""",
    "line_step": """
        select l_orderkey as k, case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as phase_idx,
          l_linenumber - 1 as step_idx, max(l_partkey) as pk, max(l_suppkey) as sk, max(l_quantity) as qty,
          max(l_extendedprice) as hi, min(l_extendedprice) as lo
        from lineitem group by 1, 2, 3""",
    "step_row": """
        select concat('set_', k % 50) as runset, concat('run-', k) as run, phase_idx, step_idx,
          case phase_idx when 0 then 'select' when 1 then 'insert' else 'update' end as phase,
          concat(case phase_idx when 0 then 'select' when 1 then 'insert' else 'update' end, '_step', step_idx + 1) as step,
          cast(qty as integer) as clients, cast(sk % 8 + 1 as integer) as jobs, cast(30 + pk % 4 * 30 as integer) as duration_sec,
          case when pk % 4 = 0 then null else cast((pk % 10 + 1) * 1000 as double) end as target_tps,
          case when pk % 4 = 0 then pk * 10 + 50 end as total_transactions,
          case when sk % 11 = 0 then null else hi end as tps, case when sk % 11 = 0 then null else lo end as tps_excluding,
          case when step_idx = 5 then null else cast(pk as double) / 8 end as latency_avg_ms,
          case sk % 4 when 0 then cast(pk as double) / 100000000 when 1 then cast(pk as double) * 10000000000000
            when 2 then cast(pk as double) * 1000000 end as latency_stddev_ms,
          case when step_idx % 3 = 2 then null else cast(sk as double) / 4 end as server_ms,
          pk * 3 as latency_samples, cast(pk as double) / 8 as latency_p50_ms, cast(pk + 8 as double) / 8 as latency_p90_ms,
          cast(pk + 16 as double) / 8 as latency_p95_ms, cast(pk + 32 as double) / 8 as latency_p99_ms,
          case when step_idx % 2 = 0 then cast(sk as double) end as lag_ms, sk
        from line_step""",
    "flat": """
        select runset, run, phase, phase as operation, step, 'pgbench' as type, 0 as exit_code, duration_sec, target_tps,
          cast(null as bigint) as transactions_per_client, total_transactions, clients, jobs, tps, tps_excluding,
          latency_avg_ms, latency_stddev_ms, latency_p50_ms, latency_p90_ms, latency_p95_ms, latency_p99_ms,
          latency_samples, concat('/r/', step, '/latency_histogram.csv') as latency_histogram_csv,
          case when step_idx = 6 then '' else concat('/r/', step, '/pgbench_log.1;/r/', step, '/pgbench_log.2') end as pgbench_log_files,
          concat('/r/', step, '/before.txt') as server_metrics, concat('/r/<"', step, '", 1>/pgbench.log') as log,
          server_ms as pg_stat_mean_ms, server_ms / 2 as pg_stat_min_ms, server_ms * 2 as pg_stat_max_ms,
          case when server_ms is not null then sk end as pg_stat_calls, latency_avg_ms - server_ms as overhead_ms,
          server_ms as yb_p50_ms, server_ms as yb_p90_ms, server_ms as yb_p95_ms, cast(null as double) as yb_p99_ms,
          lag_ms / 2 as replication_avg_lag_ms, lag_ms / 4 as replication_min_lag_ms, lag_ms as replication_p95_lag_ms,
          lag_ms * 2 as replication_max_lag_ms
        from step_row
        union all by name
        select concat('set_', o_orderkey % 50) as runset, concat('run-', o_orderkey) as run, 'api' as phase, 'api' as operation, '' as step,
          'http' as type, 0 as exit_code, concat('/r/', o_orderkey, '/api.log') as log, '' as pgbench_log_files, '' as server_metrics
        from orders where o_orderkey % 5 = 0
        union all by name
        select concat('set_', o_orderkey % 50) as runset, concat('run-', o_orderkey) as run, 'other' as phase, 'other' as operation, '' as step,
          'custom' as type, '' as pgbench_log_files, '' as server_metrics
        from orders where o_orderkey % 7 = 0""",
    "plan_row": """
        select concat('run-', k) as run, dense_rank() over (partition by k order by phase_idx) - 1 as phase_idx,
          case when k % 11 = 0 then 'pgbench' when phase_idx = 0 then 'select' when phase_idx = 1 then 'insert' else 'update' end as phase,
          (k + phase_idx) % 4 as kind, row_number() over (partition by k, phase_idx order by step_idx) - 1 as pos, pk, sk,
          case when sk % 3 = 0 then null else cast(qty as integer) end as step_clients,
          case when k % 6 = 0 then null else cast(k % 16 + 1 as integer) end as phase_clients,
          max(pk) over (partition by k, phase_idx) + 1 as phase_pk
        from line_step""",
    "plan_step": """
        select run, cast(phase_idx as integer) as phase_idx, cast(pos as integer) as step_idx, phase,
          concat(phase, '_', case kind when 0 then concat((pk % 10 + 1) * 500, 'tps') when 1 then concat(pk * 10 + 7, 'tx')
            else concat('capacity_step', pos + 1) end) as step,
          case kind when 0 then 'tps' when 1 then 'transaction_count' else 'capacity' end as mode,
          case kind when 1 then null else 60 end as duration_sec,
          case kind when 0 then cast((pk % 10 + 1) * 500 as double) end as target_tps,
          case kind when 1 then greatest(1, (pk * 10 + 7 + coalesce(step_clients, phase_clients, 8) - 1) // coalesce(step_clients, phase_clients, 8)) end
            as transactions_per_client,
          case kind when 1 then pk * 10 + 7 end as total_transactions, coalesce(step_clients, phase_clients, 8) as clients, 2 as jobs
        from plan_row where kind < 3
        union all
        select distinct run, cast(phase_idx as integer), 0, phase,
          concat(phase, '_', greatest(1, (phase_pk + coalesce(phase_clients, 1) - 1) // coalesce(phase_clients, 1)), 'tpc'), 'transaction_count',
          cast(null as integer), cast(null as double),
          greatest(1, (phase_pk + coalesce(phase_clients, 1) - 1) // coalesce(phase_clients, 1)), phase_pk, phase_clients, cast(null as integer)
        from plan_row where kind = 3""",
}


def with_views(sql: str) -> str:
    """Put the views that the text names, and those that they name, in front as CTEs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        words = set("".join(c if c.isalnum() or c == "_" else " " for c in text).split())
        for name, body in VIEWS.items():
            if name in words and name not in needed:
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    ordered = [n for n in VIEWS if n in needed]
    ctes = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in ordered)
    text = sql.strip()
    if not ctes:
        return text
    return f"with {ctes},\n{text[5:]}" if text.startswith("with ") else f"with {ctes}\n{text}"
