"""Schemas of the documents and tables. Field names are the file formats' own (fixed values)."""

# Measurements of one step; the flat report takes them from a step, or from a phase without steps.
STEP_STRUCT = """
    name string, step string, type string, cmd array<string>, exit_code int, error string,
    log string, log_dir string, duration_sec int, target_tps double,
    transactions_per_client bigint, total_transactions bigint, clients int, jobs int,
    tps double, tps_excluding double, latency_avg_ms double, latency_stddev_ms double,
    latency_samples bigint, latency_p50_ms double, latency_p90_ms double,
    latency_p95_ms double, latency_p99_ms double, latency_histogram_csv string,
    pgbench_log_files array<string>,
    server_metrics array<struct<url: string, path: string>>,
    pg_stat_statements struct<
        mean_exec_time_ms: double, min_exec_time_ms: double, max_exec_time_ms: double, calls: bigint,
        yb_p50_ms: double, yb_p90_ms: double, yb_p95_ms: double, yb_p99_ms: double>,
    pg_stat_statements_over_time string, replication_lag_over_time string,
    replication_summary struct<
        min_lag_ms: double, avg_lag_ms: double, p95_lag_ms: double, max_lag_ms: double, samples: bigint>
"""
STEP = f"struct<{STEP_STRUCT}>"
PHASE = f"struct<{STEP_STRUCT}, steps array<{STEP}>>"

SUMMARY = f"""
    run_dir string, run_label string, run_description string, cluster_type string,
    cluster_topology string, replication_mode string, xcluster_enabled boolean,
    phases array<{PHASE}>, schema map<string, struct<label: string, log: string, exit_code: int, sql_file: string>>
"""

# One line of a stored summary: a step with its phase and run.
SUMMARY_RECORD = f"""
    run string, run_dir string, run_label string, run_description string, cluster_type string,
    cluster_topology string, replication_mode string, xcluster_enabled boolean,
    phase_idx int, phase {STEP}, step_idx int, step {STEP}
"""

# What ``run_listing`` looks at.
LISTING_RECORD = """
    run string, run_label string, phase_idx int, phase struct<type: string, tps: double>, step struct<step: string>
"""

STAT_FIELDS = """
    elapsed_sec int, mean_ms double, min_ms double, max_ms double, calls bigint,
    yb_p50_ms double, yb_p90_ms double, yb_p95_ms double, yb_p99_ms double
"""
LAG_FIELDS = "elapsed_sec int, timestamp bigint, lag_ms double"


def _nested(fields: str) -> str:
    names = ", ".join(": ".join(f.split()) for f in fields.split(","))
    return f"interval_sec int, snapshots array<struct<{names}>>"


STAT_SNAPSHOTS, LAG_SNAPSHOTS = _nested(STAT_FIELDS), _nested(LAG_FIELDS)

# A plan. Numbers that the reader parses leniently arrive as text.
RAMP = """array<struct<duration_sec: int, target_tps: double, total_transactions: bigint,
    transactions_per_client: bigint, clients: int, jobs: int>>"""
PLAN = f"""
    run_label string, run_description string,
    cluster struct<cluster_type: string, cluster_topology: string, replication_mode: string, xcluster_enabled: boolean>,
    db struct<host: string, port: string, user: string, dbname: string, admin_dbname: string>,
    schema struct<create_db: boolean, drop_db: boolean, schema_sql_file: string, preload_sql_file: string>,
    reports struct<csv: boolean, html: boolean>,
    server_metrics struct<tserver_urls: array<string>, pg_stat_statements: boolean,
        pg_stat_statements_interval_sec: string>,
    replication_metrics struct<interval_sec: string>,
    phases array<struct<name: string, type: string, clients: int, jobs: int, script: string,
        mix: array<struct<script: string, weight: int>>, log_transactions: boolean, report_per_script: boolean,
        duration_sec: int, target_tps: double, total_transactions: bigint, transactions_per_client: bigint,
        command: string, args: array<string>, ramp: {RAMP}>>
"""

# The flat report: 37 columns in this order.
REPORT = """
    phase string, operation string, step string, type string, exit_code int, duration_sec int, target_tps double,
    transactions_per_client bigint, total_transactions bigint, clients int, jobs int, tps double,
    tps_excluding double, latency_avg_ms double, latency_stddev_ms double, latency_p50_ms double,
    latency_p90_ms double, latency_p95_ms double, latency_p99_ms double, latency_samples bigint,
    latency_histogram_csv string, pgbench_log_files string, server_metrics string, log string,
    pg_stat_mean_ms double, pg_stat_min_ms double, pg_stat_max_ms double, pg_stat_calls bigint, overhead_ms double,
    yb_p50_ms double, yb_p90_ms double, yb_p95_ms double, yb_p99_ms double, replication_avg_lag_ms double,
    replication_min_lag_ms double, replication_p95_lag_ms double, replication_max_lag_ms double
"""
REPORT_COLUMNS = [field.split()[0] for field in REPORT.split(",")]

# The HTML report shows all but these, and these four in a fixed-width face.
NOT_IN_HTML = ["transactions_per_client", "total_transactions", "clients", "jobs", "replication_min_lag_ms"]
HTML_COLUMNS = [c for c in REPORT_COLUMNS if c not in NOT_IN_HTML]
MONO_COLUMNS = ["latency_histogram_csv", "pgbench_log_files", "server_metrics", "log"]

HISTOGRAM = "epoch_sec bigint, count bigint, avg_ms double, p50_ms double, p95_ms double, p99_ms double"

# Keyed test tables.
TEST_TABLE = "id string not null, ref_id string, payload bigint not null, updated_at timestamp not null"
ACCOUNT = "id string not null, balance bigint not null, updated_at timestamp not null"
ACCOUNT_LOG = "id string not null, account_id string not null, delta bigint not null, created_at timestamp not null"
