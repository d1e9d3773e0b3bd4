"""Load plans: defaults, ramp steps with labels and modes, sizing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions import (
    DEFAULT_DB,
    DEFAULT_JOBS,
    DEFAULT_LAG_INTERVAL_SEC,
    DEFAULT_PHASE,
    client_sizing,
    clients_resolved,
    is_db_name,
    parse_interval,
    split_transactions,
    split_urls,
    step_label,
    step_mode,
)


def normalize_plans(plans: DataFrame, default_user: str | None = None) -> DataFrame:
    """Defaults applied; ``error`` names the first rule that a plan breaks (null when it is fine).

    The default user is that of the database server's installation, so it is a parameter.
    """
    kind = F.coalesce("cluster.cluster_type", F.lit("stretch"))
    replicated = (kind == "xcluster") | F.coalesce("cluster.xcluster_enabled", F.lit(False))
    lag_interval = F.coalesce("replication_metrics.interval_sec", F.lit(str(DEFAULT_LAG_INTERVAL_SEC)))
    fixed_work_with_ramp = F.exists(
        "phases",
        lambda p: (F.size(F.coalesce(p["ramp"], F.array())) > 0)
        & ((F.coalesce(p["total_transactions"], F.lit(0)) > 0) | (F.coalesce(p["transactions_per_client"], F.lit(0)) > 0)),
    )
    admin = F.coalesce("db.admin_dbname", F.lit(DEFAULT_DB["admin_dbname"]))
    placeholder = r"^\$\{.*\}$"
    return plans.withColumns(
        {
            "run_label": F.coalesce("run_label", F.lit("")),
            "run_description": F.coalesce("run_description", F.lit("")),
            "cluster": F.struct(
                kind.alias("cluster_type"),
                F.coalesce("cluster.cluster_topology", F.lit("")).alias("cluster_topology"),
                F.coalesce(
                    "cluster.replication_mode",
                    F.when(kind == "stretch", "none").otherwise("active-passive"),
                ).alias("replication_mode"),
                replicated.alias("xcluster_enabled"),
            ),
            "db": F.struct(
                F.coalesce("db.host", F.lit(DEFAULT_DB["host"])).alias("host"),
                F.coalesce("db.port", F.lit(DEFAULT_DB["port"])).alias("port"),
                F.coalesce("db.user", F.lit(default_user)).alias("user"),
                F.col("db.dbname").alias("dbname"),
                admin.alias("admin_dbname"),
            ),
            "schema": F.struct(
                F.coalesce("schema.create_db", F.lit(False)).alias("create_db"),
                F.coalesce("schema.drop_db", F.lit(False)).alias("drop_db"),
                F.col("schema.schema_sql_file").alias("schema_sql_file"),
                F.col("schema.preload_sql_file").alias("preload_sql_file"),
            ),
            "reports": F.struct(
                F.coalesce("reports.csv", F.lit(True)).alias("csv"),
                F.coalesce("reports.html", F.lit(True)).alias("html"),
            ),
            "server_metrics": F.struct(
                F.coalesce(split_urls(F.col("server_metrics.tserver_urls")), F.array().cast("array<string>")).alias(
                    "tserver_urls"
                ),
                F.coalesce("server_metrics.pg_stat_statements", F.lit(False)).alias("pg_stat_statements"),
                parse_interval(F.col("server_metrics.pg_stat_statements_interval_sec")).alias(
                    "pg_stat_statements_interval_sec"
                ),
            ),
            "replication_metrics": F.struct(
                F.when(replicated, parse_interval(lag_interval)).otherwise(F.lit(0)).alias("interval_sec")
            ),
            "error": F.when(F.coalesce("db.dbname", F.lit("")) == "", "db.dbname is required")
            .when(~(is_db_name(F.col("db.dbname")) | F.col("db.dbname").rlike(placeholder)), "invalid dbname")
            .when(~(is_db_name(admin) | admin.rlike(placeholder)), "invalid admin_dbname")
            .when(F.col("db.port").isNotNull() & F.col("db.port").try_cast("int").isNull()
                  & ~F.col("db.port").rlike(placeholder), "db.port must be an integer")
            .when(F.coalesce(fixed_work_with_ramp, F.lit(False)), "ramp excludes fixed work on the phase"),
        }
    )


def explode_phases(plans: DataFrame, keys: Sequence[str]) -> DataFrame:
    return plans.select(*keys, F.posexplode("phases").alias("phase_idx", "phase"))


def plan_steps(plans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per planned step: position, label, mode, work, clients and jobs.

    A phase with fixed work is one step; a ramp gives one step per entry; anything else is
    one timed step. Step values win over those of the phase, those over the defaults.
    """
    p = F.col("phase")
    empty = F.lit(None).cast(
        "struct<duration_sec:int,target_tps:double,total_transactions:bigint,"
        "transactions_per_client:bigint,clients:int,jobs:int>"
    )
    ramp = F.when(F.size(F.coalesce(p["ramp"], F.array())) > 0, p["ramp"])
    rows = (
        explode_phases(plans, keys)
        .where(p["type"] == "pgbench")
        .withColumn("ramped", ramp.isNotNull())
        .select(*keys, "phase_idx", "phase", "ramped", F.posexplode(F.coalesce(ramp, F.array(empty))).alias("step_idx", "s"))
    )
    s, ramped = F.col("s"), F.col("ramped")
    name = F.coalesce(p["name"], F.lit(DEFAULT_PHASE))
    target = F.coalesce(s["target_tps"], p["target_tps"])
    total = F.when(ramped, s["total_transactions"]).otherwise(p["total_transactions"])
    per_client = F.when(ramped, s["transactions_per_client"]).otherwise(p["transactions_per_client"])
    clients = F.when(ramped, clients_resolved(s["clients"], p["clients"])).otherwise(p["clients"])
    jobs = F.when(ramped, clients_resolved(s["jobs"], p["jobs"], DEFAULT_JOBS)).otherwise(p["jobs"])
    # Fixed work on a phase divides by its own client count, one if it names none.
    dividers = F.when(ramped, clients).otherwise(F.coalesce(p["clients"], F.lit(1)))
    split = F.coalesce(F.when(per_client > 0, per_client), F.when(total > 0, split_transactions(total, dividers)))
    mode = step_mode(total, per_client, target)
    label = (
        F.when(ramped, step_label(name, F.col("step_idx") + 1, total, per_client, target, clients))
        .when(split.isNotNull(), F.concat(name, F.lit("_"), split.cast("string"), F.lit("tpc")))
        .otherwise(name)
    )
    fixed = split.isNotNull()
    return rows.select(
        *keys,
        "phase_idx",
        "step_idx",
        name.alias("phase"),
        label.alias("step"),
        mode.alias("mode"),
        F.when(ramped, s["duration_sec"]).when(~fixed, F.coalesce(p["duration_sec"], F.lit(60))).alias("duration_sec"),
        target.alias("target_tps"),
        split.alias("transactions_per_client"),
        F.when(total > 0, total).alias("total_transactions"),
        clients.alias("clients"),
        jobs.alias("jobs"),
    )


def size_clients(steps: DataFrame, latency: str = "latency_avg_ms", headroom: float = 2.0) -> DataFrame:
    """Clients that each step's rate needs at its latency, and whether it has them."""
    return steps.withColumn(
        "clients_needed", client_sizing(F.col("target_tps"), F.col(latency), headroom)
    ).withColumn("enough", F.col("clients") >= F.col("clients_needed"))
