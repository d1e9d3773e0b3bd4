"""The driver's parquet tables in the shape of load-test data."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions import uuid_from_int
from loadlens.operators.reports import join_steps, own_steps
from loadlens.session import scratch_path
from loadlens.sources.schemas import STEP_STRUCT

START = 1704067200


def micros_of(column: str) -> str:
    """Microseconds since 1970 of a timestamp without zone that means UTC, whatever zone the session has."""
    return f"unix_micros(cast(convert_timezone('UTC', current_timezone(), {column}) as timestamp))"


MICROS = micros_of("ts")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


TXN_COLUMNS = [
    "user_id as client_id",
    "event_id as txn_no",
    "cast(round(value * 1000) as bigint) as latency_us",
    "case event_type when 'click' then 0 when 'error' then 1 when 'purchase' then 2 when 'signup' then 3 else 4 end as script_no",
    f"{START} + ({MICROS} div 1000000 - {START}) div 3600 as epoch_sec",
    f"{MICROS} % 1000000 as epoch_us",
    "event_type as operation",
    "concat(event_type, '_step', user_id % 3 + 1) as step",
    "case user_id % 4 when 0 then 'plain' when 1 then 'index' when 2 then 'fk' else 'index_fk' end as variant",
]
LAG_COLUMNS = [
    "variant", "step", f"epoch_sec - {START} as elapsed_sec", "txn_no as seq",
    "case when txn_no % 7 = 0 then null else cast(latency_us as double) / 1000 end as lag_ms",
]
STAT_COLUMNS = [
    "variant", "step", f"epoch_sec - {START} as elapsed_sec", "txn_no as seq",
    "greatest(0, txn_no * 3 + client_id % 5 - case when txn_no % 50 = 0 then 1000 else 0 end) as calls",
    "cast(latency_us as double) / 1000 as mean_ms",
]


def txn(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions: an hour of events becomes a second."""
    return table(spark, sf, "events").selectExpr(*TXN_COLUMNS)


BATCHES = 4


def txn_stream(spark: SparkSession, sf: str, in_order: bool = False, late: bool = False, again: bool = False) -> Iterator[DataFrame]:
    """The transactions as a stream that gets four slices one after the other: yields it each time the next slice is there.

    Drain it with the same checkpoint each time; a slice is one micro-batch then, whatever the number of its files, and is
    written by as many tasks as ``events`` has partitions. The slices go by event number dealt in turn, so that every key
    and every second comes in all of them; unless ``in_order``, the last slice comes first: what follows it is late.
    With ``late``, slices go by time and every fifth event comes a slice late; with ``again``, they go by time and some events
    come twice, in their slice or in the next one.
    """
    in_order = in_order or late or again
    events, path = table(spark, sf, "events"), scratch_path(spark, "event-files")
    slices = list(range(BATCHES)) if in_order else [BATCHES - 1, *range(BATCHES - 1)]
    if in_order:
        cuts = events.agg(F.percentile_approx("ts", [n / BATCHES for n in range(1, BATCHES)]).alias("cuts")).first()["cuts"]
        number = sum(((F.col("ts") > F.lit(cut)).cast("int") for cut in cuts or []), F.lit(0))
    else:
        number = F.pmod("event_id", F.lit(BATCHES))
    number = F.coalesce(number, F.lit(0))  # rows without an event number or a time come in a slice as well
    if late:
        number, slices = number + F.coalesce((F.pmod("event_id", F.lit(5)) == 0).cast("int"), F.lit(0)), [*slices, BATCHES]
    for n in slices:
        part = events.where(number == n)
        if again:
            part = part.unionByName(part.where("event_id % 7 = 0")).unionByName(events.where((number == n - 1) & (F.col("event_id") % 3 == 0)))
        part.write.mode("append").parquet(path)
        yield spark.readStream.schema(events.schema).parquet(path).selectExpr(*TXN_COLUMNS, f"{MICROS} as at_us")


def growing_logs(spark: SparkSession, sf: str, root: str) -> Iterator[int]:
    """Log files that grow in four steps below ``root``; yields each time. Before the last step every file ends within a line,
    and before the third the logs of ``signup`` are begun anew under their names.

    A step writes the whole file again, which a repeated task does alike; the bytes of the step before stay what they were.
    """
    from pyarrow import fs

    lines = txn_line(spark, sf).withColumn("fields", F.split("line", " "))
    number, client = F.col("fields")[1].cast("bigint"), F.col("fields")[0].cast("bigint")
    name = F.concat_ws("/", F.lit(root), "variant", "operation", "step", F.concat(F.lit("pgbench_log."), client % 2))
    lines = lines.select(name.alias("file"), "operation", "line", F.pmod(number, F.lit(BATCHES)).alias("slice"), number.alias("number"))

    def keep(ending: int):
        def run(frames):
            out = now = last = None

            def close():
                out.write(last.encode() + b"\n" if not ending else (last.encode() + b"\n")[:-ending])
                out.close()

            for frame in frames:
                for file, part in frame.groupby("file", sort=False)["line"]:  # rows of a file follow one another
                    if file != now:
                        if out is not None:
                            close()
                        where = file.removeprefix("file:")
                        where = "/" + where.lstrip("/")
                        fs.LocalFileSystem().create_dir(where.rsplit("/", 1)[0], recursive=True)
                        out, now = fs.LocalFileSystem().open_output_stream(where), file
                    else:
                        out.write(last.encode() + b"\n")
                    lines = part.tolist()
                    last = lines.pop()
                    if lines:
                        out.write("\n".join([*lines, ""]).encode())
            if out is not None:
                close()
            yield from ()

        return run

    for step in range(BATCHES):
        rows = lines.where((F.col("slice") <= step) & ~((F.col("operation") == "signup") & (F.col("slice") < 2) & F.lit(step >= 2)))
        placed = rows.repartition("file").sortWithinPartitions("file", "slice", "number").select("file", "line")
        placed.mapInPandas(keep(0 if step == BATCHES - 1 else 5), "file string").count()
        yield step


def txn_line(spark: SparkSession, sf: str) -> DataFrame:
    """The same as log lines, with dirt: words, missing fields, latencies over the limit."""
    return txn(spark, sf).selectExpr(
        "variant", "operation", "step",
        """concat_ws(' ', client_id, txn_no,
          case when txn_no % 97 = 0 then 'skipped' when txn_no % 101 = 0 then '70000000' else cast(latency_us as string) end,
          script_no, epoch_sec, case when txn_no % 103 = 0 then null else epoch_us end,
          case when txn_no % 2 = 0 and txn_no % 103 <> 0 then 15 else null end) as line""",
    )


def lag_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return txn(spark, sf).selectExpr(*LAG_COLUMNS)


def stat_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return txn(spark, sf).selectExpr(*STAT_COLUMNS)


def statements(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as queryid", "concat('run-', o_orderkey) as run", "cast(o_orderkey % 3 as int) as phase_idx",
        "cast(o_orderkey % 7 as int) as step_idx", "o_custkey % 20 as server",
        """case o_orderpriority when '1-URGENT' then 'SELECT payload FROM t3 WHERE id = $1'
          when '2-HIGH' then 'UPDATE t4 SET payload = payload + $1' when '3-MEDIUM' then 'insert into t5 (ref_id) values ($1)'
          when '4-NOT SPECIFIED' then 'select * from pg_stat_statements' else 'SHOW search_path' end as query""",
        "o_orderkey % 50 + 1 as calls", "cast(o_totalprice as decimal(18,2)) as total_time",
        "cast(o_custkey % 9 as double) / 10 as min_time", "cast(o_totalprice as decimal(18,2)) as max_time",
        """case when o_orderkey % 9 = 0 then null else concat('[{"[0.1,0.2)": ', o_orderkey % 7, '}, {"[0.2,0.4)": ',
          o_orderkey % 11, '}, {"[0.4,0.8)": ', o_orderkey % 5, '}, {"[0.8,)": ', o_orderkey % 3, '}]') end
          as yb_latency_histogram""",
    )


def prom_line(spark: SparkSession, sf: str) -> DataFrame:
    return txn(spark, sf).selectExpr(
        "client_id as node", "epoch_sec", "epoch_us",
        """concat(case script_no when 0 then 'async_replication_committed_lag_micros'
          when 1 then 'async_replication_sent_lag_micros' when 2 then 'consumer_safe_time_lag' else 'other_metric' end,
          '{stream="s', txn_no % 5, '"} ', case when script_no = 2 then latency_us div 1000 else latency_us end) as line""",
    )


def request(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed requests in a 60/25/10/5 mix."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as seq", "o_custkey as account_id",
        """case when o_orderkey % 100 < 60 then 'select' when o_orderkey % 100 < 85 then 'update'
          when o_orderkey % 100 < 95 then 'insert' else 'delete' end as op""",
        "o_orderkey * 37 % 101 - 50 as delta", f"{micros_of('o_orderdate')} as req_ts",
    )


def account(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr("c_custkey as id", "cast(round(c_acctbal * 100) as bigint) as balance")


def account_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        uuid_from_int(F.col("o_orderkey")).alias("id"), F.col("o_custkey").alias("account_id"), F.col("o_orderkey").alias("seq")
    )


PHASE_IDX = "case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end"


def line_step(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .groupBy(
            F.col("l_orderkey").alias("k"),
            F.expr(PHASE_IDX).alias("phase_idx"),
            (F.col("l_linenumber") - 1).alias("step_idx"),
        )
        .agg(
            F.max("l_partkey").alias("pk"), F.max("l_suppkey").alias("sk"), F.max("l_quantity").alias("qty"),
            F.max("l_extendedprice").alias("hi"), F.min("l_extendedprice").alias("lo"),
        )
    )


PHASE_NAME = "case phase_idx when 0 then 'select' when 1 then 'insert' else 'update' end"


STEP_ROW = [
    "concat('set_', k % 50) as runset", "concat('run-', k) as run", "phase_idx", "step_idx",
    f"{PHASE_NAME} as phase", f"concat({PHASE_NAME}, '_step', step_idx + 1) as step",
    "cast(qty as int) as clients", "cast(sk % 8 + 1 as int) as jobs", "cast(30 + pk % 4 * 30 as int) as duration_sec",
    "case when pk % 4 = 0 then null else cast((pk % 10 + 1) * 1000 as double) end as target_tps",
    "case when pk % 4 = 0 then pk * 10 + 50 end as total_transactions",
    "case when sk % 11 = 0 then null else hi end as tps", "case when sk % 11 = 0 then null else lo end as tps_excluding",
    "case when step_idx = 5 then null else cast(pk as double) / 8 end as latency_avg_ms",
    "case sk % 4 when 0 then cast(pk as double) / 100000000 when 1 then cast(pk as double) * 10000000000000 when 2 then cast(pk as double) * 1000000 end as latency_stddev_ms",
    "case when step_idx % 3 = 2 then null else cast(sk as double) / 4 end as server_ms",
    "pk * 3 as latency_samples", "cast(pk as double) / 8 as latency_p50_ms", "cast(pk + 8 as double) / 8 as latency_p90_ms",
    "cast(pk + 16 as double) / 8 as latency_p95_ms", "cast(pk + 32 as double) / 8 as latency_p99_ms",
    "case when step_idx % 2 = 0 then cast(sk as double) end as lag_ms", "sk",
]


def step_row(spark: SparkSession, sf: str) -> DataFrame:
    """Step results: an order is a run, its return flags are phases, its line numbers steps."""
    return line_step(spark, sf).selectExpr(*STEP_ROW)


def run_row(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "concat('set_', o_orderkey % 50) as runset", "concat('run-', o_orderkey) as run", "o_orderkey as k", "o_custkey", "o_orderpriority",
    )


def _struct_of(fields: dict[str, str], schema: str) -> F.Column:
    """A struct with every field of ``schema``; those not given are null."""
    names = [(f.name, f.dataType.simpleString()) for f in _parsed(schema)]
    return F.struct(*[F.expr(fields.get(n, "null")).cast(t).alias(n) for n, t in names])


def _parsed(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).fields


STEP_FIELDS = {
    **{c: c for c in (
        "step", "duration_sec", "target_tps", "total_transactions", "clients", "jobs", "tps", "tps_excluding", "latency_stddev_ms",
        "latency_avg_ms", "latency_samples", "latency_p50_ms", "latency_p90_ms", "latency_p95_ms", "latency_p99_ms")},
    "name": "phase", "type": "'pgbench'", "exit_code": "0", "log": """concat('/r/<"', step, '", 1>/pgbench.log')""",
    "latency_histogram_csv": "concat('/r/', step, '/latency_histogram.csv')",
    "pgbench_log_files": "case when step_idx = 6 then array() else array(concat('/r/', step, '/pgbench_log.1'), concat('/r/', step, '/pgbench_log.2')) end",
    "server_metrics": "array(struct('http://a' as url, concat('/r/', step, '/before.txt') as path), struct('http://b' as url, cast(null as string) as path))",
    "pg_stat_statements": """case when server_ms is not null then struct(server_ms as mean_exec_time_ms, server_ms / 2 as min_exec_time_ms,
        server_ms * 2 as max_exec_time_ms, sk as calls, server_ms as yb_p50_ms, server_ms as yb_p90_ms, server_ms as yb_p95_ms,
        cast(null as double) as yb_p99_ms) end""",
    "replication_summary": """case when lag_ms is not null then struct(lag_ms / 4 as min_lag_ms, lag_ms / 2 as avg_lag_ms,
        lag_ms as p95_lag_ms, lag_ms * 2 as max_lag_ms, 3L as samples) end""",
}
RUN_FIELDS = [
    "concat('/runs/', runset, '/', run) as run_dir", "concat('label of ', run) as run_label", "'' as run_description",
    "'stretch' as cluster_type", "'' as cluster_topology", "'none' as replication_mode", "false as xcluster_enabled",
]


RUN_OF = {"runset": "concat('set_', k % 50)", "run": "concat('run-', k)"}
PHASE_FIELDS = {
    "name": f"case phase_idx when 3 then 'api' when 4 then 'other' else {PHASE_NAME} end",
    "type": "case phase_idx when 3 then 'http' when 4 then 'custom' else 'pgbench' end",
    "exit_code": "case when phase_idx = 3 then 0 end",
    "log": "case when phase_idx = 3 then concat('/r/', k, '/api.log') end",
    "error": "case when phase_idx = 4 then 'unknown phase type' end",
    "tps": "figures.tps", "tps_excluding": "figures.tps_excluding",
}


def record_rows(spark: SparkSession, sf: str, throughput: bool = True) -> DataFrame:
    """What the step records are made of: some figures a step, and not yet the document with all its fields."""
    steps = line_step(spark, sf).selectExpr(
        "k", "phase_idx", "step_idx",
        "struct(pk, sk, qty, case when sk % 11 = 0 then null else hi end as tps, case when sk % 11 = 0 then null else lo end as tps_excluding) as step",
    )
    none = "struct(cast(null as double) as tps, cast(null as double) as tps_excluding) as phase"
    stepped = table(spark, sf, "lineitem").selectExpr("l_orderkey as k", f"{PHASE_IDX} as phase_idx").distinct().selectExpr("k", "phase_idx", none)
    # Runs whose key divides by 5 have an HTTP phase, by 7 one of an unknown type.
    alone = run_row(spark, sf).selectExpr(
        "k", "explode(filter(array(case when k % 5 = 0 then 3 end, case when k % 7 = 0 then 4 end), x -> x is not null)) as phase_idx"
    ).selectExpr("k", "phase_idx", none)
    return join_steps(stepped.unionByName(alone), steps, ["k"], throughput).selectExpr(*[f"{x} as {c}" for c, x in RUN_OF.items()], "*")


def record_docs(rows: DataFrame) -> DataFrame:
    """``record_rows`` as step records; row by row, so the order of the rows stays."""
    places = ["runset", "run", "k", "phase_idx", "step_idx", "stepped"]
    made = rows.selectExpr(*places, "phase as figures", "step.pk", "step.sk", "step.qty", "step.tps as hi", "step.tps_excluding as lo")
    derived = [x for x in STEP_ROW if x.rsplit(" as ", 1)[-1] not in (*places, "sk")]
    made = made.selectExpr(*places, "figures", "sk", *derived)
    # Fields are columns first, and the phase's name one that both structs read: so Spark keeps the step that makes them apart, and who reads
    # some fields only takes them from the columns and has the structs and what else they are made of left out.
    parts = {"phase": PHASE_FIELDS, "step": {n: x for n, x in STEP_FIELDS.items() if n != "name"}}
    kinds = {f.name: f.dataType.simpleString() for f in _parsed(STEP_STRUCT)}
    made = made.selectExpr(*places, *[f"cast({x} as {kinds[n]}) as {part}_{n}__" for part, fields in parts.items() for n, x in fields.items()])
    structs = {part: {"name": "phase_name__"} | {n: f"{part}_{n}__" for n in fields} for part, fields in parts.items()}
    docs = made.select(*places, *[_struct_of(fields, STEP_STRUCT).alias(part) for part, fields in structs.items()])
    return own_steps(docs).selectExpr("runset", "run", *RUN_FIELDS, "phase_idx", "phase", "step_idx", "step")


def records(spark: SparkSession, sf: str, throughput: bool = True) -> DataFrame:
    """Step records of the runs, as a stored summary has them (without ``throughput``: but for that of phases with steps)."""
    return record_docs(record_rows(spark, sf, throughput))


def summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Nested run documents: an order is a run with a phase of two steps, some with an HTTP phase and one of unknown type."""
    step = lambda n: f"""named_struct({', '.join(f"'{f.name}', cast({x} as {f.dataType.simpleString()})" for f in _parsed(STEP_STRUCT) for x in [
        {"name": "'select'", "step": f"'select_step{n}'", "type": "'pgbench'", "exit_code": "0", "clients": f"o_custkey % 9 + {n}",
         "tps": f"o_custkey * {n}", "latency_p95_ms": f"o_custkey / 8.0D + {n}",
         "server_metrics": f"array(struct('http://a' as url, concat('/r/', k, '/{n}.txt') as path))",
         "pg_stat_statements": f"case when k % 3 = {n} then named_struct('mean_exec_time_ms', 1.5D, 'min_exec_time_ms', 1D, 'max_exec_time_ms', 2D, 'calls', k, 'yb_p50_ms', 1D, 'yb_p90_ms', 1D, 'yb_p95_ms', 1D, 'yb_p99_ms', 1D) end",
         "replication_summary": f"case when k % 2 = {n - 1} then named_struct('min_lag_ms', 1D, 'avg_lag_ms', 2D, 'p95_lag_ms', 3D, 'max_lag_ms', cast(k as double), 'samples', 1L) end",
         }.get(f.name, "null")])})"""  # fmt: skip  # noqa: E731
    phase = lambda fields, steps: f"""named_struct({', '.join(f"'{f.name}', cast({fields.get(f.name, 'null')} as {f.dataType.simpleString()})" for f in _parsed(STEP_STRUCT))}, 'steps', {steps})"""
    none = f"cast(null as array<struct<{', '.join(f'{f.name}: {f.dataType.simpleString()}' for f in _parsed(STEP_STRUCT))}>>)"
    return run_row(spark, sf).selectExpr(
        "runset", "run", *RUN_FIELDS,
        f"""filter(array({phase({"name": "'select'", "type": "'pgbench'", "tps": "o_custkey * 2"}, f"array({step(1)}, {step(2)})")},
          case when k % 5 = 0 then {phase({"name": "'api'", "type": "'http'", "exit_code": "0"}, none)} end,
          case when k % 7 = 0 then {phase({"name": "'other'", "type": "'custom'"}, none)} end), p -> p is not null) as phases""",
    )


STEP_NAMES = ["click", "error", "purchase", "signup", "view", "idle"]


def steps(spark: SparkSession, sf: str) -> DataFrame:
    """The steps that were planned: those of the log, and idle ones that left no samples."""
    names = ", ".join(f"'{n}'" for n in STEP_NAMES)
    return table(spark, sf, "customer").selectExpr(
        "case c_custkey % 4 when 0 then 'plain' when 1 then 'index' when 2 then 'fk' else 'index_fk' end as variant",
        f"concat(element_at(array({names}), cast(c_custkey div 4 % 6 + 1 as int)), '_step', c_custkey div 24 % 3 + 1) as step",
    ).distinct()


def plans(spark: SparkSession, sf: str) -> DataFrame:
    """Load plans: an order is a plan, its return flags are phases; at most seven ramp steps each."""
    rows = line_step(spark, sf)
    phases = (
        rows.withColumn("kind", F.expr("(k + phase_idx) % 4"))
        .groupBy("k", "phase_idx", "kind")
        .agg(
            (F.max("pk") + 1).alias("phase_pk"),
            F.array_sort(
                F.collect_list(
                    F.expr(
                        """struct(step_idx, struct(case kind when 1 then null else 60 end as duration_sec,
                        case kind when 0 then cast((pk % 10 + 1) * 500 as double) end as target_tps,
                        case kind when 1 then pk * 10 + 7 end as total_transactions, cast(null as bigint) as transactions_per_client,
                        case when sk % 3 = 0 then null else cast(qty as int) end as clients, cast(null as int) as jobs) as s)"""
                    )
                )
            ).alias("ramp"),
        )
    )
    phase = F.expr(
        f"""struct(case when k % 11 <> 0 then {PHASE_NAME} end as name, 'pgbench' as type, case when k % 6 = 0 then null else cast(k % 16 + 1 as int) end as clients,
        cast(null as int) as jobs, concat('scripts/', {PHASE_NAME}, '.sql') as script,
        case when k % 2 = 0 then array(struct('a.sql' as script, cast(phase_pk as int) as weight), struct('' as script, 9 as weight),
          struct('b.sql' as script, cast(null as int) as weight)) end as mix,
        cast(null as int) as duration_sec, cast(null as double) as target_tps, cast(null as bigint) as transactions_per_client,
        case when kind = 3 then phase_pk end as total_transactions,
        case when kind < 3 then transform(ramp, r -> r.s) end as ramp)"""
    )
    return (
        phases.groupBy("k")
        .agg(F.array_sort(F.collect_list(F.struct("phase_idx", phase.alias("phase")))).alias("list"))
        .selectExpr(
            "concat('run-', k) as run_label", "'' as run_description",
            "struct(cast(null as boolean) as csv, cast(null as boolean) as html) as reports",
            """struct(case k % 3 when 0 then 'stretch' when 1 then 'xcluster' end as cluster_type,
              case when k % 4 = 0 then 'active-active' end as replication_mode, cast(null as string) as cluster_topology,
              cast(null as boolean) as xcluster_enabled) as cluster""",
            "struct(case when k % 2 = 0 then true end as create_db, cast(null as boolean) as drop_db, 's.sql' as schema_sql_file, cast(null as string) as preload_sql_file) as schema",
            """struct(case when k % 3 = 0 then 'db.local' end as host, cast(null as string) as user,
              case when k % 13 = 0 then 'bad name!' else concat('db_', k) end as dbname,
              cast(case when k % 17 = 0 then 'port' when k % 4 > 0 then '5444' end as string) as port,
              cast(null as string) as admin_dbname) as db""",
            """struct(array(concat('http://a', k, ', http://b ,')) as tserver_urls, k % 2 = 0 as pg_stat_statements,
              case k % 5 when 0 then '5' when 1 then '-3' when 2 then 'often' end as pg_stat_statements_interval_sec) as server_metrics""",
            "case when k % 2 = 0 then struct('10' as interval_sec) end as replication_metrics",
            "transform(list, x -> x.phase) as phases",
        )
    )
