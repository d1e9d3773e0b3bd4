"""Steps whose rows grow by an explode, or that store wide rows, stay bounded."""

import glob
import re

from pyspark.sql import functions as F

from loadlens.functions import sanitize_nonfinite
from loadlens.operators import keyed, reports
from loadlens.plans import catalog  # noqa: F401
from loadlens.plans import driver_tables
from loadlens.plans.registry import QUERIES
from loadlens.session import scratch_path
from loadlens.sinks import files as sinks
from loadlens.sources import files as sources
from loadlens.sources.schemas import LISTING_RECORD


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_no_relation_of_references_is_broadcast(spark, monkeypatch):
    # The stored numbers are small and the rows made of them are not: Spark's estimate does not count the explode.
    path, plans, store = scratch_path(spark, "numbers"), [], keyed.store
    spark.range(1, 2000).withColumnRenamed("id", "g").write.parquet(path)
    monkeypatch.setattr(keyed, "store", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), store(df, name))[1])
    rows = spark.read.parquet(path).withColumn("tid", F.explode(F.sequence(F.lit(1), F.lit(4)))).selectExpr("tid", "string(g) as id", "case when tid > 1 then string(g % 9 + 1) end as ref_id")
    got = keyed.fk_roots(rows)
    assert got.count() == 4 * 1999 and {r["depth"] for r in got.select("depth").distinct().collect()} == {0, 1, 2, 3}
    assert len(plans) >= 3 and not any("Broadcast" in p for p in plans)


def test_tables_are_not_sorted_by_the_tasks_that_make_them(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables = keyed.preload_tables(spark.range(0, 4000, 1, 1).withColumnRenamed("id", "g"))
        path = keyed.write_tables(tables, scratch_path(spark, "tables"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(len(glob.glob(f"{local(path)}/tid={n}/*.parquet")) > 1 for n in range(1, 11))
    back = spark.read.parquet(path)
    kept = ["tid", "id", "ref_id", "payload"]  # not the time of loading
    assert back.select(kept).exceptAll(tables.select(kept)).count() == 0 and back.count() == 40_000


def test_documents_are_made_after_the_shuffles(spark):
    orders = spark.createDataFrame([(n, n + 1, "1-URGENT") for n in range(1, 40)], "o_orderkey bigint, o_custkey bigint, o_orderpriority string")
    lines = [(k, 7 * k + n, k + n, n + 1, float(n), k / 4 + n, "ANR"[n % 3]) for k in range(1, 40, 2) for n in range(6)] + [(None, 1, 1, 1, 1.0, 1.0, "A"), (3, None, None, 9, None, None, None)]
    items = spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string")
    path = scratch_path(spark, "sf")
    orders.write.parquet(f"{path}/orders.parquet")
    items.write.parquet(f"{path}/lineitem.parquet")
    rows = driver_tables.record_rows(spark, path)
    assert rows.schema["step"].dataType.fieldNames() == ["pk", "sk", "qty", "tps", "tps_excluding"]
    docs = driver_tables.record_docs(spark.createDataFrame(rows.collect(), rows.schema))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    flat = {(r.run, r.phase_idx, r.step_idx): r for r in reports.flatten_records(docs).collect()}
    steps = [k for k in flat if k[1] < 3]
    # A step that was added above, and a phase of no run, which meets no step.
    assert len(steps) == 6 * 20 + 2 and len(flat) - len(steps) == 39 // 5 + 39 // 7 and all(r.type == "pgbench" for k, r in flat.items() if k[1] < 3)
    assert flat[("run-3", 2, 8)].tps is None and flat[("run-5", 3, 0)].operation == "api" and flat[("run-5", 3, 0)].step == "" and flat[("run-7", 4, 0)].type == "custom"
    last = {(r.run, r.phase_idx): r.phase.tps for r in docs.collect()}
    assert last[("run-5", 0)] == flat[("run-5", 0, 3)].tps and last[("run-5", 3)] is None


def _runs(spark):
    return spark.range(60).selectExpr("concat('set_', id % 2) as runset", "concat('run-', id div 6) as run", "cast(id % 6 as int) as phase_idx", "0 as step_idx", "cast(id as int) as n")


def _flat(rows):
    flat = rows.select("runset", "run", "phase_idx", "step_idx", *[F.lit(None).cast("double").alias(c) for c in sources.schemas.REPORT_COLUMNS if c not in ("phase", "tps")], F.concat(F.lit("p,"), "n").alias("phase"), (F.col("n") / 4).alias("tps"))
    return flat


def test_packed_reports_are_made_behind_the_shuffle(spark):
    rows = _runs(spark)
    plain = sinks.write_report_csv(_flat(rows), scratch_path(spark, "report"))
    packed = sinks.write_report_csv(rows, scratch_path(spark, "report"), render=_flat, compression="gzip")
    assert glob.glob(f"{local(packed)}/*/*/report*.csv.gz") and not glob.glob(f"{local(packed)}/*/*/*.csv")
    one, two = (sources.scan_report_csv(spark, path) for path in (plain, packed))
    assert one.count() == two.count() == 60 and one.exceptAll(two).count() == 0
    assert {(r.runset, r.run, r.phase, r.tps) for r in two.collect()} == {(f"set_{n % 2}", f"run-{n // 6}", f"p,{n}", n / 4) for n in range(60)}


def test_packed_summaries_are_read_back(spark):
    docs = lambda rows: rows.select("runset", "run", "phase_idx", "step_idx", F.struct(F.concat(F.lit("p"), "n").alias("name")).alias("phase"), F.struct(F.lit(None).cast("double").alias("tps"), F.lit("s").alias("step")).alias("step"))
    path = sinks.write_summaries(_runs(spark), scratch_path(spark, "summaries"), render=docs, compression="gzip")
    assert glob.glob(f"{local(path)}/*/summary*.json.gz")
    back = sources.scan_summary_records(spark, path).collect()
    assert {(r.runset, r.run, r.phase_idx, r.phase.name, r.step.step, r.step.tps) for r in back} == {(f"set_{n % 2}", f"run-{n // 6}", n % 6, f"p{n}", "s", None) for n in range(60)}
    runs = spark.range(0, 50, 1, 1).selectExpr("concat('/runs/a/r', id) as run_dir", "cast(null as string) as run_label", "array(struct('x' as name)) as phases")
    path = sinks.write_run_documents(runs, scratch_path(spark, "documents"), compression="gzip", rows_per_file=20)
    assert len(glob.glob(f"{local(path)}/summary*.json.gz")) == 3
    back = sources.scan_summary(spark, path, "summary*", one_per_file=False).collect()
    assert {(r.runset, r.run, r.run_label, r.phases[0].name) for r in back} == {("a", f"r{n}", None, "x") for n in range(50)}


def _stored_rows(spark):
    """What sinks get: rows behind a shuffle, of which some have a step and some none."""
    path = scratch_path(spark, "sf")
    spark.range(1, 9).selectExpr("id as o_orderkey", "id + 1 as o_custkey", "'x' as o_orderpriority").write.parquet(f"{path}/orders.parquet")
    lines = spark.range(1, 9).selectExpr("id as l_orderkey", "id as l_partkey", "id as l_suppkey", "cast(id as int) as l_linenumber", "double(id) as l_quantity", "double(id) as l_extendedprice", "'A' as l_returnflag")
    lines.write.parquet(f"{path}/lineitem.parquet")
    return path, driver_tables.record_rows(spark, path, throughput=False)


def test_stored_report_rows_run_compiled(spark):
    """The JVM compiles no method above 8,000 bytes: rows with and without a step were flattened by one of 10,781 that ran interpreted."""
    _, rows = _stored_rows(spark)
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = reports.report_text(reports.flatten_records(driver_tables.record_docs(rows.repartition("runset"))))
        code = text._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
        assert sizes and max(sizes) < 8000
        assert len(text.collect()) == 8 + 1 + 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_report_rows_come_without_the_throughput_of_phases(spark, monkeypatch):
    """The stored report shows none, so none is looked for; phases with and without steps are all there."""
    path, _ = _stored_rows(spark)
    plans, write = [], sinks.write_report_csv
    monkeypatch.setattr(sinks, "write_report_csv", lambda flat, *rest: (plans.append(flat._jdf.queryExecution().optimizedPlan().toString()), write(flat, *rest))[1])
    back = QUERIES["sink_report_csv"](spark, path).collect()
    assert sorted((r.operation, r.step or "") for r in back) == sorted([("select", f"select_step{n}") for n in range(1, 9)] + [("api", ""), ("other", "")])
    assert plans and "max_by" not in plans[0]


def test_a_listing_parses_what_it_looks_at(spark):
    """A line has 120 fields and the listing looks at six; literals that JSON has not are looked for before they are replaced."""
    step = "struct('s' as step, double('NaN') as tps, double('Infinity') as lag_ms, cast(null as string) as log)"
    records = spark.range(6).selectExpr("'a' as runset", "concat('r', id div 3) as run", "'l' as run_label", "cast(id % 3 as int) as phase_idx", "struct('p' as name, if(id % 3 = 0, 'http', 'pgbench') as type, double(id) as tps) as phase", "0 as step_idx", f"{step} as step")
    path = sinks.write_summaries(records, scratch_path(spark, "summaries"), compression="gzip")
    few, whole = (sources.scan_summary_records(spark, path, **more) for more in ({"fields": LISTING_RECORD}, {}))
    assert few.columns == ["runset", "run", "run_label", "phase_idx", "phase", "step"] and few.schema["step"].dataType.fieldNames() == ["step"]
    got = [sorted(map(tuple, reports.run_listing(df).collect())) for df in (few, whole)]
    assert got[0] == got[1] == [("a", "r0", "l", 3, 3, 1, 3.0), ("a", "r1", "l", 3, 3, 1, 12.0)]
    texts = ['{"a": NaN, "b": [-Infinity, Infinity]}', "NaN", "x-Infinity", "plain", "", None, "Nan", "Infinit"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t"), sanitize_nonfinite(F.col("t")).alias("clean")).collect()
    assert [r.clean for r in rows] == ['{"a": null, "b": [null, null]}', "null", "xnull", *texts[3:]]


def test_last_steps_are_found_without_a_sort(spark):
    steps = spark.createDataFrame([("r", 0, 0, 1.0, 2.0), ("r", 0, 2, None, 4.0), ("r", 0, 1, 5.0, 6.0), ("r", 1, None, 7.0, 8.0), (None, 1, 3, 9.0, None)], "run string, phase_idx int, step_idx int, tps double, tps_excluding double")
    last = reports.phase_last_step(steps)
    assert last.columns == ["run", "phase_idx", "tps", "tps_excluding"]
    assert sorted(map(tuple, last.collect()), key=str) == sorted([("r", 0, None, 4.0), ("r", 1, None, None), (None, 1, 9.0, None)], key=str)
    assert "SortAggregate" not in last._jdf.queryExecution().executedPlan().toString()
