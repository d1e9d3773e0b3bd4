import csv
import html
import json
import re

import pytest
from pyspark.sql import functions as F

from loadlens import functions as fn
from loadlens.operators import latency, reports
from loadlens.plans import loadplan
from loadlens.sinks import files as sinks
from loadlens.sources import files as sources
from loadlens.sources.schemas import HTML_COLUMNS, REPORT_COLUMNS, STEP_STRUCT

SUMMARY = {
    "run_dir": "runs/a/20240101-000000", "run_label": "plain", "cluster_type": "xcluster", "xcluster_enabled": True,
    "phases": [
        {
            "name": "select", "type": "pgbench", "tps": 9.5,
            "steps": [
                {"name": "select", "step": "select_100tps", "type": "pgbench", "exit_code": 0, "clients": 8, "tps": 99.5,
                 "latency_avg_ms": 5.0, "pgbench_log_files": ["/x/pgbench_log.1", "/x/pgbench_log.2"],
                 "server_metrics": [{"url": "u", "path": "/m"}, {"url": "v"}],
                 "pg_stat_statements": {"mean_exec_time_ms": 1.25, "calls": 7, "yb_p99_ms": float("inf")},
                 "replication_summary": {"min_lag_ms": 1.0, "avg_lag_ms": 2.0, "p95_lag_ms": 3.0, "max_lag_ms": 4.0, "samples": 5}},
                {"name": "select", "step": "select_200tps", "type": "pgbench", "exit_code": 1, "tps": None},
            ],
        },
        {"name": "api", "type": "http", "exit_code": 3, "cmd": ["jmeter"], "log": "/x/api.log"},
        {"name": "odd", "type": "magic", "error": "unknown phase type"},
        {"name": "none", "type": "pgbench", "steps": []},
    ],
}


def _tree(tmp_path):
    step = tmp_path / "a" / "20240101-000000" / "select_100tps"
    step.mkdir(parents=True)
    (step / "pgbench_log.17").write_text("1 2 300 0 1700000000 5\n1 2 skipped 0 1700000000 5\n")
    (step / "pgbench_log.17.1").write_text("3 4 500 1 1700000001 5 15\n")
    (step / "pgbench.log").write_text("tps = 10.5 (including connections establishing)\nlatency average = 2.5 ms\n1 2 300 0 1700000000 5\n")
    (step / "select_100tps_before_metrics_1_20240101-000000.txt").write_text('# HELP x\nx{a="b"} 4\n')
    (step / "select_100tps_after_metrics_2_20240101-000009.txt").write_text("x 5\n")
    (step / "pg_stat_statements_over_time.json").write_text(json.dumps({"interval_sec": 5, "snapshots": [
        {"elapsed_sec": 0, "mean_ms": 1.5, "calls": 3, "yb_p99_ms": float("-inf")}, {"elapsed_sec": 5, "mean_ms": 2.5, "calls": 9}]}, indent=2))
    (step / "replication_lag_over_time.json").write_text(json.dumps({"interval_sec": 5, "snapshots": [{"elapsed_sec": 0, "timestamp": 17, "lag_ms": None}]}))
    (step.parent / "summary.json").write_text(json.dumps(SUMMARY, indent=2))
    broken = tmp_path / "a" / "20240102-000000"
    broken.mkdir()
    (broken / "summary.json").write_text('{"run_label": "cut')
    return str(tmp_path)


def test_readers_on_a_run_folder(spark, tmp_path):
    root = _tree(tmp_path)
    where = ("a", "20240101-000000", "select_100tps")
    log = sources.scan_txn_log(spark, root).orderBy("latency_us").collect()
    assert [(r.runset, r.run, r.step, r.latency_us, r.schedule_lag) for r in log] == [(*where, 300, None), (*where, 500, 15)]
    assert tuple(sources.scan_step_stdout(spark, root).first()) == (*where, 10.5, None, 2.5, None)
    stats = sources.scan_stat_snapshots(spark, root).orderBy("elapsed_sec").collect()
    assert [(r.interval_sec, r.elapsed_sec, r.calls, r.yb_p99_ms) for r in stats] == [(5, 0, 3, None), (5, 5, 9, None)]
    assert tuple(sources.scan_lag_snapshots(spark, root).first()) == (*where, 5, 0, 17, None)
    metrics = sources.scan_metrics_text(spark, root).orderBy("node").collect()
    assert [(r.step, r.capture, r.node, r.labels, r.value) for r in metrics] == [
        ("select_100tps", "select_100tps_before", 1, {"a": "b"}, 4.0), ("select_100tps", "select_100tps_after", 2, {}, 5.0)]


def test_summary_flattens_to_the_report(spark, tmp_path):
    docs = sources.scan_summary(spark, _tree(tmp_path))
    labels = {r.run: r.run_label for r in reports.runs_with_labels(docs.select("runset", "run"), docs).collect()}
    assert labels == {"20240101-000000": "plain", "20240102-000000": ""}
    flat = reports.flatten_report(docs)
    assert flat.columns[4:] == REPORT_COLUMNS and len(REPORT_COLUMNS) == 37 and len(HTML_COLUMNS) == 32
    rows = {(r.phase, r.step): r for r in flat.collect()}
    assert set(rows) == {("select", "select_100tps"), ("select", "select_200tps"), ("api", ""), ("odd", "")}
    first = rows["select", "select_100tps"]
    assert (first.overhead_ms, first.pg_stat_calls, first.yb_p99_ms, first.replication_p95_lag_ms) == (3.75, 7, None, 3.0)
    assert (first.pgbench_log_files, first.server_metrics) == ("/x/pgbench_log.1;/x/pgbench_log.2", "/m")
    assert (rows["api", ""].exit_code, rows["api", ""].log, rows["api", ""].server_metrics) == (3, "/x/api.log", "")
    html = [r.html for r in reports.report_html_rows(flat).collect()]
    assert all(h.count("<td") == 32 and h.count('class="mono"') == 4 for h in html)


def test_cells_of_a_row(spark):
    """Numbers at the bounds of the engine's own text, cells with and without markup, null and empty ones."""
    numbers = [0.001, 0.0009999999999999998, 9999999.999999998, 1e7, -1e7, 0.0, -0.0, 1.5e-300, 1e15, 1e16, 0.0001, 9.999999e-5, 1.5, None]
    texts = ["a&b", '<"x">', "plain", "", None, "&lt;", ">>"]
    rows = [(f"s{i}", n, texts[i % len(texts)], [] if i == 2 else None if i == 3 else ["", None, "/m", "/n"]) for i, n in enumerate(numbers)]
    given = spark.createDataFrame(rows, "step string, tps double, log string, paths array<string>")
    flat = given.select(*[
        F.col(c) if c in ("step", "tps", "log")
        else fn.join_metric_paths(F.transform("paths", lambda p: F.struct(p.alias("path")))).alias(c) if c == "server_metrics"
        else F.lit(None).cast("string").alias(c)
        for c in REPORT_COLUMNS
    ])
    cells = {r.step: re.findall(r"<td[^>]*>(.*?)</td>", r.html) for r in reports.report_html_rows(flat, ["step"]).collect()}
    at = HTML_COLUMNS.index
    for step, number, text, paths in rows:
        row = cells[step]
        assert len(row) == 32 and row[at("step")] == step
        assert row[at("tps")] == ("" if number is None else repr(number))
        assert row[at("log")] == html.escape(text or "", quote=True)
        assert row[at("server_metrics")] == ("/m;/n" if paths else "")


def test_report_rows_need_no_throughput_of_phases(spark):
    """Steps that repeat, a phase that repeats, phases without steps and keys that are null: the same report rows either way."""
    kind = f"struct<{STEP_STRUCT}>"
    doc = lambda **f: json.dumps(f)
    steps = [("s", "r", 0, 0, doc(step="a", tps=1.5)), ("s", "r", 0, 1, doc(step="b", tps=2.5)), ("s", "r", 0, 1, doc(step="b", tps=2.5)),
             ("s", "q", 1, 0, doc(step="c")), ("s", None, 0, 0, doc(step="n")), ("s", "r", 9, 0, doc(step="lost"))]
    phases = [("s", "r", 0, doc(name="p", type="pgbench")), ("s", "q", 1, doc(name="p", type="pgbench")), ("s", "q", 1, doc(name="p2", type="pgbench")),
              ("s", "r", 1, doc(name="api", type="http", tps=7.0)), ("s", None, 0, doc(name="n", type="pgbench"))]
    steps = spark.createDataFrame(steps, "runset string, run string, phase_idx int, step_idx int, j string").withColumn("step", F.from_json("j", kind)).drop("j")
    phases = spark.createDataFrame(phases, "runset string, run string, phase_idx int, j string").withColumn("phase", F.from_json("j", kind)).drop("j")
    both = [
        sorted(map(repr, reports.flatten_records(reports.own_steps(reports.join_steps(phases, steps, throughput=t))).select("run", "phase", "step", "tps").collect()))
        for t in (True, False)
    ]
    assert both[0] == both[1] and len(both[0]) == 7


def test_report_csv_round_trip(spark, tmp_path):
    flat = reports.flatten_report(sources.scan_summary(spark, _tree(tmp_path)))
    path = sinks.write_report_csv(flat, str(tmp_path / "out"))
    back = sources.scan_report_csv(spark, path)
    assert back.columns == ["runset", "run", *REPORT_COLUMNS]
    assert {(r.run, r.phase, r.step, r.tps) for r in back.collect()} == {
        ("20240101-000000", "select", "select_100tps", 99.5), ("20240101-000000", "select", "select_200tps", None),
        ("20240101-000000", "api", None, None), ("20240101-000000", "odd", None, None)}


@pytest.mark.parametrize("n", [3, 2500])
def test_records_are_alike_at_every_size(spark, tmp_path, n):
    step = "struct('p' as name, concat('st', id) as step, 'pgbench' as type, double(id) as tps, double(id) as tps_excluding)"
    steps = spark.range(n).selectExpr("'s' as runset", "'r' as run", "0 as phase_idx", "cast(id as int) as step_idx", f"{step} as step")
    phase = "struct('p' as name, '' as step, {} as type, double(0) as tps, double(0) as tps_excluding) as phase"
    phases = spark.sql("select 's' as runset, 'r' as run, 0 as phase_idx, " + phase.format("'pgbench'") + " union all select 's', 'r', 1, " + phase.format("'http'"))
    records = reports.step_records(phases, steps).withColumn("run_label", F.lit("l"))
    path = sinks.write_summaries(records, str(tmp_path / "out"))
    back = sources.scan_summary_records(spark, path)
    rows = back.orderBy("phase_idx", "step_idx").collect()
    assert [(r.run, r.phase_idx, r.step_idx, r.step.step) for r in rows] == [("r", 0, i, f"st{i}") for i in range(n)] + [("r", 1, 0, "")]
    assert {r.phase.tps for r in rows if r.phase_idx == 0} == {n - 1}
    assert [tuple(r) for r in reports.run_listing(back).collect()] == [("s", "r", "l", 2, n, 1, n - 1.0)]
    lines = [json.loads(line) for f in sorted((tmp_path / "out" / "runset=s").glob("summary*")) for line in f.read_text().splitlines()]
    assert [(x["phase_idx"], x["step_idx"]) for x in lines] == [(0, i) for i in range(n)] + [(1, 0)]


def test_many_polls_come_back_in_order(spark, tmp_path):
    polls = spark.range(25_000).selectExpr("'a' as runset", "'r' as run", "'s' as step", "5 as interval_sec", "id as seq",
                                           "cast(id div 3 as int) as elapsed_sec", "id as timestamp", "double(id) as lag_ms")
    path = sinks.write_snapshots(polls.repartition(7), str(tmp_path / "o"), ["runset", "run", "step"], "replication_lag_over_time", ["elapsed_sec", "seq"])
    files = sorted((tmp_path / "o" / "runset=a" / "run=r" / "step=s").glob("replication*"))
    assert [json.loads(line)["seq"] for f in files for line in f.read_text().splitlines()] == list(range(25_000))
    assert sources.scan_lag_snapshots(spark, path, "replication*", one_per_file=False).agg({"lag_ms": "sum"}).first()[0] == sum(range(25_000))


def test_quoted_cells_of_a_report(spark, tmp_path):
    """A file as a standard csv writer leaves it, and our own, with quotes, commas and line breaks in cells."""
    folder = tmp_path / "in" / "a" / "r1"
    folder.mkdir(parents=True)
    row = dict.fromkeys(REPORT_COLUMNS, "") | {"phase": 'say "hi", ok', "step": "s1", "exit_code": "3", "log": 'a\nb "c"'}
    with open(folder / "report.csv", "w", newline="") as out:
        writer = csv.DictWriter(out, REPORT_COLUMNS)
        writer.writeheader()
        writer.writerow(row)
    flat = sources.scan_report_csv(spark, str(tmp_path / "in"), multi_line=True)
    got = flat.first()
    assert (got.phase, got.step, got.exit_code, got.log) == ('say "hi", ok', "s1", 3, 'a\nb "c"')
    path = sinks.write_report_csv(flat, str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("*/*/report*.csv")
    with open(file, newline="") as lines:
        (again,) = csv.DictReader(lines)
    assert again == row and sources.scan_report_csv(spark, path, multi_line=True).first() == got


def test_sinks_write_few_files(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 16).selectExpr("concat('s', id % 60) as runset", "'r' as run", "'st' as step", "concat('1 ', id, ' 300 0 1700000000 5') as line")
    path = sinks.write_txn_log(rows, str(tmp_path / "lake"))
    files = list((tmp_path / "lake").glob("*/*/*/pgbench_log*"))
    assert len(files) <= 60 + 8
    assert sources.is_partitioned(spark, path) and sources.scan_txn_log(spark, path).count() == 4000


def test_defaults_of_plans_and_scripts(spark, tmp_path):
    plan = {"run_label": "p", "db": {"dbname": "d"}, "phases": [
        {"type": "pgbench", "ramp": [{"target_tps": 5}, {"duration_sec": 3}], "mix": [{"script": "a", "weight": 60}, {"weight": 5}, {"script": "b"}]},
        {"type": "pgbench", "name": "one", "script": "c"}, {"type": "pgbench", "total_transactions": 9, "clients": 2}, {"type": "http", "name": "h"}]}
    (tmp_path / "p.json").write_text(json.dumps(plan))
    plans = sources.scan_load_plan(spark, str(tmp_path))
    row = loadplan.normalize_plans(plans, default_user="u").first()
    assert (row.db.host, row.db.port, row.db.user, row.db.admin_dbname, row.schema.create_db, row.error) == ("127.0.0.1", "5433", "u", "postgres", False, None)
    steps = loadplan.plan_steps(plans, ["run_label"]).orderBy("phase_idx", "step_idx").collect()
    assert [(r.phase, r.step) for r in steps] == [("pgbench", "pgbench_5tps"), ("pgbench", "pgbench_capacity_step2"), ("one", "one"), ("pgbench", "pgbench_5tpc")]
    scripts = latency.script_weights(plans, ["run_label"]).orderBy("phase_idx", "script_no").collect()
    assert [(r.phase_idx, r.phase, r.script_no, r.script, r.weight, round(r.share, 4)) for r in scripts] == [
        (0, "pgbench", 0, "a", 60, round(60 / 61, 4)), (0, "pgbench", 1, "b", 1, round(1 / 61, 4)), (1, "one", 0, "c", 1, 1.0)]
    log = spark.createDataFrame([("pgbench", 0, 1000), ("pgbench", 0, 3000), ("pgbench", 7, 5)], "phase string, script_no int, latency_us bigint")
    weights = latency.script_weights(plans, ["run_label"]).where("phase_idx = 0")
    named = latency.with_script_names(latency.per_script_stats(log, ["phase"]), weights, ["phase"]).collect()
    assert sorted((r.script_no, r.script, r.latency_samples, r.latency_avg_ms) for r in named) == [(0, "a", 2, 2.0), (7, None, 1, 0.005)]


def test_nested_documents_on_lines_know_their_run(spark, tmp_path):
    doc = dict(SUMMARY, run_dir="runs/a/20240101-000000/")
    (tmp_path / "summaries.json").write_text("\n".join(json.dumps(d) for d in (doc, dict(doc, run_dir="/x/b/20240102-000000"))))
    docs = sources.scan_summary(spark, str(tmp_path), "summaries.json", one_per_file=False)
    assert sorted((r.runset, r.run) for r in docs.collect()) == [("a", "20240101-000000"), ("b", "20240102-000000")]


def test_histogram_file_is_ordered_text(spark, tmp_path):
    rows = [("a", "r", "s", 3, 2, 1.0005, 2.0, 2.5, None), ("a", "r", "s", 1, 1, 0.0625, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "runset string, run string, step string, epoch_sec bigint, count bigint, avg_ms double, p50_ms double, p95_ms double, p99_ms double")
    path = sinks.write_latency_histogram(df, str(tmp_path / "h"), ["runset", "run", "step"])
    parts = sorted((tmp_path / "h" / "runset=a" / "run=r" / "step=s").glob("latency_histogram*.csv"))
    lines = [line for part in parts for line in part.read_text().splitlines()[1:]]
    assert lines == ["1,1,0.062,1.000,1.000,1.000", "3,2,1.000,2.000,2.500,"]
    assert sources.scan_latency_histogram(spark, path).where("epoch_sec = 3").first().p99_ms is None


def test_plan_files(spark, tmp_path):
    plan = {
        "run_label": "p", "db": {"dbname": "${DB}", "port": "${PORT}"}, "cluster": {"cluster_type": "xcluster"},
        "server_metrics": {"tserver_urls": ["http://a, http://b", ""], "pg_stat_statements": True, "pg_stat_statements_interval_sec": 5},
        "phases": [
            {"name": "mix", "type": "pgbench", "clients": 16, "mix": [{"script": "s.sql", "weight": 60}],
             "ramp": [{"duration_sec": 60, "target_tps": 500}, {"duration_sec": 60, "target_tps": 800, "clients": 64, "jobs": 4},
                      {"total_transactions": 50000, "clients": 64}, {"transactions_per_client": 10}, {"duration_sec": 20}]},
            {"name": "fixed", "type": "pgbench", "script": "x", "clients": 8, "total_transactions": 1001},
            {"name": "timed", "type": "pgbench", "script": "x"},
            {"name": "api", "type": "http", "command": "jmeter", "args": ["-n"]},
        ],
    }
    bad = {"run_label": "bad", "db": {"dbname": "x y"}, "phases": []}
    clash = {"run_label": "clash", "db": {"dbname": "x"}, "phases": [{"name": "p", "type": "pgbench", "total_transactions": 5, "ramp": [{"duration_sec": 1}]}]}
    for name, doc in (("a", plan), ("b", bad), ("c", clash)):
        (tmp_path / "tps").mkdir(exist_ok=True)
        (tmp_path / "tps" / f"{name}.json").write_text(json.dumps(doc, indent=2))
    plans = sources.scan_load_plan(spark, str(tmp_path))
    good = {r.run_label: r for r in loadplan.normalize_plans(plans).collect()}
    assert {k: r.error for k, r in good.items()} == {"p": None, "bad": "invalid dbname", "clash": "ramp excludes fixed work on the phase"}
    assert good["p"].cluster.replication_mode == "active-passive" and good["p"].cluster.xcluster_enabled
    assert good["p"].server_metrics.tserver_urls == ["http://a", "http://b"]
    assert (good["p"].server_metrics.pg_stat_statements_interval_sec, good["p"].replication_metrics.interval_sec) == (5, 5)
    assert (good["bad"].cluster.cluster_type, good["bad"].cluster.replication_mode, good["bad"].replication_metrics.interval_sec) == ("stretch", "none", 0)
    steps = loadplan.plan_steps(plans.where("run_label = 'p'"), ["run_label"]).orderBy("phase_idx", "step_idx").collect()
    assert [(r.step, r.mode, r.duration_sec, r.transactions_per_client, r.clients, r.jobs) for r in steps] == [
        ("mix_500tps", "tps", 60, None, 16, 2), ("mix_800tps", "tps", 60, None, 64, 4),
        ("mix_50000tx", "transaction_count", None, 782, 64, 2), ("mix_160tx", "transaction_count", None, 10, 16, 2),
        ("mix_capacity_step5", "capacity", 20, None, 16, 2), ("fixed_126tpc", "transaction_count", None, 126, 8, None),
        ("timed", "capacity", 60, None, None, None)]


def test_run_listings(spark):
    runs = spark.createDataFrame([("s1", "20240101-000000"), ("s1", "20240102-000000"), ("empty", None)], "runset string, run string")
    assert [tuple(r) for r in reports.run_set_counts(runs).collect()] == [("s1", 2)]
    assert {r.runset: r.latest for r in reports.latest_run(runs).collect()}["s1"] == "20240102-000000"
    assert reports.sorted_runs(runs).select(F.col("run")).collect()[-1][0] == "20240102-000000"
