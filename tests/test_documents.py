"""Nested documents: one valid JSON text per run or step, and back."""

import glob
import json

import pytest

from loadlens.session import scratch_path
from loadlens.sinks import files as sinks
from loadlens.sources import files as sources
from loadlens.sources.schemas import STEP_STRUCT


def texts(path, pattern):
    return {p: open(p, encoding="utf-8").read() for p in glob.glob(f"{path.removeprefix('file://').removeprefix('file:')}/{pattern}", recursive=True)}


@pytest.fixture(scope="module")
def polls(spark):
    rows = [("r1", "a", 5, i, 1000 + i, float(i) / 4 if i % 3 else None) for i in range(25_000)] + [("r1", "b", 7, 3, 9, 1.5), ("r2", "a", None, 1, 2, 3.0)]
    return spark.createDataFrame(rows, "run string, step string, interval_sec int, elapsed_sec int, timestamp bigint, lag_ms double").repartition(6)


def test_a_series_is_one_valid_document_in_order(spark, polls):
    path = scratch_path(spark, "polls")
    docs = spark.createDataFrame([("r1", "a", 5), ("r1", "b", 7), ("r2", "a", None), ("r3", "none", 5)], "run string, step string, interval_sec int")
    sinks.write_snapshot_documents(polls, path, ["run", "step"], "lag", ["elapsed_sec"], ["elapsed_sec", "timestamp", "lag_ms"], docs)
    found = {tuple(x.split("=")[1] for x in p.split("/")[-3:-1]): json.loads(t) for p, t in texts(path, "**/lag*").items()}
    assert set(found) == {("r1", "a"), ("r1", "b"), ("r2", "a"), ("r3", "none")}
    assert [s["elapsed_sec"] for s in found["r1", "a"]["snapshots"]] == list(range(25_000)) and found["r1", "a"]["interval_sec"] == 5
    assert "lag_ms" not in found["r1", "a"]["snapshots"][0] and found["r1", "a"]["snapshots"][1]["lag_ms"] == 0.25
    assert found["r3", "none"] == {"interval_sec": 5, "snapshots": []} and found["r2", "a"]["interval_sec"] is None
    back = sources.scan_lag_snapshots(spark, path, "lag*").drop("runset")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, polls.select(back.columns).collect()), key=str)


def test_a_series_is_read_by_many_tasks(spark, polls):
    path = scratch_path(spark, "polls")
    sinks.write_snapshot_documents(polls.where("step = 'a' and run = 'r1'"), path, ["run", "step"], "lag", ["elapsed_sec"], ["elapsed_sec", "timestamp", "lag_ms"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        rows = sources.scan_snapshot_arrays(spark, path, "lag*", sources.schemas.LAG_FIELDS)
        assert rows.count() == 25_000 and rows.where("interval_sec = 5").count() == 25_000
        pieces = spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(path)
        assert pieces.rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_documents_of_other_tools_are_read(spark, tmp_path):
    """Indented, with odd spacing, non-finite numbers, an empty and a broken document."""
    for name, text in {
        "a": json.dumps({"interval_sec": 5, "snapshots": [{"elapsed_sec": 0, "timestamp": 1, "lag_ms": 2.5}, {"elapsed_sec": 5, "lag_ms": float("nan")}]}, indent=2),
        "b": '{"snapshots" : [ {"elapsed_sec" : 1 , "lag_ms" : 7} ] , "interval_sec" : 9 }', "c": '{"interval_sec": 5, "snapshots": []}', "d": "not a document", "e": "",
    }.items():
        folder = tmp_path / "set" / "run" / name
        folder.mkdir(parents=True)
        (folder / "replication_lag_over_time.json").write_text(text)
    got = sorted(map(tuple, sources.scan_lag_snapshots(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([("set", "run", "a", 5, 0, 1, 2.5), ("set", "run", "a", 5, 5, None, None), ("set", "run", "b", 9, 1, None, 7.0)], key=str)


def test_a_run_is_one_valid_document(spark):
    from loadlens.plans.driver_tables import _parsed

    fields = [f.name for f in _parsed(STEP_STRUCT)]
    rows = []
    for n in range(2500):
        rows.append(("s", "r1", "label 1", 0, ("select",), n, (f"step {n}", float(n))))
    rows += [("s", "r1", "label 1", 1, ("api",), 0, ("", None)), ("s", "r1", "label 1", 2, ("upd",), 0, ("x", 1.0)), ("s", "r2", None, 0, ("only",), 0, ("", 2.0))]
    flat = spark.createDataFrame(
        [(a, b, c, d, e[0], f, g[0], g[1]) for a, b, c, d, e, f, g in rows], "runset string, run string, run_label string, phase_idx int, name string, step_idx int, step_name string, tps double"
    )
    step = lambda values: "struct(" + ", ".join(f"cast({values.get(f, 'null')} as {k}) as {f}" for f, k in ((f.name, f.dataType.simpleString()) for f in _parsed(STEP_STRUCT))) + ")"
    records = flat.selectExpr("runset", "run", "run_label", "phase_idx", f"{step({'name': 'name', 'type': chr(39) + 'pgbench' + chr(39)})} as phase", "step_idx",
                              f"{step({'step': 'step_name', 'tps': 'tps'})} as step").repartition(5)
    path = scratch_path(spark, "runs")
    sinks.write_summary_documents(records, path)
    found = {p.split("run=")[1].split("/")[0]: json.loads(t) for p, t in texts(path, "**/summary*").items()}
    one, two = found["r1"], found["r2"]
    assert one["run_label"] == "label 1" and [p["name"] for p in one["phases"]] == ["select", "api", "upd"] and "run_label" not in two
    assert [s["step"] for s in one["phases"][0]["steps"]] == [f"step {n}" for n in range(2500)]
    assert "steps" not in one["phases"][1] and one["phases"][2]["steps"] == [{"step": "x", "tps": 1.0}] and two["phases"] == [{"name": "only", "type": "pgbench"}]
    back = {r["run"]: r for r in sources.scan_summary(spark, path, "summary*").collect()}
    assert len(back["r1"]["phases"][0]["steps"]) == 2500 and back["r2"]["runset"] == "s" and len(fields) > 20
