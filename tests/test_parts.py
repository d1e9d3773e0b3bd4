"""Documents of any length, read in parts: the same rows as from whole ones."""

import json
import random

import numpy as np
import pytest

from loadlens.operators import reports
from loadlens.plans import catalog  # noqa: F401
from loadlens.plans.registry import QUERIES
from loadlens.session import scratch_path
from loadlens.sinks import files as sinks
from loadlens.sources import documents
from loadlens.sources import files as sources

ODD = ['a"b', "\\", '\\"', "}{][", '"steps": [', "\\\\", "", "é{", 'x", "phases": [{"', None]


def step(rng, n):
    return {"step": f"s{n}", "log": rng.choice(ODD), "tps": rng.random(), "pgbench_log_files": ["/{1", "]"][: rng.randrange(3)],
            "server_metrics": [{"url": "u", "path": rng.choice(ODD)}], "pg_stat_statements": {"calls": n, "mean_exec_time_ms": float("nan") if n % 7 == 0 else 1.5}}


def document(rng, phases, steps):
    """Fields before and behind the lists, lists of that name elsewhere, elements that are null."""
    made = []
    for n in range(phases):
        kind = rng.choice(["pgbench", "pgbench", "http"])
        phase = {"name": f"p{n}", "type": kind, "server_metrics": [{"url": "[", "path": "}"}], "cmd": ["steps"]}
        if rng.random() < 0.8:
            phase["steps"] = [step(rng, i) for i in range(rng.randrange(steps + 1))]
            if rng.random() < 0.3:
                phase["steps"] = [None, *phase["steps"], None, step(rng, 99)]
        made.append(phase | ({"tps": 1.0, "error": rng.choice(ODD)} if n % 2 else {}))
    if rng.random() < 0.4:
        made = [None, *made, None]
    head = {"run_dir": rng.choice(ODD), "run_label": "l", "other": {"phases": [{"name": "no"}]}}
    return head | {"phases": made, "schema": {"create_db": {"label": "x", "exit_code": 0}}}


def cut(text, size, block, rng):
    cutter, out, at, data = documents.Cutter(size), [], 0, text.encode()
    while at < len(data):
        n = rng.randrange(1, block + 1)
        out += cutter.take(np.frombuffer(data[at : at + n], np.uint8))
        at += n
    return [*out, *cutter.finish()]


@pytest.mark.parametrize("seed", range(60))
def test_parts_make_up_the_document(seed):
    rng = random.Random(seed)
    doc = document(rng, rng.randrange(12), rng.choice([0, 3, 60]))
    text = json.dumps(doc, indent=rng.choice([None, 1, "\t"]), separators=rng.choice([None, (",", ":"), (" , ", " : ")]), ensure_ascii=rng.random() < 0.5)
    size = rng.choice([1, 200, 3000, 1 << 20])
    phases, steps, tails = {}, {}, []
    for phase, first, part in cut(text + "\n}", size, rng.choice([1, 7, 500, 100_000]), rng):
        got = json.loads(part)
        assert {k: v for k, v in got.items() if k not in ("phases", "schema")} == {k: doc[k] for k in ("run_dir", "run_label", "other")}
        tails.append(got.get("schema"))
        assert not first or len(got["phases"]) == 1
        for n, one in enumerate(got["phases"], phase):
            for i, s in enumerate((one or {}).get("steps", []), first):
                assert (n, i) not in steps
                steps[n, i] = s
            kept = one and {k: v for k, v in one.items() if k != "steps"}
            assert repr(phases.setdefault(n, kept)) == repr(kept)
    assert [repr(phases[n]) for n in sorted(phases)] == [repr(p and {k: v for k, v in p.items() if k != "steps"}) for p in doc["phases"]] and set(phases) == set(range(len(doc["phases"])))
    assert {k: repr(v) for k, v in steps.items()} == {(n, i): repr(s) for n, p in enumerate(doc["phases"]) for i, s in enumerate((p or {}).get("steps", []))}
    assert tails[-1] == doc["schema"] and not any(tails[:-1])


def test_a_part_is_all_that_is_held():
    rng = random.Random(1)
    doc = document(rng, 5, 20) | {"phases": [{"name": "long", "type": "pgbench", "steps": [step(rng, n) for n in range(3000)], "tps": 2.0}, *document(rng, 400, 3)["phases"]]}
    text, cutter, most, sizes = json.dumps(doc).encode(), documents.Cutter(4000), 0, []
    for at in range(0, len(text), 1000):
        sizes += [len(part) for _, _, part in cutter.take(np.frombuffer(text[at : at + 1000], np.uint8))]
        most = max(most, len(cutter.text))
    assert len(text) > 500_000 and most < 12_000 and max(sizes) < 20_000


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_a_flat_report_of_parts(spark, compression):
    """Files that Spark may cut, files that it may not, broken and empty ones: the rows and places of whole documents."""
    import gzip
    import os

    rng, root = random.Random(5), scratch_path(spark, "parts").removeprefix("file://").removeprefix("file:")
    texts = [json.dumps(document(rng, 8, 30), indent=n % 3) for n in range(6)] + ["", '{"run_label": "cut', "not a document", "{}", '{"phases": null}', "[1]"]
    for n, text in enumerate(texts):
        os.makedirs(f"{root}/set=s/run=r{n}")
        with (gzip.open if compression else open)(f"{root}/set=s/run=r{n}/summary.json{'.gz' if compression else ''}", "wt", encoding="utf-8") as out:
            out.write(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        whole, parts = (reports.flatten_report(sources.scan_summary(spark, root, "summary*", **more)) for more in ({}, {"part_size": 2000}))
        assert whole.columns == parts.columns
        assert sorted(map(repr, whole.collect())) == sorted(map(repr, parts.collect())) and whole.count() > 100
        assert sources.scan_summary(spark, root, "summary*", part_size=2000).groupBy("run").count().where("count > 3").count() >= 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_no_cell_holds_a_run_set(spark, monkeypatch):
    """The query reads its documents in parts, each with a fraction of the phases."""
    seen, read = [], sources.scan_summary
    monkeypatch.setattr(sources, "scan_summary", lambda *a, **k: (seen.append(read(*a, **(k | {"part_size": 5000}) if "part_size" in k else k)), seen[-1])[1])
    path = scratch_path(spark, "sf")
    spark.range(1, 3001, 1, 2).selectExpr("id * 50 as o_orderkey", "id as o_custkey", "'x' as o_orderpriority").write.parquet(f"{path}/orders.parquet")
    spark.range(1, 3001, 1, 2).selectExpr("id * 50 as l_orderkey", "id as l_partkey", "id as l_suppkey", "1 as l_linenumber", "double(id) as l_quantity", "double(id) as l_extendedprice", "'A' as l_returnflag").write.parquet(f"{path}/lineitem.parquet")
    rows = QUERIES["summary_documents"](spark, path)
    assert rows.count() == 3000 + 3000 + 3000 // 7 and {r.runset for r in rows.select("runset").distinct().collect()} == {"set_0"}
    assert max(r[0] for r in seen[0].selectExpr("size(phases)").collect()) < 300


def test_workers_need_no_copy_of_the_library():
    """The code travels with the task, not the name of a module that only the driver may have."""
    from pyspark import cloudpickle

    given = cloudpickle.loads(cloudpickle.dumps(documents.parts))
    assert given is not documents.parts and list(given(iter([]), 10)) == []
