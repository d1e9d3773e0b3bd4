"""The physical plans hold what the operators promise."""

import os
import re

import pytest

from loadlens.operators import keyed
from loadlens.plans import driver_tables as t
from loadlens.plans.registry import ORACLES, QUERIES
from loadlens.plans import catalog  # noqa: F401
from loadlens.session import cluster_settings
from loadlens.sinks import files as sinks
from loadlens.sources import files as sources

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")

# Sinks and streams write before they return; their plans only read files back.
LAZY = [
    "latency_percentiles", "latency_histogram", "per_script_stats", "throughput", "lag_summary", "lag_threshold", "snapshot_delta",
    "statement_summary", "dominant_statement", "flatten_report", "ordered_batch_apply", "delete_one_per_key", "fk_orphans",
    "apply_updates", "apply_deletes", "route_by_table", "preload_tables", "explode_ramp", "schema_decision", "variant_rank",
]


def plan_of(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_no_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["throughput"](spark, SF))
    schema = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "props" not in schema and "value" not in schema


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["fk_orphan_counts"](spark, SF))
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in plan


def test_updates_collapse_before_they_shuffle(spark):
    plan = plan_of(QUERIES["apply_updates"](spark, SF))
    assert plan.count("partial_sum") >= 1


def test_a_hot_request_key_is_split(spark):
    """With the thresholds lowered to test size, AQE cuts the hot partition of the lookup join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        table = spark.range(1000).selectExpr("id", "id * 2 as balance")
        requests = spark.range(0, 200_000, 1, 16).selectExpr("id as seq", "case when id % 3 = 0 then 7 else id % 1000 end as id", "uuid() as pad")
        joined = keyed.point_lookups(requests, table, ["id"])
        assert joined.agg({"balance": "count"}).first()[0] == 200_000
        found = keyed.point_lookups(requests, table, ["id"])
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["report_html_rows", "flatten_report"])
def test_report_rows_run_compiled(spark, name):
    """The JVM compiles no method above 8,000 bytes: the cells of a row, written out in one, were 39,000 and ran interpreted."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = QUERIES[name](spark, SF)
        mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode
        code = df._jdf.queryExecution().explainString(mode.fromString("codegen"))
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
        assert sizes and max(sizes) < 8000
        assert "max_by" not in plan_of(df)  # report rows show no throughput of a phase with steps, so none is looked for
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_registry_is_complete(spark):
    assert len(QUERIES) > 100
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)
    assert t.txn(spark, SF).count() > 0


def test_a_run_filter_skips_other_folders(spark, tmp_path):
    rows = [("s", f"r{i % 4}", "st", f"1 {i} 300 0 1700000000 5") for i in range(40)]
    path = sinks.write_txn_log(spark.createDataFrame(rows, "runset string, run string, step string, line string"), str(tmp_path / "lake"))
    one = sources.scan_txn_log(spark, path).where("run = 'r1'")
    assert one.count() == 10
    assert "(run" in plan_of(one).split("PartitionFilters:")[1].split("\n")[0]
    assert sources.scan_txn_log(spark, path, partitioned=False).exceptAll(sources.scan_txn_log(spark, path, partitioned=True)).count() == 0


def test_cluster_settings_grow_with_the_input():
    small, large = cluster_settings(1 << 30, 400), cluster_settings(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 400
    assert int(large["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)
    assert {x["spark.sql.files.maxPartitionBytes"] for x in (small, large)} == {str(128 << 20)}


@pytest.mark.parametrize("name", ["per_operation", "per_operation_wide", "variant_rank", "schema_decision", "step_x_latency", "step_x_lag_summary", "latency_histogram"])
def test_the_log_is_scanned_once(spark, name):
    """Both passes of the quantiles share one shuffle: one scan of the log, the rest is reuse."""
    df = QUERIES[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [x for x in plan.splitlines() if "Scan parquet" in x and "event" in x]
    distinct = 2 if name == "schema_decision" else 1  # its lag is a second table that the fixture takes from the same file
    assert len(scans) == distinct, plan
    assert "ReusedExchange" in plan or "ReusedQueryStage" in plan or "TableCacheQueryStage" in plan


def test_hot_groups_are_cut(spark):
    """A second, a delete key and a request key with a third of the rows: no window over a whole group."""
    for name in ("latency_histogram", "stream_latency_histogram", "ordered_batch_apply"):
        plan = plan_of(QUERIES[name](spark, SF))
        windows = [x for x in plan.splitlines() if x.startswith("Arguments: ") and "windowspecdefinition" in x]
        assert all("bucket__" in w or "size__" in w for w in windows), windows
    deletes = plan_of(QUERIES["apply_deletes"](spark, SF))
    assert "HashAggregate" in deletes


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    from loadlens.session import drop_scratch, scratch_path, store

    shared = spark.conf.get("spark.checkpoint.dir")
    stored = store(spark.range(3).toDF("x"), "x")
    assert stored.count() == 3 and stored.inputFiles()[0].startswith("file:")

    class Bare:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        scratch_path(Bare, "x")
    monkeypatch.setattr("loadlens.session.scratch_root", lambda _: f"{shared}/only-for-this-test")
    path = scratch_path(spark, "y")
    spark.range(2).write.parquet(path)
    assert os.path.exists(path.removeprefix("file:"))
    drop_scratch(spark)
    assert not os.path.exists(path.removeprefix("file:"))
