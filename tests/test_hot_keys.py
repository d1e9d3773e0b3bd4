"""Hot keys that meet an aggregation are cut, frames and ranks of cut groups are exact, references are followed."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadlens.operators import keyed
from loadlens.operators.ordered import moving_mean, with_rank
from loadlens.session import scratch_path
from loadlens.streaming import operators as live
from loadlens.streaming.store import read_upserts, upsert

LOW = {
    "spark.sql.shuffle.partitions": "8", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def low(spark):
    old = {k: spark.conf.get(k, None) for k in LOW}
    for k, v in LOW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_that_meet_an_aggregation_are_cut(spark, low):
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    rows = spark.range(0, 300_000, 1, 8).select(hot.alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    asked = spark.range(0, 5000).select(F.col("id").alias("key"))
    for df, n in ((keyed.rows_of_keys(rows, asked, ["key"]), 300_000), (keyed.apply_deletes(rows, asked.where("key <> 7"), ["key"]), None)):
        assert "skew=true" in executed(df)
        assert n is None or df.count() == n
    requests = spark.range(0, 300_000, 1, 8).select(
        hot.alias("id"), F.col("id").alias("seq"), F.when(F.col("id") < 5000, "insert").otherwise("update").alias("op"), F.lit(1).alias("delta"), F.col("id").alias("req_ts")
    )
    table = spark.range(0, 10).select("id", F.lit(0).cast("bigint").alias("balance"))
    applied = keyed.apply_ordered(table, requests, "id", "balance")
    assert "skew=true" in executed(applied)


def test_ranks_and_frames_of_cut_groups(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"k": rng.integers(0, 3, 3000), "t": rng.integers(0, 700, 3000), "v": rng.normal(size=3000)})
    frame["n"] = np.arange(3000)
    frame.loc[rng.random(3000) < 0.2, "v"] = np.nan
    rows = spark.createDataFrame(frame).withColumn("v", F.when(~F.isnan("v"), F.col("v"))).repartition(7)
    want = frame.sort_values(["k", "t", "n"])
    want["rank"] = want.groupby("k").cumcount() + 1
    got = with_rank(rows, ["k"], ["t", "n"], F.floor(F.col("t") / 10)).toPandas().sort_values("n")
    assert got["rank"].tolist() == want.sort_values("n")["rank"].tolist()
    for width, block in ((1, 5), (4, 4), (5, 50), (20, 7), (9, 100_000)):
        want["m"] = want.groupby("k")["v"].transform(lambda s, w=width: s.rolling(w, min_periods=1).mean())
        got = moving_mean(rows, ["k"], ["t", "n"], F.floor(F.col("t") / 10), "v", width, "m", block).toPandas().sort_values("n")
        assert np.allclose(got["m"].astype(float), want.sort_values("n")["m"], equal_nan=True), (width, block)


def test_untouched_folders_keep_their_files(spark):
    import glob

    path = scratch_path(spark, "parts")
    rows = spark.range(40).select((F.col("id") % 4).cast("int").alias("tid"), F.col("id").cast("string").alias("id"), F.col("id").alias("payload"), F.lit(None).cast("bigint").alias("updated_at"))
    rows.write.partitionBy("tid").parquet(path)
    files = lambda n: sorted(glob.glob(f"{path.removeprefix('file://').removeprefix('file:')}/tid={n}/*.parquet"))
    before = {n: files(n) for n in range(4)}
    asked = spark.createDataFrame([(1, "1", 10, 5), (1, "1", 1, 9), (1, "77", 1, 1), (3, "3", 2, 2), (8, "8", 1, 1), (None, "1", 1, 1)], "tid int, id string, delta bigint, req_ts bigint")
    assert keyed.rewrite_touched(spark, path, asked) == [1, 3, 8]
    assert files(0) == before[0] and files(2) == before[2] and files(1) != before[1]
    got = {r["id"]: (r["payload"], r["updated_at"], r["tid"]) for r in spark.read.parquet(path).collect()}
    assert len(got) == 40 and got["1"] == (12, 9, 1) and got["3"] == (5, 2, 3) and got["5"] == (5, None, 1) and got["2"] == (2, None, 2)
    assert keyed.rewrite_touched(spark, path, asked.limit(0)) == []


def test_references_are_followed_to_their_end(spark):
    rng = np.random.default_rng(2)
    rows = [(t, f"{t}-{i}", None if t == 1 or rng.random() < 0.1 else f"{t - 1}-{rng.integers(0, 12)}") for t in range(1, 11) for i in range(9)]
    known = {(t, k): r for t, k, r in rows}

    def follow(t, k):
        depth, root = 0, (t, k)
        while known[root] is not None and (root[0] - 1, known[root]) in known:
            root, depth = (root[0] - 1, known[root]), depth + 1
        return (*root, depth)

    got = {(r["tid"], r["id"]): (r["root_tid"], r["root_id"], r["depth"]) for r in keyed.fk_roots(spark.createDataFrame(rows, "tid int, id string, ref_id string")).collect()}
    assert got == {(t, k): follow(t, k) for t, k, _ in rows} and max(d for *_, d in got.values()) > 4
    assert keyed.fk_roots(spark.createDataFrame([], "tid int, id string, ref_id string")).count() == 0


def test_upserts_rewrite_only_what_they_touch(spark):
    path = scratch_path(spark, "upserts")
    add = lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n"))
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "k string, n bigint")
    seen = lambda: {r["k"]: r["n"] for r in read_upserts(spark, path, "k string, n bigint").collect()}
    assert seen() == {}
    one = upsert(rows(("a", 1), ("b", 2), ("c", 3)), 0, path, ["k"], add, 64)
    assert len(one) == 3 and seen() == {"a": 1, "b": 2, "c": 3}
    assert upsert(rows(("a", 5)), 1, path, ["k"], add, 64) and seen() == {"a": 6, "b": 2, "c": 3}
    upsert(rows(("a", 5)), 1, path, ["k"], add, 64)
    assert seen() == {"a": 6, "b": 2, "c": 3}
    assert upsert(rows(), 2, path, ["k"], add, 64) == []
    for n in range(3, 7):
        upsert(rows(("a", 1), ("d", n)), n, path, ["k"], add, 64)
    upsert(rows(("a", 1), ("d", 6)), 6, path, ["k"], add, 64)
    assert seen() == {"a": 10, "b": 2, "c": 3, "d": 18}


def test_a_repeated_lag_batch_changes_nothing(spark):
    path = scratch_path(spark, "lag")
    batch = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", None), ("z", 5.0)], "step string, lag_ms double")
    for number in (0, 1, 1):
        live.running_lag_update(batch, number, ["step"], path).write.mode("overwrite").parquet(f"{path}/updates/batch_id={number}")
    got = {r["step"]: (r["min_lag_ms"], r["avg_lag_ms"], r["max_lag_ms"], r["samples"]) for r in live.running_lag(spark, path, ["step"]).collect()}
    assert got == {"x": (1.0, 2.0, 3.0, 4), "z": (5.0, 5.0, 5.0, 2)}
    empty = batch.limit(0)
    live.running_lag_update(empty, 2, ["step"], path).write.mode("overwrite").parquet(f"{path}/updates/batch_id=2")
    assert live.running_lag(spark, path, ["step"]).count() == 2
