import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import brute
from loadlens.operators.latency import latency_percentiles_of
from loadlens.operators.ordered import distribution, first_rows, rows_after_first, value_bucket, with_previous

SHARES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


@pytest.mark.parametrize("per_doubling", [256, 4])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quantiles_of_skewed_groups(spark, per_doubling, seed):
    data = brute.skewed_groups(seed)
    df = spark.createDataFrame(data, "k string, v bigint").repartition(5)
    got = distribution(df, ["k"], "v", interpolated=SHARES, nearest={"near": 0.95}, per_doubling=per_doubling).collect()
    groups = defaultdict(list)
    for k, v in data:
        groups[k].append(v)
    assert {r.k for r in got} == set(groups)
    for r in got:
        values = groups[r.k]
        assert (r.n, r["sum"], r["min"], r["max"]) == (len(values), sum(values), min(values), max(values))
        assert r.near == brute.nearest(values, 0.95)
        for name, p in SHARES.items():
            assert r[name] == pytest.approx(brute.interpolated(values, p), rel=1e-12)
        assert r["min"] <= r.p50 <= r.p90 <= r.p95 <= r.p99 <= r["max"]


@pytest.mark.parametrize("n", [1, 2, 6, 20, 21, 100])
def test_nearest_rank_of_small_groups(spark, n):
    df = spark.createDataFrame([("a", float(v) / 8) for v in range(n)], "k string, v double")
    assert distribution(df, ["k"], "v", nearest={"p": 0.95}).first().p == brute.nearest([v / 8 for v in range(n)], 0.95)


def test_null_groups_negative_values_and_counts(spark):
    df = spark.createDataFrame([(None, -5.0, 3), (None, 2.0, 1), ("a", None, 9), ("b", -1.5, 2)], "k string, v double, n bigint")
    got = {r.k: (r.n, r["sum"], r.p) for r in distribution(df, ["k"], "v", nearest={"p": 0.5}, freq="n").collect()}
    assert got == {None: (4, -13.0, -5.0), "b": (2, -3.0, -1.5)}


def test_buckets_keep_the_order(spark):
    rng = random.Random(5)
    values = sorted([rng.uniform(-1e6, 1e6) for _ in range(2000)] + [0.0, 1.0, 2.0 ** 40, 1e-9])
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).select(value_bucket(F.col("v"))).collect()]
    assert got == sorted(got)


def test_steps_without_samples(spark):
    steps = spark.createDataFrame([("a",), ("b",)], "step string")
    txn = spark.createDataFrame([("a", 1500)], "step string, latency_us bigint")
    got = {r.step: (r.latency_samples, r.latency_p50_ms, r.latency_p99_ms) for r in latency_percentiles_of(steps, txn, ["step"]).collect()}
    assert got == {"a": (1, 1.5, 1.5), "b": (0, None, None)}


def test_previous_row_across_buckets(spark):
    rng = random.Random(7)
    data = [(k, o, rng.randrange(100)) for k in ("hot", "b", None) for o in rng.sample(range(5000), 400 if k == "hot" else 9)]
    df = spark.createDataFrame(data, "k string, o int, v int").repartition(6)
    got = {(r.k, r.o): r.prev_v for r in with_previous(df, ["k"], ["o"], F.floor(F.col("o") / 100), ["v"]).collect()}
    want, last = {}, {}
    for k, o, v in sorted(data, key=lambda r: (str(r[0]), r[1])):
        want[k, o] = last.get(k)
        last[k] = v
    assert got == want


def test_previous_row_of_a_thin_series(spark):
    # one row a second over several stretches, one hot second, gaps of more than a stretch, seconds and groups that are null
    data = [("thin", o, 0) for o in range(-1500, 3000)] + [("hot", 5000, n) for n in range(2500)] + [("hot", o, 0) for o in (0, 9000, 20000)]
    data += [(None, o, 1) for o in (None, 1, 1023, 1024, 1025)] + [("one", 7, 7)]
    df = spark.createDataFrame(data, "k string, o bigint, n bigint").repartition(5).withColumn("v", F.coalesce("o", F.lit(-9)) * 10000 + F.col("n"))
    bucket = F.struct(F.col("o"), F.floor(F.col("n") / 100).alias("part"))
    seen = with_previous(df, ["k"], ["o", "n"], bucket, ["v"])
    got = {(r.k, r.o, r.n): r.prev_v for r in seen.collect()}
    want, last = {}, {}
    for k, o, n in sorted(data, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2])):
        want[k, o, n] = last.get(k)
        last[k] = (-9 if o is None else o) * 10000 + n
    assert got == want and len(data) == len(want)
    # windows see a stretch, a bucket, or one row per stretch
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3 and sum("stretch__" in line for line in windows) == 2 and sum("first__" in line for line in windows) == 1


def test_rank_across_buckets(spark):
    rng = random.Random(8)
    data = [(k, o) for k in ("hot", "b") for o in rng.sample(range(5000), 500 if k == "hot" else 20)]
    df = spark.createDataFrame(data, "k string, o int")
    limits = spark.createDataFrame([("hot", 300), ("b", 999), ("other", 5)], "k string, `limit` bigint")
    got = {(r.k, r.o): r["rank"] for r in first_rows(df, ["k"], "o", F.floor(F.col("o") / 64), limits).collect()}
    rest = rows_after_first(df, ["k"], "o", F.floor(F.col("o") / 64), limits)
    want = {}
    for key, limit in (("hot", 300), ("b", 999)):
        for n, o in enumerate(sorted(o for k, o in data if k == key)[:limit], 1):
            want[key, o] = n
    assert got == want
    assert sorted((r.k, r.o) for r in rest.collect()) == sorted(set(data) - set(want))
