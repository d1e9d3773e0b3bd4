import brute_llm as brute
import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from loadlens.llm import text_kernels as kernels
from loadlens.llm.buckets import block_groups, forest, pairs_of_groups, together, whole_groups
from loadlens.llm.graph import connected_components


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aAbBéß\x0b  \n.", max_size=60)), min_size=1, max_size=8))
def test_shingle_sets_follow_the_plain_rule(texts):
    hashes, bounds = kernels.shingle_sets(texts)
    seen = {}
    for i, text in enumerate(texts):
        own = hashes[bounds[i] : bounds[i + 1]]
        want = brute.shingles(text)
        assert len(own) == len(want) and (np.diff(own.astype(object)) > 0).all()
        assert seen.setdefault(frozenset(want), own.tobytes()) == own.tobytes()
    assert len(set(seen.values())) == len(seen)


def test_batches_hold_every_text_once():
    texts = ["a" * 10, None, "b" * 100, "", "c" * 3]
    got = list(kernels.batches(texts, 12))
    assert [i for a, b in got for i in range(a, b)] == list(range(5))
    assert list(kernels.batches([])) == []


def test_pairs_of_groups():
    groups = np.array([1, 1, 1, 5, 7, 7, 7, 7])
    sides = np.array([2, 2, 2, 2, 0, 0, 1, 1])
    for most in (1, 3, 100):
        got = {(int(x), int(y)) for a, b in pairs_of_groups(groups, sides, most) for x, y in zip(a, b, strict=True)}
        assert got == {(0, 1), (0, 2), (1, 2), (4, 6), (4, 7), (5, 6), (5, 7)}


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 12), st.lists(st.tuples(st.integers(0, 11), st.integers(0, 11)), max_size=30))
def test_forest_keeps_components(n, edges):
    edges = [(a % n, b % n) for a, b in edges]
    a, b = forest(np.array([e[0] for e in edges], int), np.array([e[1] for e in edges], int), n)
    assert len(a) < n
    assert brute.components(range(n), zip(a.tolist(), b.tolist(), strict=True)) == brute.components(range(n), edges)


def test_blocks_lose_no_pair(spark):
    rows = spark.createDataFrame([(1, i) for i in range(23)] + [(2, 100), (2, 101), (3, 200)], "key long, node long")
    parts = together(block_groups(rows, "key", "node", 4)).select("group", "side", "node").toPandas()
    met = set()
    for _, part in parts.groupby("group"):
        part = part.sort_values("side")
        assert len(part) <= 23
        for a, b in pairs_of_groups(part["group"].to_numpy(), part["side"].to_numpy()):
            met |= {tuple(sorted(p)) for p in zip(part["node"].to_numpy()[a].tolist(), part["node"].to_numpy()[b].tolist(), strict=True)}
    assert met == {(a, b) for a in range(23) for b in range(a + 1, 23)} | {(100, 101)}


def test_whole_groups_are_not_cut():
    frames = [pd.DataFrame({"group": g}) for g in ([1, 1], [1, 2], [2, 2], [2], [3, 4])]
    out = list(whole_groups(iter(frames), 2))
    groups = [set(f["group"]) for f in out]
    assert sum(map(len, out)) == 9 and all(not a & b for i, a in enumerate(groups) for b in groups[i + 1 :])


def test_connected_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, x) for x in range(2001, 2100)]
    rows = [*links, (5, 5), (None, 7), links[0]]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(rows, "a long, b long")).collect()}
    want = brute.components({x for p in links for x in p}, links)
    alone = {a for a, b in links if a == b and all(a not in p or p == (a, a) for p in links)}
    assert got == {k: v for k, v in want.items() if k not in alone}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hot_key_is_cut_behind_an_aggregation(spark):
    from pyspark.sql import functions as F

    from loadlens.llm.scratch import join_apart

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 120_000, 1, 16).selectExpr("case when id % 3 = 0 then 7 else id % 1000 end as u", "uuid() as pad")
        joined = join_apart(rows, rows.groupBy("u").agg(F.count("*").alias("n")), "u")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert join_apart(rows, rows.groupBy("u").agg(F.count("*").alias("n")), "u").agg({"n": "max"}).first()[0] > 40_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_long_spans_hash_by_content():
    long = ("x" * 700_000 + "y" * 600_000).encode()
    one, two = (kernels.split_words([pad + long + b" tail", b"", long[:-1]]) for pad in (b"", b"lead in  "))
    a, b = one.hashes, two.hashes
    assert len(a) == 3 and len(b) == 5 and (a == b[2:]).all() and a[0] != a[2]
    assert kernels.split_words([b"abc"]).hashes[0] == kernels.split_words([b"q" * 600_000 + b" abc"]).hashes[1]
