import random
from collections import Counter

import brute
from pyspark.sql import functions as F

from loadlens.operators import keyed


def _requests(rng, n, keys):
    ops = ["select", "update", "update", "insert", "delete"]
    return [(s, "hot" if rng.random() < 0.4 else f"k{rng.randrange(keys)}", rng.choice(ops), rng.randrange(-50, 50)) for s in range(n)]


def test_ordered_batch_equals_one_request_at_a_time(spark):
    rng = random.Random(11)
    for _ in range(3):
        requests = _requests(rng, 300, 30)
        balances = {f"k{i}": i * 10 for i in range(20)} | {"hot": 5}
        table = spark.createDataFrame(list(balances.items()), "id string, balance bigint")
        batch = spark.createDataFrame(requests, "seq bigint, id string, op string, delta bigint").repartition(4)
        got = {r.id: r.balance for r in keyed.apply_ordered(table, batch, "id", "balance").collect()}
        assert got == brute.run_batch(balances, requests)


def test_ordered_batch_keeps_and_stamps_columns(spark):
    table = spark.createDataFrame([("a", 1, "x", 5), ("b", 2, "y", 5), ("c", 3, "z", 5)], "id string, balance bigint, owner string, updated_at bigint")
    batch = spark.createDataFrame(
        [(1, "a", "update", 10, 100), (2, "b", "delete", 0, 110), (3, "b", "insert", 7, 120), (4, "b", "update", 1, 130), (5, "d", "insert", 4, 140), (6, "c", "select", 0, 150)],
        "seq bigint, id string, op string, delta bigint, req_ts bigint",
    )
    got = keyed.apply_ordered(table, batch, "id", "balance")
    assert got.columns == table.columns
    assert sorted(map(tuple, got.collect())) == [("a", 11, "x", 100), ("b", 8, None, 130), ("c", 3, "z", 5), ("d", 4, None, 140)]


def test_mix_of_scripts(spark):
    rows = keyed.choose_operations(spark.range(4000).toDF("seq"), "seq", mix={"a": 3, "b": 1}).collect()
    share = sum(r.op == "a" for r in rows) / 4000
    assert {r.op for r in rows} == {"a", "b"} and abs(share - 0.75) < 0.03 and {r.tid for r in rows} == set(range(1, 11))


def test_updates_in_two_batches_equal_one(spark):
    table = spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], "id string, balance bigint, updated_at bigint")
    batch = spark.createDataFrame([("a", 5, 10), ("a", -2, 30), ("x", 9, 20), ("b", 1, 5)], "id string, delta bigint, req_ts bigint")
    once = keyed.apply_updates(table, batch, ["id"], "balance")
    first = keyed.apply_updates(table, batch.where("req_ts < 20"), ["id"], "balance")
    twice = keyed.apply_updates(first, batch.where("req_ts >= 20"), ["id"], "balance")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("a", 4, 30), ("b", 3, 5)]


def test_delete_one_row_per_request(spark):
    rng = random.Random(3)
    rows = [(f"{rng.randrange(16 ** 6):06x}-{i}", "hot" if i % 2 else f"a{i % 7}") for i in range(400)]
    requests = ["hot"] * 150 + ["a2"] * 3 + ["a4"] * 999 + ["none"] * 5
    left = keyed.delete_one_per_request(
        spark.createDataFrame(rows, "id string, acc string"), spark.createDataFrame([(r,) for r in requests], "acc string"), "acc", "id"
    )
    want, asked = [], Counter(requests)
    for i, acc in sorted(rows):
        if asked[acc] > 0:
            asked[acc] -= 1
        else:
            want.append((i, acc))
    assert sorted(map(tuple, left.collect())) == want


def test_deletes_are_idempotent_and_empty_the_lookup(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    gone = spark.createDataFrame([("a",), ("a",), ("z",)], "id string")
    once = keyed.apply_deletes(table, gone)
    assert [tuple(r) for r in keyed.apply_deletes(once, gone).collect()] == [("b", 2)]
    assert keyed.point_lookups(gone, once, ["id"]).count() == 0


def test_inserts_of_the_first_table_have_no_parent(spark):
    asked = spark.createDataFrame([(1, 1, "p", 5), (2, 3, "p", 6)], "seq bigint, tid int, ref_id string, payload bigint")
    assert [r.ref_id for r in keyed.new_rows(asked).orderBy("seq").collect()] == [None, "p"]


def test_preload_shape_and_references(spark):
    at = F.timestamp_seconds(F.lit(1704067200))
    tables = keyed.preload_tables(keyed.series(spark, 50), parent_rows=20, at=at).cache()
    assert tables.count() == 500
    assert tables.where("tid = 1 and ref_id is not null").count() == 0
    one = keyed.preload_table(keyed.series(spark, 50), 4, parent_rows=20, at=at)
    assert keyed.preload_table(keyed.series(spark, 2), 1).where("updated_at is null").count() == 0
    assert one.exceptAll(tables.where("tid = 4")).count() == 0
    parents = tables.where("tid = 3")
    assert keyed.fk_orphans(tables.where("tid = 4"), parents, "ref_id", "id").count() == 0
    missing = parents.where(F.col("id") != parents.orderBy("payload").first().id)
    assert keyed.fk_orphans(tables.where("tid = 4"), missing, "ref_id", "id").count() > 0


def test_choice_is_repeatable_and_near_its_weights(spark):
    seqs = spark.range(20_000).withColumnRenamed("id", "seq")
    one, two = keyed.choose_operations(seqs, "seq"), keyed.choose_operations(seqs.repartition(7), "seq")
    assert one.exceptAll(two).count() == 0
    shares = {r.op: r.percent for r in keyed.mix_shares(one).collect()}
    assert all(abs(shares[op] - weight) < 1.5 for op, weight in keyed.MIX.items())
    span = one.agg(F.min("rid"), F.max("rid"), F.min("tid"), F.max("tid")).first()
    assert span[0] >= 1 and span[1] <= 100_000 and span[2:] == (1, 10)


def test_audits(spark):
    t = spark.createDataFrame([("a", 1), ("a", 2), (None, None), ("b", 3)], "id string, v int")
    assert sorted((r.id or "", r["rows"]) for r in keyed.pk_audit(t, ["id"]).collect()) == [("", 1), ("a", 2)]
    assert {r.column_name: r.nulls for r in keyed.not_null_audit(t, ["id", "v"]).collect()} == {"id": 1, "v": 1}


def test_rows_to_delete_are_the_lowest_ids(spark):
    rows = spark.createDataFrame([(f"{i:04x}", "a" if i % 2 else "b") for i in range(20)], "id string, acc string")
    asked = spark.createDataFrame([("a",), ("a",), ("b",)], "acc string")
    assert sorted(map(tuple, keyed.rows_to_delete(rows, asked, "acc", "id").collect())) == [("a", "0001"), ("a", "0003"), ("b", "0000")]
