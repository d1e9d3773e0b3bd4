"""Keyed test tables: generation, batches of keyed requests, key and reference audits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlens.functions import PAYLOAD_FACTORS, account_delta, payload_mod, uuid_from_int
from loadlens.operators.ordered import first_rows, join_apart, rows_after_first
from loadlens.session import scratch_path, store

# Sizes and start balance of the generated tables.
PRELOAD_ROWS = 100_000
ACCOUNT_LOG_ROWS = 200_000
START_BALANCE = 1000

# The mixed workload in percent.
MIX = {"select": 60, "update": 25, "insert": 10, "delete": 5}


def series(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Integers 1..n as column ``g``."""
    return spark.range(1, n + 1, numPartitions=partitions).withColumnRenamed("id", "g")


def preload_table(numbers: DataFrame, tid: int, parent_rows: int = PRELOAD_ROWS, at: Column | None = None) -> DataFrame:
    """Rows of test table t1..t10 from a series ``g``; t1 has no parent. ``at`` is the load time."""
    g = F.col("g")
    parent = uuid_from_int(F.pmod(g - 1, F.lit(parent_rows).cast("bigint")) + 1)
    return numbers.select(
        F.lit(tid).alias("tid"),
        uuid_from_int(g).alias("id"),
        (F.lit(None).cast("string") if tid == 1 else parent).alias("ref_id"),
        payload_mod(g, PAYLOAD_FACTORS[tid - 1]).alias("payload"),
        _load_time(at).alias("updated_at"),
    )


def _load_time(at: Column | None) -> Column:
    """The default of the time columns: the moment of the load, one for all rows."""
    return F.current_timestamp() if at is None else at.cast("timestamp")


def preload_tables(numbers: DataFrame, parent_rows: int = PRELOAD_ROWS, at: Column | None = None) -> DataFrame:
    """All ten tables as one relation with ``tid``: one pass over the series, no shuffle."""
    g = F.col("g")
    tables = F.explode(
        F.array(*[F.struct(F.lit(n).alias("tid"), F.lit(k).alias("factor")) for n, k in enumerate(PAYLOAD_FACTORS, 1)])
    )
    key, parent = uuid_from_int(g), uuid_from_int(F.pmod(g - 1, F.lit(parent_rows).cast("bigint")) + 1)
    return (
        numbers.select(key.alias("id"), parent.alias("parent"), "g", tables.alias("t"))
        .select(
            F.col("t.tid").alias("tid"),
            "id",
            F.when(F.col("t.tid") > 1, F.col("parent")).alias("ref_id"),
            payload_mod(F.col("g"), F.col("t.factor")).alias("payload"),
            _load_time(at).alias("updated_at"),
        )
    )


def write_tables(tables: DataFrame, path: str, part: str = "tid", key: str = "id") -> str:
    """The test tables with one folder per ``part``. Rows are dealt by key first: a task of the series makes all ten tables, and
    without that the writer would sort all its rows at once, however many they are."""
    tables.repartition(part, key).write.partitionBy(part).parquet(path)
    return path


def preload_accounts(numbers: DataFrame, at: Column | None = None) -> DataFrame:
    return numbers.select(
        uuid_from_int(F.col("g")).alias("id"), F.lit(START_BALANCE).cast("bigint").alias("balance"), _load_time(at).alias("updated_at")
    )


def preload_account_log(numbers: DataFrame, accounts: int = PRELOAD_ROWS, at: Column | None = None) -> DataFrame:
    """Log rows; the generated key is repeatable, taken from the row's number."""
    g = F.col("g")
    return numbers.select(
        uuid_from_int(-g).alias("id"),
        uuid_from_int(F.pmod(g - 1, F.lit(accounts).cast("bigint")) + 1).alias("account_id"),
        account_delta(g).alias("delta"),
        _load_time(at).alias("created_at"),
    )


def point_lookups(requests: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per request whose key exists. The table's key is unique, so requests never multiply;
    a hot key only lengthens the request side, which AQE splits."""
    return requests.join(table, list(on), "inner")


def apply_updates(table: DataFrame, updates: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Add every request's ``delta`` to ``value`` and stamp ``updated_at`` with the last request.

    Additions commute, so requests collapse to one row per key before they meet the table.
    Keys that the table lacks change nothing.
    """
    on = list(on)
    per_key = updates.groupBy(*on).agg(F.sum("delta").alias("add__"), F.max("req_ts").alias("at__"))
    columns = {
        value: (F.col(value) + F.coalesce(F.col("add__"), F.lit(0))).alias(value),
        "updated_at": F.coalesce(F.col("at__"), F.col("updated_at")).alias("updated_at"),
    }
    return table.join(per_key, on, "left").select(*[columns.get(c, F.col(c)) for c in table.columns])


def apply_inserts(table: DataFrame, inserts: DataFrame) -> DataFrame:
    """Append; the inserts carry generated ids. Columns that an insert lacks stay null."""
    return table.unionByName(inserts, allowMissingColumns=True)


def new_rows(requests: DataFrame, seq: str = "seq") -> DataFrame:
    """Give insert requests a repeatable id; rows of t1 never have a parent."""
    rows = requests.withColumn("id", uuid_from_int(F.col(seq)))
    if {"tid", "ref_id"} <= set(requests.columns):
        rows = rows.withColumn("ref_id", F.when(F.col("tid") != 1, F.col("ref_id")))
    return rows


def apply_deletes(table: DataFrame, deletes: DataFrame, on: Sequence[str] = ("id",)) -> DataFrame:
    """Delete by key. Repeating it changes nothing; requests collapse to one row per key first."""
    return join_apart(table, deletes.select(*on).distinct(), on, "left_anti")


def rows_of_keys(table: DataFrame, requests: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is asked for, however often. A hot key of the table is cut."""
    return join_apart(table, requests.select(*on).distinct(), on, "left_semi")


def uuid_bucket(column: str) -> Column:
    """65,536 order-preserving cuts of a hashed key."""
    return F.substring(column, 1, 4)


def _requests_per_key(requests: DataFrame, key: str) -> DataFrame:
    return requests.groupBy(key).agg(F.count(F.lit(1)).alias("limit"))


def rows_to_delete(rows: DataFrame, requests: DataFrame, key: str, id_col: str, bucket: Column | None = None) -> DataFrame:
    """Per request one row of its key, lowest id first: m requests pick min(m, rows) rows.

    Ranks are taken per (key, bucket of the id), so a key with a third of all rows spreads out.
    """
    cut = uuid_bucket(id_col) if bucket is None else bucket
    return first_rows(rows.select(key, id_col), [key], id_col, cut, _requests_per_key(requests, key)).select(key, id_col)


def delete_one_per_request(rows: DataFrame, requests: DataFrame, key: str, id_col: str, bucket: Column | None = None) -> DataFrame:
    """The table without those rows, in the same single shuffle of its rows."""
    cut = uuid_bucket(id_col) if bucket is None else bucket
    return rows_after_first(rows, [key], id_col, cut, _requests_per_key(requests, key))


def one_per_key(rows: DataFrame, key: str, id_col: str) -> DataFrame:
    """One row per key: the lowest id (map-side combined, no window)."""
    values = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*values), F.col(id_col)).alias("row")).select(key, "row.*")


def choose_operations(
    requests: DataFrame, seq: str, keys: int = PRELOAD_ROWS, tables: int = 10, seed: int = 42, mix: dict[str, int] | None = None
) -> DataFrame:
    """Weighted operation, uniform key and uniform table per request, from the MD5 of seed and sequence number.

    A hash, not ``rand()``: the choice survives a recomputed partition. ``mix`` maps operations (or scripts) to weights.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(seq)).cast("binary"))

    def draw(n: int, place: int) -> Column:
        return F.pmod(F.conv(F.substring(digest, place, 10), 16, 10).cast("bigint"), F.lit(n).cast("bigint"))

    weights = mix or MIX
    return requests.withColumns(
        {"op": operation_of(draw(sum(weights.values()), 1), weights), "rid": draw(keys, 11) + 1, "tid": (draw(tables, 21) + 1).cast("int")}
    )


def operation_of(point: Column, mix: dict[str, int] | None = None) -> Column:
    """The operation whose cumulative weight covers a point in 0..total-1."""
    edge, chosen = 0, F.lit(None).cast("string")
    for name, weight in (mix or MIX).items():
        low, edge = edge, edge + weight
        chosen = F.when((point >= low) & (point < edge), name).otherwise(chosen)
    return chosen


def mix_shares(requests: DataFrame) -> DataFrame:
    """Requests per operation and their share in percent."""
    counts = requests.groupBy("op").agg(F.count(F.lit(1)).alias("requests"))
    whole = F.sum("requests").over(Window.partitionBy())  # one row per operation
    return counts.select("op", "requests", (F.col("requests") * F.lit(100.0) / whole).alias("percent"))


def route_by_table(table: DataFrame, requests: DataFrame, on: Sequence[str] = ("tid", "id")) -> DataFrame:
    """Updates of all ten tables at once: the table number is part of the key."""
    return apply_updates(table, requests, on, "payload")


def rewrite_touched(spark: SparkSession, path: str, requests: DataFrame, on: Sequence[str] = ("tid", "id"), value: str = "payload", part: str = "tid") -> list:
    """Apply updates to a stored table with one folder per ``part``: only the folders that requests name are read and replaced.

    The new rows are written aside first, so a failed rewrite can be repeated from them or from the start. Returns the parts
    that requests name (one number per table, so a handful).
    """
    named = [r[part] for r in requests.select(part).where(F.col(part).isNotNull()).distinct().collect()]
    if not named:
        return []
    table = spark.read.parquet(path).where(F.col(part).isin(named))
    updated = apply_updates(table, requests, on, value)
    aside = scratch_path(spark, "rewritten")
    updated.write.partitionBy(part).parquet(aside)
    fresh = spark.read.schema(updated.schema).parquet(aside)
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    return sorted(named)


def pk_audit(table: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and null keys."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return (
        table.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where((F.col("rows") > 1) | missing)
    )


def not_null_audit(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column that must not have any, in one pass."""
    counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "nulls")


def fk_orphans(children: DataFrame, parents: DataFrame, ref: str, key: str) -> DataFrame:
    """Child rows whose reference has no parent; null references pass."""
    ids = parents.select(F.col(key).alias(ref))
    return children.where(F.col(ref).isNotNull()).join(ids, ref, "left_anti")


def fk_orphan_counts(children: DataFrame, parents: DataFrame, ref: str, key: str) -> DataFrame:
    """Orphan rows per missing key: references collapse before the join, so no key is hot in it."""
    refs = children.where(F.col(ref).isNotNull()).groupBy(ref).agg(F.count(F.lit(1)).alias("children"))
    return refs.join(parents.select(F.col(key).alias(ref)), ref, "left_anti")


def fk_chain(start: DataFrame, links: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Follow references upwards. Each link is (parent, reference column so far, parent key);
    the parent's columns join in, null where the chain breaks."""
    for parent, ref, key in links:
        up = parent.withColumnRenamed(key, "up__")
        start = start.join(up, F.col(ref) == F.col("up__"), "left").withColumn(
            f"{ref}_found", F.col("up__").isNotNull()
        ).drop("up__")
    return start


def fk_roots(relation: DataFrame, tid: str = "tid", key: str = "id", ref: str = "ref_id", rounds: int = 32) -> DataFrame:
    """(tid, key, root_tid, root_key, depth) of every row of the test tables as one relation: its reference is a key of the table
    numbered one lower. The root is the last row that is found; depth counts the steps to it.

    Pointer doubling: every round replaces a row's pointer by that of the row it points to, so a chain of n tables takes
    log2(n) joins. A row that many refer to lengthens one side only, which adaptive execution cuts. Every round is written,
    so that a lost executor repeats one join. Both sides are the whole relation, so none is ever broadcast: the size that Spark
    estimates knows nothing of an ``explode`` below it and may be a small part of the true one.
    """
    rows = relation.select(F.col(tid).alias("tid"), F.col(key).alias("key"), F.col(ref).alias("ref"))
    parents = rows.select(F.col("tid").alias("up_tid"), F.col("key").alias("up_key"), F.lit(1).alias("found"))
    start = rows.withColumns({"up_tid": F.when(F.col("ref").isNotNull(), F.col("tid") - 1), "up_key": F.col("ref")})
    start = start.join(parents.hint("merge"), ["up_tid", "up_key"], "left").select(
        "tid", "key", F.when(F.col("found") == 1, F.col("up_tid")).otherwise(F.col("tid")).alias("root_tid"),
        F.when(F.col("found") == 1, F.col("up_key")).otherwise(F.col("key")).alias("root_key"), F.coalesce("found", F.lit(0)).cast("bigint").alias("depth"),
    )
    current, before = store(start, "fk-roots"), None
    for _ in range(rounds):
        total = current.agg(F.sum("depth")).first()[0]
        if total == before:
            return current.withColumnsRenamed({"tid": tid, "key": key, "root_key": f"root_{key}"})
        before = total
        above = current.select(
            F.col("tid").alias("root_tid"), F.col("key").alias("root_key"), F.col("root_tid").alias("far_tid"), F.col("root_key").alias("far_key"), F.col("depth").alias("more"),
        )
        step = current.join(above.hint("merge"), ["root_tid", "root_key"])
        current = store(step.select("tid", "key", F.col("far_tid").alias("root_tid"), F.col("far_key").alias("root_key"), (F.col("depth") + F.col("more")).alias("depth")), "fk-roots")
    raise RuntimeError(f"references are not followed to their end after {rounds} rounds")


def apply_ordered(
    table: DataFrame, requests: DataFrame, key: str, value: str, seq: str = "seq", stamp: str = "updated_at", at: str = "req_ts"
) -> DataFrame:
    """A mixed batch in sequence order per key: insert sets ``delta`` as the start value, update adds it, delete removes.

    A key's last insert or delete decides whether it exists; the updates after it add up.
    An insert of a key that exists at that moment is the primary-key clash that the test
    database rejects; here the last insert wins. All columns of ``table`` return: a row
    inserted anew has nulls but for key, value and ``stamp``, the time of its last request.

    Two aggregations, no window: the last reset per key, then the sum of what follows it. Both
    collapse before they shuffle; the join between them has a shuffle of its own, so a hot key is cut.
    """
    reset = F.col("op").isin("insert", "delete")
    timed = at in requests.columns
    changes = requests.where(F.col("op") != "select").withColumn("at__", F.col(at) if timed else F.lit(None))
    last = changes.groupBy(key).agg(F.max_by(F.struct(seq, "op", "delta", "at__"), F.when(reset, F.col(seq))).alias("last__"))
    live = F.col("last__").isNull() | (F.col(seq) > F.col(f"last__.{seq}"))
    updates = join_apart(changes.where("op = 'update'"), last, [key]).where(live)
    after = updates.groupBy(key).agg(F.sum("delta").alias("after__"), F.max("at__").alias("late__"))
    per_key = last.join(after, key, "left")
    known = [c for c in table.columns if c != key]
    joined = table.withColumn("known__", F.lit(True)).join(per_key, key, "full_outer")
    last_op = F.col("last__.op")
    alive = F.when(last_op.isNull(), F.col("known__").isNotNull()).otherwise(last_op == "insert")
    fresh = F.coalesce(last_op == "insert", F.lit(False))
    start = F.when(fresh, F.col("last__.delta")).otherwise(F.col(value))
    stamped = F.coalesce(F.col("late__"), F.when(fresh, F.col("last__.at__")))
    columns = {value: start + F.coalesce(F.col("after__"), F.lit(0))}
    if stamp in known:
        columns[stamp] = F.coalesce(stamped.cast(table.schema[stamp].dataType), F.when(~fresh, F.col(stamp)))
    return joined.where(alive).select(
        *[F.col(key) if c == key else columns.get(c, F.when(~fresh, F.col(c))).alias(c) for c in table.columns]
    )
