"""Queries over keyed tables: generation, request batches, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens import functions as fn
from loadlens.operators import keyed
from loadlens.plans import driver_tables as t
from loadlens.plans.registry import query
from loadlens.session import scratch_path
from loadlens.sources import files as sources

UUID_SQL = "concat(substr({0}, 1, 8), '-', substr({0}, 9, 4), '-', substr({0}, 13, 4), '-', substr({0}, 17, 4), '-', substr({0}, 21, 12))"


def _uuid_sql(number: str) -> str:
    return UUID_SQL.format(f"md5(cast({number} as varchar))")


# Ten tables as large as the customer table.
PRELOAD_SQL = f"""select tid, {_uuid_sql('c_custkey + 1')} as id, case when tid > 1 then {_uuid_sql('c_custkey % 100000 + 1')} end as ref_id,
    (c_custkey + 1) * [13, 17, 19, 23, 29, 31, 37, 41, 43, 47][tid] % 1000000 as payload, 1704067200000000 as loaded_us
    from customer, (select cast(unnest(range(1, 11)) as integer) as tid)"""


def _load_time():
    return F.timestamp_seconds(F.lit(1704067200))


def _loaded(df, column="updated_at"):
    """The load time as microseconds, which both engines print alike."""
    return df.withColumn("loaded_us", F.unix_micros(column)).drop(column)


def _numbers(spark, sf):
    return t.table(spark, sf, "customer").select((F.col("c_custkey") + 1).alias("g"))


@query("uuid_from_int", f"select o_orderkey, {_uuid_sql('o_orderkey')} as id from orders")
def _(spark, sf):
    return t.table(spark, sf, "orders").select("o_orderkey", fn.uuid_from_int(F.col("o_orderkey")).alias("id"))


@query("payload_mod", "select o_orderkey, o_orderkey * 47 % 1000000 as payload, o_orderkey * 37 % 200 - 100 as delta from orders")
def _(spark, sf):
    key = F.col("o_orderkey")
    return t.table(spark, sf, "orders").select(
        "o_orderkey", fn.payload_mod(key, 47).alias("payload"), fn.account_delta(key).alias("delta")
    )


@query("preload_tables", PRELOAD_SQL)
def _(spark, sf):
    return _loaded(keyed.preload_tables(_numbers(spark, sf), at=_load_time()))


@query(
    "preload_accounts",
    f"""select a.id, a.balance, l.delta, l.log_id, l.loaded_us from (select {_uuid_sql('c_custkey + 1')} as id, 1000::bigint as balance from customer) a
        join (select {_uuid_sql('-(o_orderkey + 1)')} as log_id, {_uuid_sql('o_orderkey % 100000 + 1')} as account_id, (o_orderkey + 1) * 37 % 200 - 100 as delta,
          1704067200000000 as loaded_us from orders) l on l.account_id = a.id""",
)
def _(spark, sf):
    accounts = keyed.preload_accounts(_numbers(spark, sf), _load_time()).drop("updated_at")
    log = keyed.preload_account_log(t.table(spark, sf, "orders").select((F.col("o_orderkey") + 1).alias("g")), at=_load_time())
    return accounts.join(_loaded(log, "created_at").withColumnsRenamed({"id": "log_id", "account_id": "id"}), "id")


@query("scan_workload_tables", f"select tid, id, ref_id, payload from ({PRELOAD_SQL})")
def _(spark, sf):
    path = scratch_path(spark, "tables")
    tables = keyed.preload_tables(_numbers(spark, sf), at=_load_time())
    keyed.write_tables(tables, path)
    return sources.scan_keyed_table(spark, path, sources.schemas.TEST_TABLE + ", tid int").select("tid", "id", "ref_id", "payload")


def _accounts(spark, sf):
    return t.account(spark, sf).withColumn("updated_at", F.lit(None).cast("bigint"))


@query("point_lookup_batch", "select seq, id as account_id, balance from request join account on id = account_id where op = 'select'")
def _(spark, sf):
    lookups = t.request(spark, sf).where("op = 'select'").select("seq", "account_id")
    return keyed.point_lookups(lookups, t.account(spark, sf).withColumnRenamed("id", "account_id"), ["account_id"])


@query(
    "apply_updates",
    """select a.id, a.balance + coalesce(u.d, 0) as balance, u.last_at as updated_at from account a left join
       (select account_id, sum(delta)::bigint as d, max(req_ts) as last_at from request where op = 'update' group by 1) u
       on u.account_id = a.id""",
)
def _(spark, sf):
    updates = t.request(spark, sf).where("op = 'update'").withColumnRenamed("account_id", "id")
    return keyed.apply_updates(_accounts(spark, sf), updates, ["id"], "balance")


@query(
    "apply_inserts",
    f"""select id, account_id, seq, cast(null as bigint) as delta from account_log union all
        select {_uuid_sql('seq + 1000000')}, account_id, seq, delta from request where op = 'insert'""",
)
def _(spark, sf):
    asked = t.request(spark, sf).where("op = 'insert'").withColumn("number", F.col("seq") + 1000000)
    rows = keyed.new_rows(asked, "number").select("id", "account_id", "seq", "delta")
    return keyed.apply_inserts(t.account_log(spark, sf), rows)


@query("apply_deletes", "select id, balance from account where id not in (select account_id from request where op = 'delete')")
def _(spark, sf):
    deletes = t.request(spark, sf).where("op = 'delete'").withColumnRenamed("account_id", "id")
    return keyed.apply_deletes(t.account(spark, sf), deletes)


@query(
    "limit_one_per_key",
    "select account_id, id, seq from account_log qualify row_number() over (partition by account_id order by id) = 1",
)
def _(spark, sf):
    return keyed.one_per_key(t.account_log(spark, sf), "account_id", "id")


@query(
    "semi_delete",
    """select id, account_id, seq from account_log where id not in (select min(id) from account_log
       where account_id in (select account_id from request where op = 'delete') group by account_id)""",
)
def _(spark, sf):
    log = t.account_log(spark, sf)
    asked = t.request(spark, sf).where("op = 'delete'").select("account_id")
    chosen = keyed.one_per_key(keyed.rows_of_keys(log, asked, ["account_id"]), "account_id", "id")
    return keyed.apply_deletes(log, chosen)


@query(
    "delete_one_per_key",
    """select id, account_id, seq from (select *, row_number() over (partition by account_id order by id) as n from account_log) l
       left join (select account_id, count(*) as m from request where op <> 'select' group by 1) r using (account_id)
       where n > coalesce(m, 0)""",
)
def _(spark, sf):
    asked = t.request(spark, sf).where("op <> 'select'")
    return keyed.delete_one_per_request(t.account_log(spark, sf), asked, "account_id", "id")


@query("workload_mix", "select op, count(*) as requests, count(*) * 100.0::double / sum(count(*)) over () as percent from request group by op")
def _(spark, sf):
    points = t.table(spark, sf, "orders").select(keyed.operation_of(F.col("o_orderkey") % 100).alias("op"))
    return keyed.mix_shares(points)


def _draw(n: int, place: int) -> str:
    return f"cast(concat('0x', substr(md5(concat('42:', seq)), {place}, 10)) as bigint) % {n}"


@query(
    "choose_operations",
    f"""select seq, case when p < 60 then 'select' when p < 85 then 'update' when p < 95 then 'insert' else 'delete' end as op,
        {_draw(100000, 11)} + 1 as rid, cast({_draw(10, 21)} + 1 as integer) as tid from (select seq, {_draw(100, 1)} as p from request)""",
)
def _(spark, sf):
    return keyed.choose_operations(t.request(spark, sf).select("seq"), "seq")


@query(
    "route_by_table",
    f"""with t as ({PRELOAD_SQL}), u as (select cast(o_orderkey % 10 + 1 as integer) as tid, {_uuid_sql('o_custkey + 1')} as id,
        sum(o_orderkey * 37 % 101 - 50)::bigint as d, max(epoch_us(o_orderdate)) as last_at from orders group by 1, 2)
        select t.tid, t.id, t.payload + coalesce(d, 0) as payload, last_at as updated_at from t left join u using (tid, id)""",
)
def _(spark, sf):
    tables = keyed.preload_tables(_numbers(spark, sf), at=_load_time()).select("tid", "id", "payload", F.lit(None).cast("bigint").alias("updated_at"))
    asked = t.request(spark, sf).select(
        (F.col("seq") % 10 + 1).cast("int").alias("tid"), fn.uuid_from_int(F.col("account_id") + 1).alias("id"), "delta", "req_ts"
    )
    return keyed.route_by_table(tables, asked)


@query(
    "rewrite_touched",
    f"""with t as ({PRELOAD_SQL}), u as (select cast(o_orderkey % 3 * 3 + 1 as integer) as tid, {_uuid_sql('o_custkey + 1')} as id,
        sum(o_orderkey * 37 % 101 - 50)::bigint as d, max(epoch_us(o_orderdate)) as last_at from orders group by 1, 2)
        select t.tid, t.id, t.payload + coalesce(d, 0) as payload, last_at as updated_at from t left join u using (tid, id)""",
)
def _(spark, sf):
    # Requests name the tables 1, 4 and 7: the folders of the others stay as they are.
    path = scratch_path(spark, "tables")
    tables = keyed.preload_tables(_numbers(spark, sf), at=_load_time()).select("tid", "id", "payload", F.lit(None).cast("bigint").alias("updated_at"))
    keyed.write_tables(tables, path)
    asked = t.request(spark, sf).select(
        (F.col("seq") % 3 * 3 + 1).cast("int").alias("tid"), fn.uuid_from_int(F.col("account_id") + 1).alias("id"), "delta", "req_ts"
    )
    keyed.rewrite_touched(spark, path, asked)
    return spark.read.parquet(path).select("tid", "id", "payload", "updated_at")


# Ten tables of the customers, of which every table lacks some: row g of table n refers to row g % 100 + 1 of table n - 1.
CHAIN_SQL = f"""select tid, g, {_uuid_sql('g')} as id, case when tid > 1 then {_uuid_sql('g % 100 + 1')} end as ref_id
    from (select c_custkey + 1 as g from customer), (select cast(unnest(range(1, 11)) as integer) as tid) where (g * 7 + tid) % 11 <> 0"""


@query(
    "fk_roots",
    f"""with recursive c as materialized ({CHAIN_SQL}),
        up as (select tid, id, tid as root_tid, id as root_id, ref_id, 0::bigint as depth from c
          union all select up.tid, up.id, p.tid, p.id, p.ref_id, depth + 1 from up join c p on p.tid = up.root_tid - 1 and p.id = up.ref_id)
        select tid, id, last(root_tid order by depth) as root_tid, last(root_id order by depth) as root_id, max(depth) as depth from up group by tid, id""",
)
def _(spark, sf):
    g = F.col("g")
    rows = _numbers(spark, sf).withColumn("tid", F.explode(F.sequence(F.lit(1), F.lit(10)))).where((g * 7 + F.col("tid")) % 11 != 0)
    parent = F.when(F.col("tid") > 1, fn.uuid_from_int(g % 100 + 1))
    return keyed.fk_roots(rows.select("tid", fn.uuid_from_int(g).alias("id"), parent.alias("ref_id")))


@query("pk_audit", "select l_orderkey, l_linenumber, count(*) as rows from lineitem group by 1, 2 having count(*) > 1")
def _(spark, sf):
    return keyed.pk_audit(t.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "not_null_audit",
    """select 'lag_ms' as column_name, count(*) filter (where lag_ms is null) as nulls from lag_snapshot union all
       select 'seq', count(*) filter (where seq is null) from lag_snapshot""",
)
def _(spark, sf):
    return keyed.not_null_audit(t.lag_snapshot(spark, sf), ["lag_ms", "seq"])


@query("fk_orphans", "select o_orderkey, o_custkey from orders anti join (select c_custkey from customer where c_acctbal >= 0) on o_custkey = c_custkey")
def _(spark, sf):
    parents = t.table(spark, sf, "customer").where("c_acctbal >= 0")
    children = t.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return keyed.fk_orphans(children, parents, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query("fk_orphan_counts", "select o_custkey, count(*) as children from orders anti join (select c_custkey from customer where c_acctbal >= 0) on o_custkey = c_custkey group by 1")
def _(spark, sf):
    parents = t.table(spark, sf, "customer").where("c_acctbal >= 0")
    return keyed.fk_orphan_counts(t.table(spark, sf, "orders"), parents, "o_custkey", "c_custkey")


@query(
    "fk_chain",
    """select l_orderkey, l_linenumber, o_custkey, c_nationkey, n_regionkey, r_name, o_orderkey is not null as l_orderkey_found,
       c_custkey is not null as o_custkey_found, n_nationkey is not null as c_nationkey_found, r_regionkey is not null as n_regionkey_found
       from lineitem left join orders on l_orderkey = o_orderkey
       left join (select * from customer where c_acctbal >= 0) on o_custkey = c_custkey
       left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
)
def _(spark, sf):
    links = [
        (t.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "l_orderkey", "o_orderkey"),
        (t.table(spark, sf, "customer").where("c_acctbal >= 0").select("c_custkey", "c_nationkey"), "o_custkey", "c_custkey"),
        (t.table(spark, sf, "nation").select("n_nationkey", "n_regionkey"), "c_nationkey", "n_nationkey"),
        (t.table(spark, sf, "region"), "n_regionkey", "r_regionkey"),
    ]
    return keyed.fk_chain(t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), links)


@query(
    "ordered_batch_apply",
    """with ch as (select * from request where op <> 'select'),
       r as (select account_id as id, max(seq) filter (where op in ('insert', 'delete')) as rs from ch group by 1),
       f as (select r.id, rs, (select op from ch where seq = rs) as last_op, (select delta from ch where seq = rs) as start from r),
       a as (select f.id, coalesce(sum(delta) filter (where op = 'update' and seq > coalesce(rs, -1)), 0)::bigint as d,
               max(req_ts) filter (where op = 'update' and seq > coalesce(rs, -1)) as late, max(req_ts) filter (where seq = rs) as fresh_at
             from f join ch on account_id = f.id group by 1),
       known as (select c_custkey as id, cast(round(c_acctbal * 100) as bigint) as balance, c_name as owner, cast(null as bigint) as updated_at from customer)
       select coalesce(k.id, f.id) as id, case when last_op = 'insert' then start else balance end + coalesce(d, 0) as balance,
         case when last_op is null then owner end as owner,
         coalesce(late, case when last_op = 'insert' then fresh_at end, case when last_op is null then k.updated_at end) as updated_at
       from known k full outer join f on f.id = k.id left join a on a.id = f.id
       where case when last_op is null then k.id is not null else last_op = 'insert' end""",
)
def _(spark, sf):
    requests = t.request(spark, sf).withColumnRenamed("account_id", "id")
    table = t.table(spark, sf, "customer").selectExpr(
        "c_custkey as id", "cast(round(c_acctbal * 100) as bigint) as balance", "c_name as owner", "cast(null as bigint) as updated_at"
    )
    return keyed.apply_ordered(table, requests, "id", "balance")
