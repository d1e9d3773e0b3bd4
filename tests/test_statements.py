import pytest
from pyspark.sql import functions as F

from loadlens.operators import lag, reports, statements

COLUMNS = "queryid bigint, query string, calls bigint, total_time double, min_time double, max_time double, yb_latency_histogram string"
ROWS = [
    (1, "SELECT payload FROM t3 WHERE id = $1", 10, 20.0, 1.0, 4.0, '[{"[1,2)": 10}]'),
    (2, "insert INTO t5 values ($1)", 30, 10.0, 0.1, 9.0, None),
    (3, "select * from pg_stat_statements", 1000, 5000.0, 0.01, 99.0, '[{"[1,2)": 10}]'),
    (4, "SHOW search_path", 500, 50.0, 0.02, 60.0, None),
    (5, "select count(*) FROM tenants", 10, 1.0, 0.5, 2.0, '[{"[4,8)": 3}]'),
]


def _frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, COLUMNS)


def test_summary_of_the_workload(spark):
    row = statements.statement_summary(_frame(spark)).first()
    assert tuple(row) == (round(31.0 / 50, 3), 0.1, 9.0, 50)  # the loose pattern takes 'tenants' too


def test_no_match_gives_one_row_of_zeros(spark):
    idle = _frame(spark).where("queryid in (3, 4)")
    assert [tuple(r) for r in statements.statement_summary(idle).collect()] == [(0.0, 0.0, 0.0, 0)]
    assert [tuple(r) for r in statements.statement_summary_or_all(idle).collect()] == [(0.0, 0.0, 0.0, 0)]
    assert [tuple(r) for r in statements.statement_summary_or_all(idle, when_empty=True).collect()] == [(0.1, 0.02, 60.0, 500)]
    some = _frame(spark)
    assert statements.statement_summary_or_all(some, True).first() == statements.statement_summary(some).first()
    nothing = _frame(spark).where("queryid < 0")
    assert [tuple(r) for r in statements.statement_summary_or_all(nothing, True).collect()] == [(0.0, 0.0, 0.0, 0)]


def test_newer_column_names(spark):
    newer = _frame(spark).withColumnsRenamed({"total_time": "total_exec_time", "min_time": "min_exec_time", "max_time": "max_exec_time"})
    assert statements.statement_summary(newer).first() == statements.statement_summary(_frame(spark)).first()
    assert statements.statement_summary_or_all(newer.drop("query")).first().calls == 1550


def test_dominant_statement_has_a_histogram_and_lowest_id_on_ties(spark):
    assert statements.dominant_statement(_frame(spark)).first().queryid == 1
    assert statements.dominant_statement(_frame(spark).where("queryid = 4")).count() == 0


def test_counter_reset_gives_null(spark):
    series = [("s", 5, 10, 2.0), ("s", 10, 30, 3.0), ("s", 15, 4, 1.0), ("s", 20, 4, 1.0), ("s", 25, 8, 2.0)]
    df = spark.createDataFrame(series, "step string, elapsed_sec int, calls bigint, mean_ms double")
    got = statements.snapshot_delta(df, ["step"], bucket=F.floor(F.col("elapsed_sec") / 10)).orderBy("elapsed_sec").collect()
    assert [(r.interval_calls, r.interval_mean_ms) for r in got] == [(10, 2.0), (20, 3.5), (None, None), (0, None), (4, 3.0)]


def test_lag_summary_drops_nulls_and_takes_the_maximum_of_six(spark):
    data = [("a", float(v)) for v in (1, 2, 3, 4, 5, 600)] + [("a", None), ("empty", None)]
    got = lag.lag_summary(spark.createDataFrame(data, "step string, lag_ms double"), ["step"]).collect()
    assert [tuple(r) for r in got] == [("a", 1.0, 102.5, 600.0, 600.0, 6)]


def test_lag_threshold(spark):
    rows = [("x", 1000, 5.0), ("x", 2000, 5.0), ("x", 5000, 9.0), ("x", 8000, 50.0), ("flat", 1000, 5.0), ("flat", 2000, 4.0)]
    df = spark.createDataFrame(rows, "k string, rate int, lag double")
    got = {r.k: (r.limit_rate, r.last_good_rate) for r in lag.lag_threshold(df, ["k"], "rate", "lag").collect()}
    assert got == {"x": (5000, 2000), "flat": (None, 2000)}
    strict = {r.k: r.limit_rate for r in lag.lag_threshold(df, ["k"], "rate", "lag", factor=2.0).collect()}
    assert strict == {"x": 8000, "flat": None}


def test_first_node_with_a_value_wins(spark):
    rows = [("s", 1, None), ("s", 2, 3.0), ("s", 3, 900.0), ("none", 1, None)]
    df = spark.createDataFrame(rows, "scrape string, node int, lag_ms double")
    assert {r.scrape: r.lag_ms for r in lag.lag_first_available(df, ["scrape"], "node").collect()} == {"s": 3.0, "none": None}


def test_last_step_counts_even_when_null(spark):
    df = spark.createDataFrame([("r", 0, 0, 5.0, 6.0), ("r", 0, 1, None, None)], "run string, phase_idx int, step_idx int, tps double, tps_excluding double")
    assert tuple(reports.phase_last_step(df).first()) == ("r", 0, None, None)


@pytest.mark.parametrize("value, text", [(12.5, "12.5"), (1e7, "10000000.0"), (0.0005, "0.0005"), (None, None), (100.0, "100.0")])
def test_report_numbers(spark, value, text):
    assert spark.createDataFrame([(value,)], "x double").select(reports.number_text(F.col("x"))).first()[0] == text


def test_the_default_bucket_cuts_long_steps_and_hot_seconds(spark, monkeypatch):
    rows = spark.range(5000).selectExpr(
        "'s' as step", "cast(if(id < 1000, 7, (id * 37) % 720) as bigint) as elapsed_sec", "id * 4001 as seq", "id * 3 % 1001 as calls", "1.5D as mean_ms")
    cuts, real = [], statements.with_previous
    monkeypatch.setattr(statements, "with_previous", lambda df, keys, order, bucket, columns: (cuts.append(bucket), real(df, keys, order, bucket, columns))[1])
    order = ["elapsed_sec", "seq"]
    shown = lambda frame: sorted(map(str, frame.collect()))
    got = statements.snapshot_delta(rows, ["step"], order)
    assert shown(got) == shown(statements.snapshot_delta(rows, ["step"], order, bucket=F.lit(0)))
    assert rows.select(cuts[0]).distinct().count() >= 720
    assert rows.where("elapsed_sec = 7 and seq < 4001000").select(cuts[0]).distinct().count() == 4
    # a fraction of a second is cut by time alone
    part = rows.withColumn("elapsed_sec", F.col("elapsed_sec") + F.col("seq") % 4 / 4)
    assert shown(statements.snapshot_delta(part, ["step"], order)) == shown(statements.snapshot_delta(part, ["step"], order, bucket=F.lit(0)))
    assert part.select(cuts[2]).distinct().count() == 12
