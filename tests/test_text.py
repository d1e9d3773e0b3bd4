import json

from pyspark.sql import functions as F

import brute
from loadlens import functions as fn
from loadlens.operators.lag import parse_lag_text
from loadlens.operators.latency import parse_txn_lines
from loadlens.sources.files import parse_metrics_lines

LINES = [
    "1 2 300 0 1700000000 5", "1 2 300 0 1700000000 5 15", "1 2 300 0 1700000000", "1 2 skipped 0 1700000000 5",
    "1 2 0 0 1700000000 5", "1 2 60000000 0 1700000000 5", "1 2 60000001 0 1700000000 5", "1 2 -1 0 1700000000 5",
    "  1\t2 \t300  0 1700000000 5  ", "", "   ", "1 2 3.5 0 1700000000 5", "1 2 300 0 1700000000 5 15 extra",
    "1 2 300 0 1700000000 5 15 16 17", "+1 -2 +300 0 1700000000 5", "1 2 3-0 0 1700000000 5", "1 2 --3 0 1700000000 5",
    "1 2 300 0 1700000000 5 -", "1 2 99999999999999999999 0 1700000000 5", "failed 2 300 0 1700000000 5",
    " ".join(["7"] * 5000), " ".join(["+7"] * 5000),
]


def test_log_lines_are_kept_or_dropped_as_defined(spark):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(LINES)], "i int, line string")
    got = {r.i: (r.latency_us, r.epoch_sec) for r in parse_txn_lines(df).collect()}
    want = {i: brute.keep_line(line) for i, line in enumerate(LINES)}
    assert got == {i: v for i, v in want.items() if v is not None}


def test_optional_lag_field(spark):
    df = spark.createDataFrame([(LINES[0],), (LINES[1],)], "line string")
    assert sorted(r.schedule_lag or 0 for r in parse_txn_lines(df).collect()) == [0, 15]


def test_last_matching_output_line_counts(spark):
    two = "tps = 100.5 (including connections establishing)\ntps = 101.25 (excluding connections establishing)\n"
    script = " - latency average = 9.9 ms\n"
    one = "latency average = 3.5 ms\nlatency stddev = 0.5 ms\n" + script + "tps = 7 (without initial connection time)\n"
    df = spark.createDataFrame([(0, two), (1, one), (2, script), (3, "")], "i int, t string")
    got = df.select("i", *[c.alias(n) for n, c in fn.stdout_figures(F.col("t")).items()]).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [
        (101.25, 101.25, None, None), (7.0, None, 3.5, 0.5), (None, None, None, None), (None, None, None, None),
    ]


def test_lag_is_the_worst_over_families_and_labels(spark):
    text = (
        "# HELP async_replication_committed_lag_micros lag\n"
        'async_replication_committed_lag_micros{stream="a"} 1500 170\n'
        'async_replication_committed_lag_micros{stream="b"} 2.5e3\n'
        "async_replication_sent_lag_micros 900\nconsumer_safe_time_lag 2\nconsumer_safe_time_lag 1e+-e\nother 99999\n"
    )
    df = spark.createDataFrame([(0, text), (1, "other 5"), (2, "consumer_safe_time_lag\n 8")], "i int, line string")
    got = {r.i: r.lag_ms for r in parse_lag_text(df).collect()}
    assert got == {0: 2.5, 1: None, 2: 8.0}


def test_metrics_lines(spark):
    lines = ["# TYPE x gauge", 'x{a="1",b="two"} 3 1700', "y 4.5e2", "z abc", "", "w NaN"]
    rows = parse_metrics_lines(spark.createDataFrame([(x,) for x in lines], "line string")).collect()
    assert [(r.metric, r.labels, r.value) for r in rows[:2]] == [("x", {"a": "1", "b": "two"}, 3.0), ("y", {}, 450.0)]
    assert [r.metric for r in rows] == ["x", "y", "w"]


def test_sanitised_json_parses(spark):
    text = '{"a": -Infinity, "b": Infinity, "c": NaN, "d": "NaN x"}'
    got = spark.createDataFrame([(text,)], "t string").select(fn.sanitize_nonfinite(F.col("t"))).first()[0]
    assert json.loads(got) == {"a": None, "b": None, "c": None, "d": "null x"}


def test_rounding_is_that_of_a_float_formatter(spark):
    values = [2.675, 1.005, 0.125, 1.0005, 0.0625, -0.0015, 1e12 + 0.3, 123456.7895, 5e-324]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = df.select(fn.round_half_even(F.col("x"), 3), fn.fixed_text(F.col("x"), 2)).collect()
    assert [r[0] for r in got] == [round(v, 3) for v in values]
    assert [r[1] for r in got] == [f"{v:.2f}" for v in values]


def test_finite_round_of_text(spark):
    df = spark.createDataFrame([("1.23456",), ("Infinity",), ("-Infinity",), ("NaN",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(fn.finite_round(F.col("v"))).collect()] == [1.235, None, None, None, None, None]


def test_bands_names_and_lists(spark):
    bands = spark.createDataFrame([(99.99,), (100.0,), (500.0,), (500.01,), (None,)], "x double")
    assert [r[0] for r in bands.select(fn.dr_risk(F.col("x"))).collect()] == ["Safe", "Warning", "Warning", "High Risk", None]
    urls = spark.createDataFrame([(["a, b,", " ", "c"],), ([],), (None,)], "u array<string>")
    assert [r[0] for r in urls.select(fn.split_urls(F.col("u"))).collect()] == [["a", "b", "c"], [], None]
    text = spark.createDataFrame([('<a href="x">&</a>',), (None,)], "t string")
    assert [r[0] for r in text.select(fn.html_escape(F.col("t"))).collect()] == ["&lt;a href=&quot;x&quot;&gt;&amp;&lt;/a&gt;", ""]


def test_elapsed_and_splits(spark):
    df = spark.createDataFrame([(2_999_999, 0), (0, 2_999_999), (50_000, 64)], "a bigint, b bigint")
    assert [r[0] for r in df.select(fn.elapsed_seconds(F.col("a"), F.col("b"))).collect()] == [2, -2, 0]
    work = spark.createDataFrame([(50_000, 64), (1, 8), (0, 8)], "t bigint, c int")
    assert [r[0] for r in work.select(fn.split_transactions(F.col("t"), F.col("c"))).collect()] == [782, 1, 1]
    assert spark.range(1).select(fn.client_sizing(F.lit(10_000.0), F.lit(25.0), 1.0)).first()[0] == 250


def test_sql_functions_agree_with_columns(spark):
    fn.register_functions(spark)
    h = '[{"[0.1,0.2)": 4}, {"[0.4,)": 1}, {"[0.2,0.4)": 2}]'
    df = spark.createDataFrame([(h,), ("[]",), (None,), ('[{"[1,2)": 0}]',)], "h string")
    for percent in (50, 57.2, 90, 99):
        rows = df.select(fn.histogram_percentile("h", percent), F.expr(f"get_percentile(h, {percent}D)")).collect()
        assert [r[0] for r in rows] == [r[1] for r in rows]
    assert df.select(fn.histogram_percentile("h", 50)).first()[0] == 0.2
    assert df.select(fn.histogram_percentile("h", 99)).first()[0] == float("inf")
    assert abs(df.select(fn.histogram_percentile("h", 50, True)).first()[0] - 0.1875) < 1e-12
    assert spark.sql("select uuid_from_int(7)").first()[0] == spark.range(7, 8).select(fn.uuid_from_int(F.col("id"))).first()[0]


def test_numbers_print_as_in_the_files(spark):
    from loadlens.operators.reports import number_text

    values = [1e-5, 1.5e-7, 1e16, 1.25e17, -2.5e-10, 1e100, 1e15, 123456789.5, 1e7, 0.0001, 0.00025, 0.001, 0.0, -3.0, 99.5, 1.0, None, -12345678.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(number_text(F.col("v"))).collect()]
    assert got == [None if v is None else repr(v) for v in values]
