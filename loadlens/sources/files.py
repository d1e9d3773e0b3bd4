"""Readers for the files a load test leaves behind: <root>/<run set>/<run>/<step>/...

Every reader takes a folder (searched recursively) and finds its files by name. Directory
levels may be plain names or ``key=value``, the way a partitioned Spark write names them.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions import sanitize_nonfinite, stdout_figures
from loadlens.operators.latency import parse_txn_lines
from loadlens.operators.ordered import join_apart
from loadlens.operators.statements import with_time_columns
from loadlens.sources import documents, schemas

cloudpickle.register_pickle_by_value(documents)  # a reader works where the workers have no copy of this library


def _reader(spark: SparkSession, files: str):
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", files)


def _level(above: int, path: Column | None = None) -> Column:
    """Name of the directory ``above`` levels over the file (1 = its own directory)."""
    parts = F.split(F.col("_metadata.file_path") if path is None else path, "/")
    return F.regexp_replace(F.try_element_at(parts, F.lit(-1 - above)), "^[A-Za-z_]+=", "")


def step_levels(path: Column | None = None) -> list[Column]:
    return [_level(above, path).alias(name) for above, name in ((3, "runset"), (2, "run"), (1, "step"))]


def is_partitioned(spark: SparkSession, root: str) -> bool:
    """Whether the folders right below ``root`` are named ``key=value`` (one listing of one level)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):  # a pattern, or not there: the reader says so itself
        return False
    below = fs.listStatus(folder)
    return any(f.isDirectory() and "=" in f.getPath().getName() for f in below)


def scan_txn_lines(spark: SparkSession, root: str, partitioned: bool | None = None) -> DataFrame:
    """Raw lines of all transaction logs (not the step output, whose name only resembles them).

    In a lake of ``runset=/run=/step=`` folders (found by itself) the names are partition columns,
    so a filter on a run or step skips the other folders and no path is taken apart row by row.
    """
    if partitioned is None:
        partitioned = is_partitioned(spark, root)
    if not partitioned:
        return _reader(spark, "pgbench_log*").text(root).select(*step_levels(), F.col("value").alias("line"))
    lake = spark.read.option("pathGlobFilter", "pgbench_log*").schema("value string, runset string, run string, step string")
    return lake.text(root).select("runset", "run", "step", F.col("value").alias("line"))


def scan_txn_log(spark: SparkSession, root: str, partitioned: bool | None = None) -> DataFrame:
    return parse_txn_lines(scan_txn_lines(spark, root, partitioned))


def scan_step_stdout(spark: SparkSession, root: str, files: str = "pgbench.log") -> DataFrame:
    """Throughput and latency figures that the tool printed at the end of each step."""
    texts = _reader(spark, files).text(root, wholetext=True)
    figures = [c.alias(name) for name, c in stdout_figures(F.col("value")).items()]
    return texts.select(*step_levels(), *figures)


def _documents(
    spark: SparkSession, root: str, files: str, schema: str, levels: list[Column], one_per_file: bool
) -> DataFrame:
    """JSON documents, sanitised first. One that does not parse gives nulls, it does not fail the job."""
    texts = _reader(spark, files).text(root, wholetext=one_per_file)
    return texts.select(
        *levels, F.from_json(sanitize_nonfinite(F.col("value")), schema, {"mode": "PERMISSIVE"}).alias("doc")
    )


def _document_parts(spark: SparkSession, root: str, files: str, size: int) -> DataFrame:
    """(file, first_phase, first_step, value): the documents cut as ``documents`` tells. Files are read up to closing braces, so no cell
    holds a document."""
    texts = _reader(spark, files).option("lineSep", "}").text(root)
    factory = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    splits = spark._jvm.java.lang.Class.forName("org.apache.hadoop.io.compress.SplittableCompressionCodec")
    kinds = {name.rsplit("/", 1)[-1].rsplit(".", 1)[-1] for name in texts.inputFiles()}
    codecs = [factory.getCodec(spark._jvm.org.apache.hadoop.fs.Path(f"x.{kind}")) for kind in kinds]
    pieces = texts.select(F.col("_metadata.file_path").alias("file"), F.concat("value", F.lit("}")).alias("value"), F.col("_metadata.file_block_start").alias("block"))
    if any(codec is None or splits.isInstance(codec) for codec in codecs):  # files that Spark may cut: their texts meet again, in order
        pieces = pieces.withColumn("row", F.monotonically_increasing_id()).repartition("file").sortWithinPartitions("file", "block", "row")
    run = documents.parts
    return pieces.select("file", "value").mapInArrow(lambda batches: run(batches, size), documents.OUT)


def scan_summary(spark: SparkSession, root: str, files: str = "summary.json", one_per_file: bool = True, part_size: int | None = None) -> DataFrame:
    """Nested run summaries: (runset, run, <summary fields>). With ``one_per_file=False`` one document per line.

    Run set and run are the folders of the file; where one file holds many runs, those of the run's own directory.

    A document is one row, and memory must hold it. With ``part_size`` (bytes of text) a file's document comes in as many rows as it takes:
    each has some of its phases, or some steps of a very long phase, and ``first_phase`` and ``first_step`` tell the positions of the first
    ones; ``summary_records`` goes by them. Fields of the run that stand behind the phases come with its last row. A document that ends
    early gives the parts before.
    """
    if part_size is not None:
        cut = _document_parts(spark, root, files, part_size)
        doc = F.from_json(sanitize_nonfinite(F.col("value").cast("string")), schemas.SUMMARY, {"mode": "PERMISSIVE"})
        levels = [_level(2, F.col("file")).alias("runset"), _level(1, F.col("file")).alias("run")]
        return cut.select(*levels, "first_phase", "first_step", doc.alias("doc")).select("runset", "run", "first_phase", "first_step", "doc.*")
    levels = [_level(2).alias("runset"), _level(1).alias("run")]
    if not one_per_file:
        levels = []
    docs = _documents(spark, root, files, schemas.SUMMARY, levels, one_per_file).select(*levels and ["runset", "run"], "doc.*")
    if one_per_file:
        return docs
    parts = F.split(F.rtrim(F.col("run_dir"), F.lit("/")), "/")
    own = [F.try_element_at(parts, F.lit(-back)).alias(name) for back, name in ((2, "runset"), (1, "run"))]
    return docs.select(*own, *docs.columns)


def scan_summary_records(spark: SparkSession, root: str, files: str = "summary*", fields: str = schemas.SUMMARY_RECORD) -> DataFrame:
    """Step records as ``write_summaries`` leaves them: one line per step. ``fields``: those wanted, as a schema; the parser passes over others."""
    lines = _reader(spark, files).text(root)
    record = F.from_json(sanitize_nonfinite(F.col("value")), fields, {"mode": "PERMISSIVE"})
    return lines.select(_level(1).alias("runset"), record.alias("doc")).select("runset", "doc.*")


def scan_snapshot_arrays(spark: SparkSession, root: str, files: str, fields: str) -> DataFrame:
    """Elements of nested ``{interval_sec, snapshots[]}`` documents, whatever their size: the files are cut at closing braces,
    so a long series is read by many tasks and no cell holds more than one element.

    Elements are flat objects (no braces in them). What does not parse as one is left out. The interval, which stands once in
    a document, is joined by file.
    """
    path = F.col("_metadata.file_path")
    pieces = _reader(spark, files).option("lineSep", "}").text(root).select(*step_levels(), path.alias("file__"), "value")
    element = F.concat(F.lit("{"), F.try_element_at(F.split("value", r"\{"), F.lit(-1)), F.lit("}"))
    parsed = F.from_json(sanitize_nonfinite(element), fields, {"mode": "PERMISSIVE"})
    rows = pieces.where(F.contains("value", F.lit("{")) & F.contains("value", F.lit('"elapsed_sec"'))).withColumn("doc", parsed)
    heads = pieces.select("file__", F.regexp_extract("value", r'"interval_sec"\s*:\s*(-?\d+)', 1).try_cast("int").alias("interval_sec"))
    heads = heads.where(F.col("interval_sec").isNotNull()).groupBy("file__").agg(F.min("interval_sec").alias("interval_sec"))
    return join_apart(rows, heads, ["file__"], "left").select("runset", "run", "step", "interval_sec", "doc.*")


def _snapshots(spark, root, files, schema, one_per_file, fields) -> DataFrame:
    if one_per_file:
        return scan_snapshot_arrays(spark, root, files, fields)
    lines = _documents(spark, root, files, f"interval_sec int, {fields}", step_levels(), False)
    return lines.select("runset", "run", "step", "doc.*")


def explode_snapshots(docs: DataFrame) -> DataFrame:
    """One row per snapshot of a ``{interval_sec, snapshots[]}`` document."""
    others = [c for c in docs.columns if c != "snapshots"]
    return docs.select(*others, F.inline("snapshots"))


def scan_stat_snapshots(
    spark: SparkSession, root: str, files: str = "pg_stat_statements_over_time.json", one_per_file: bool = True
) -> DataFrame:
    """Statement snapshots: nested files, or with ``one_per_file=False`` one JSON line per snapshot."""
    return _snapshots(spark, root, files, schemas.STAT_SNAPSHOTS, one_per_file, schemas.STAT_FIELDS)


def scan_lag_snapshots(
    spark: SparkSession, root: str, files: str = "replication_lag_over_time.json", one_per_file: bool = True
) -> DataFrame:
    """Lag snapshots: nested files, or with ``one_per_file=False`` one JSON line per snapshot."""
    return _snapshots(spark, root, files, schemas.LAG_SNAPSHOTS, one_per_file, schemas.LAG_FIELDS)


#: Quotes inside a quoted cell are doubled.
CSV = {"header": True, "quote": '"', "escape": '"'}


def scan_report_csv(spark: SparkSession, root: str, files: str = "report*.{csv,csv.gz}", multi_line: bool = False) -> DataFrame:
    """The flat report of every run below ``root``. ``multi_line`` allows line breaks inside quoted cells (files are not split then)."""
    return (
        _reader(spark, files)
        .schema(schemas.REPORT)
        .csv(root, multiLine=multi_line, **CSV)
        .select(_level(2).alias("runset"), _level(1).alias("run"), *schemas.REPORT_COLUMNS)
    )


def scan_latency_histogram(spark: SparkSession, root: str, files: str = "latency_histogram*.csv") -> DataFrame:
    columns = [c.split()[0] for c in schemas.HISTOGRAM.split(",")]
    return _reader(spark, files).schema(schemas.HISTOGRAM).csv(root, **CSV).select(*step_levels(), *columns)


METRIC_LINE = r"^([A-Za-z_:][A-Za-z0-9_:]*)(?:\{([^}]*)\})?\s+(\S+)"


def parse_metrics_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """``name{labels} value`` lines -> (metric, labels, value); comments and malformed numbers drop out."""
    others = [c for c in lines.columns if c != line]
    text = F.col(line)
    labels = F.regexp_extract(text, METRIC_LINE, 2)
    pairs = F.call_function("str_to_map", F.replace(labels, F.lit('"'), F.lit("")), F.lit(","), F.lit("="))
    return (
        lines.where(text.rlike(METRIC_LINE))
        .select(
            *others,
            F.regexp_extract(text, METRIC_LINE, 1).alias("metric"),
            F.when(labels != "", pairs).otherwise(F.create_map().cast("map<string,string>")).alias("labels"),
            F.regexp_extract(text, METRIC_LINE, 3).try_cast("double").alias("value"),
        )
        .where(F.col("value").isNotNull())
    )


NODE_FOLDER = r"/node=(\d+)/"
CAPTURE_NAME = r"^(.*)_metrics(?:_(\d+))?[_-]"


def scan_metrics_text(spark: SparkSession, root: str, files: str = "*_metrics[_-]*.txt") -> DataFrame:
    """Captured metrics text with its capture label (``.._before`` / ``.._after``) and node position.

    The position is part of the file name, or of a ``node=<n>`` folder below the step.
    """
    path = F.col("_metadata.file_path")
    name = F.try_element_at(F.split(path, "/"), F.lit(-1))
    position = F.concat(F.regexp_extract(name, CAPTURE_NAME, 2), F.regexp_extract(path, NODE_FOLDER, 1))
    lines = _reader(spark, files).text(root).select(
        *step_levels(F.regexp_replace(path, NODE_FOLDER, "/")),
        F.regexp_extract(name, CAPTURE_NAME, 1).alias("capture"),
        position.try_cast("int").alias("node"),
        F.col("value").alias("line"),
    )
    return parse_metrics_lines(lines)


def scan_statement_stats(spark: SparkSession, path: str, file_format: str = "parquet", **options: str) -> DataFrame:
    """Exported statement statistics (``file_format='jdbc'`` reads them from a server)."""
    return with_time_columns(spark.read.format(file_format).options(**options).load(path or None))


def scan_load_plan(spark: SparkSession, root: str, files: str = "*.json", one_per_file: bool = True) -> DataFrame:
    return (
        _reader(spark, files)
        .schema(schemas.PLAN)
        .json(root, multiLine=one_per_file)
        .withColumn("plan_file", F.col("_metadata.file_path"))
    )


def scan_keyed_table(spark: SparkSession, path: str, schema: str = schemas.TEST_TABLE) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


